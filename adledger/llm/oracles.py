"""DuckDB SQL for the registered queries that SQL can express on whole tables."""

ORACLES = {
    "op8_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
            FROM documents
        ), g AS (
            SELECT content, count(*) AS group_size, max(points) AS points FROM d GROUP BY content
        ), k AS (
            SELECT d.content, min(d.doc_id) AS keep_id
            FROM d JOIN g ON d.content = g.content AND d.points = g.points GROUP BY d.content
        )
        SELECT d.doc_id, k.keep_id, g.group_size, d.doc_id = k.keep_id AS kept, sha256(d.content) AS text_sha256
        FROM d JOIN g ON d.content = g.content JOIN k ON d.content = k.content
    """,
    "op12_filter_audit": r"""
        WITH words AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), known AS (
            SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
            FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
        ), firsts AS (
            SELECT text, min(doc_id) AS first_id FROM words GROUP BY text
        ), masks AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   CAST(len(w) < 200 AS INT)
                   + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
                   + 4 * CAST(100 * length(regexp_replace(words.text, '[^A-Z]+', '', 'g')) > 2 * length(words.text) AS INT)
                   + 8 * CAST(regexp_matches(words.text, '[#$%&*|]') AS INT)
                   + 16 * CAST(coalesce(words.doc_id > first_id, false) AS INT) AS mask
            FROM words JOIN firsts ON words.text = firsts.text LEFT JOIN known ON words.doc_id = known.doc_id
        ), counted AS (
            SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask
        ), letters AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit
        ), orders AS (
            SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
        ), steps AS (
            SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0) AS earlier
            FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
        ), effects AS (
            SELECT part, filter_order, step, own,
                   sum(CASE WHEN mask & own = 0 AND mask & CAST(earlier AS INT) = 0 THEN n ELSE 0 END) AS kept,
                   sum(CASE WHEN mask & own > 0 AND mask & CAST(earlier AS INT) = 0 THEN n ELSE 0 END) AS removed,
                   sum(CASE WHEN mask & own > 0 AND mask & CAST(earlier AS INT) > 0 THEN n ELSE 0 END) AS redundant,
                   sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
                   sum(CASE WHEN mask & own > 0 AND mask & CAST(earlier AS INT) = 0 THEN good ELSE 0 END) AS good_lost,
                   sum(CASE WHEN mask & own > 0 AND mask & CAST(earlier AS INT) = 0 THEN toxic ELSE 0 END) AS toxic_lost
            FROM counted, steps GROUP BY part, filter_order, step, own
        )
        SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept,
               CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
               CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
        FROM effects
    """,
}
