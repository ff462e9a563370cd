"""Structure profile of raw JSON records: which types each field really holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from adledger.functions.variants import exact_items_of, lacks_keys, type_name, type_prefix


def _shown(raw: DataFrame, json: str) -> DataFrame:
    """``field, kind, prefix`` of every record: each type that a field of it shows, once."""
    values = raw.select(
        F.explode(
            F.try_variant_get(F.try_parse_json(F.col(json)), "$", "map<string,variant>")
        ).alias("field", "value")
    ).withColumn("items", F.expr(exact_items_of("value")))
    nested = F.coalesce(F.get("items", F.lit(0)).isNotNull(), F.lit(False))

    def entry(kind, prefix):
        return F.struct(F.lit(kind).alias("kind"), prefix.alias("prefix"))

    complete = F.expr(f"filter(items, x -> NOT {lacks_keys('x')})")
    inside = F.transform(complete, lambda x: entry("values", type_prefix(x["value"])))
    entries = F.when(
        nested, F.concat(F.array(entry("nested", F.lit("ARRA"))), F.array_distinct(inside))
    ).otherwise(F.array(entry("plain", type_prefix(F.col("value")))))
    return values.select("field", F.inline(entries))


def _named(shown: DataFrame, *beside: str) -> DataFrame:
    field = F.when(F.col("kind") == "values", F.concat("field", F.lit("_values")))
    return shown.select(
        F.coalesce(field, "field").alias("field"),
        "kind",
        type_name(F.col("prefix")).alias("type"),
        *beside,
    )


def field_types(raw: DataFrame, json: str = "record") -> DataFrame:
    """Distinct ``(field, kind, type)`` over all records of a JSON text column.

    ``kind`` is ``plain``; ``nested`` for a non-empty list that starts with an object; or
    ``values`` for the values inside such a list, under ``<field>_values``. Values are
    reduced to their type before anything is shuffled, so a task sends at most one row per
    field and type.
    """
    return _named(_shown(raw, json).distinct())


def types_per_field(found: DataFrame) -> DataFrame:
    """``field, types`` as sorted lists, from the result of ``field_types``."""
    return (
        found.filter("kind NOT IN ('nested', 'records')")
        .groupBy("field")
        .agg(F.array_sort(F.collect_set("type")).alias("types"))
    )


def nested_fields(found: DataFrame) -> DataFrame:
    return found.filter("kind = 'nested'").select("field").distinct()


def record_summary(raw: DataFrame, json: str = "record", order: str = "_seq") -> DataFrame:
    """One row: number of records, and the keys of the first one in their order."""
    return raw.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.json_object_keys(F.min_by(json, order)).alias("sample_record_keys"),
    )


# -- mergeable profile -------------------------------------------------------------

STATE = "field string, kind string, type string, n_records long, first struct<place: string, keys: array<string>>"


def load_state(raw: DataFrame, json: str = "record", order: str = "_seq", load: int = 0) -> DataFrame:
    """The profile of one load as a small frame of ``STATE`` rows.

    A row for every ``(field, kind, type)`` of ``field_types`` with the number of records that
    show it, and a row of kind ``records`` with the number of all records and the keys of the
    first one. ``order`` is a whole number of at least 0, and ``load`` goes before it. A text that
    is not JSON counts as a record without fields. An empty load has no rows.

    Types are counted by hash before the shuffle. The first record is found on its own, as a text
    among the aggregates would have Spark sort all values; that pass parses nothing.
    """
    types = _named(_shown(raw, json).groupBy("field", "kind", "prefix").agg(F.count(F.lit(1)).alias("n_records")), "n_records")
    place = F.concat(F.lpad(F.lit(str(load)), 10, "0"), F.lit("."), F.lpad(F.min(order).cast("string"), 20, "0"))
    whole = raw.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.struct(place.alias("place"), F.json_object_keys(F.min_by(json, order)).alias("keys")).alias("first"),
    )
    whole = whole.where("n_records > 0").withColumn("kind", F.lit("records"))
    # Two types of Spark may have one name.
    return merge_states(types.unionByName(whole, allowMissingColumns=True))


def merge_states(states: DataFrame) -> DataFrame:
    """One state out of the rows of many; the order and grouping of merges do not matter."""
    return states.groupBy("field", "kind", "type").agg(
        F.sum("n_records").alias("n_records"), F.min("first").alias("first")
    )


def store_state(raw: DataFrame, path: str, load: int, json: str = "record", order: str = "_seq") -> None:
    """Write a load's state below ``path``; the same load written again replaces its own state."""
    load_state(raw, json, order, load).coalesce(1).write.mode("overwrite").parquet(f"{path}/load={load}")


def stored_profile(spark: SparkSession, path: str) -> DataFrame:
    """The profile of all loads stored below ``path``, without a look at their records.

    ``types_per_field`` and ``nested_fields`` take it like the result of ``field_types``.
    """
    return merge_states(spark.read.schema(STATE).parquet(path).drop("load"))


def summary_of(state: DataFrame) -> DataFrame:
    """``record_summary`` from a state."""
    whole = state.filter("kind = 'records'")
    return whole.agg(
        F.coalesce(F.sum("n_records"), F.lit(0)).alias("total_records"),
        F.min("first")["keys"].alias("sample_record_keys"),
    )
