import json

from adledger.operators import profile as P

RECORDS = [
    {"b": "x", "a": 1, "n": [{"action_type": "t", "value": "1"}, {"action_type": "t", "value": 2}, "s"]},
    {"a": 1.5, "b": None, "n": [], "o": {"k": 1}, "m": [1, {"action_type": "t", "value": 1}]},
    {"a": True, "n": [{"value": 1}], "q": [{"action_type": "t", "value": None}], "r": [[1]]},
    {},
]


def raw(spark, records):
    data = [(i, json.dumps(r)) for i, r in enumerate(records)]
    return spark.createDataFrame(data, "_seq long, record string")


def test_types_and_nested_fields(spark):
    found = P.field_types(raw(spark, RECORDS))
    assert {r.field: list(r.types) for r in P.types_per_field(found).collect()} == {
        "a": ["bool", "float", "int"],
        "b": ["NoneType", "str"],
        "n": ["list"],
        "n_values": ["int", "str"],
        "o": ["dict"],
        "m": ["list"],
        "q_values": ["NoneType"],
        "r": ["list"],
    }
    assert sorted(r.field for r in P.nested_fields(found).collect()) == ["n", "q"]


def test_summary_keeps_key_order(spark):
    total, keys = P.record_summary(raw(spark, RECORDS).repartition(3)).first()
    assert (total, list(keys)) == (4, ["b", "a", "n"])
    total, keys = P.record_summary(raw(spark, RECORDS).limit(0)).first()
    assert (total, keys) == (0, None)


def profile_of(state):
    rows = state.select("field", "kind", "type", "n_records", "first.keys").collect()
    return sorted(tuple(r) for r in map(lambda r: (r[0] or "", r[1], r[2] or "", r[3], str(r[4])), rows))


def test_stored_states_make_the_profile_of_all(spark, folder):
    everything = raw(spark, RECORDS * 3)
    for load, part in enumerate(("_seq >= 7", "_seq < 2", "_seq BETWEEN 2 AND 6")):
        P.store_state(everything.filter(part), folder, load)
    got, want = P.stored_profile(spark, folder), P.load_state(everything)
    counts = [r[:4] for r in profile_of(want)]
    assert [r[:4] for r in profile_of(got)] == counts
    assert ("a", "plain", "int", 3) in counts and ("n_values", "values", "str", 3) in counts
    assert ("", "records", "", 12) in counts and ("n", "nested", "list", 6) in counts
    # The first record is that of the first load, whatever the loads' own order says.
    assert tuple(P.summary_of(got).first()) == (12, [])


def test_state_agrees_with_the_whole_pass(spark):
    rows = raw(spark, RECORDS)
    state, found = P.load_state(rows), P.field_types(rows)
    types = lambda df: sorted((r.field, tuple(r.types)) for r in P.types_per_field(df).collect())
    assert types(state) == types(found)
    assert sorted(P.nested_fields(state).collect()) == sorted(P.nested_fields(found).collect())
    assert P.summary_of(state).first() == P.record_summary(rows).first()


def test_merges_in_any_order_and_replays(spark, folder):
    one, two = raw(spark, RECORDS[:2]), raw(spark, RECORDS[2:])
    a, b = P.load_state(one, load=1), P.load_state(two, load=2)
    both = profile_of(P.merge_states(a.unionByName(b)))
    assert profile_of(P.merge_states(b.unionByName(P.merge_states(a)))) == both
    for load, rows in ((1, one), (2, two), (1, one)):
        P.store_state(rows, folder, load)
    assert profile_of(P.stored_profile(spark, folder)) == both


def test_state_of_nothing_and_of_what_is_not_json(spark):
    nothing = P.load_state(raw(spark, []))
    assert nothing.count() == 0 and tuple(P.summary_of(nothing).first()) == (0, None)
    broken = spark.createDataFrame([(0, "{"), (1, None), (2, "[1]")], "_seq long, record string")
    assert [r[:4] for r in profile_of(P.load_state(broken))] == [("", "records", "", 3)]
