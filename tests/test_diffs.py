"""The five modes on small frames, against plain Python."""

import random
from collections import Counter

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from evenkeel import SchemaDrift, TableSpec, compare
from evenkeel.operators import keyed, multiset

SCHEMA = "k int, v double, s string"


def outcome(s, t, mode, **spec):
    spec.setdefault("keys", ("k",))
    got = compare(s, t, TableSpec("tab", mode, **spec))
    first = got.outcome.first()
    kept = compare(s, t, TableSpec("tab", mode, **spec), keep=True)
    assert kept.outcome.first() == first
    if first["raw_status"] in ("FAIL", "INCONCLUSIVE"):
        assert rows(kept.samples) == rows(got.samples)
    return first, got


@pytest.fixture(scope="module")
def small(spark):
    s = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "b"), (3, 3.0, None), (4, 4.0, "d"), (5, 5.0, "e")], SCHEMA)
    t = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0005, "b"), (3, 3.0, "c"), (5, 5.5, "E"), (6, 6.0, "f")], SCHEMA)
    return s, t


def test_basic(small, spark):
    s, t = small
    assert outcome(s, t, "basic")[0].raw_status == "PASS"
    first, got = outcome(s, t.filter("k > 1"), "basic")
    assert (first.raw_status, first.count_match, first.rows_only_in_source) == ("FAIL", False, None)
    assert first.error_message == "Count mismatch: target=4, source=5"
    assert rows(got.samples) == [
        ("only_in_source", '{"k":"1"}', None, "EXISTS", None),
        ("only_in_source", '{"k":"4"}', None, "EXISTS", None),
        ("only_in_target", '{"k":"6"}', None, None, "EXISTS"),
    ]
    assert compare(s, t, TableSpec("tab", "basic")).samples.count() == 0
    nulls = spark.createDataFrame([(None, 1.0, "a")], SCHEMA)
    assert rows(compare(nulls, nulls.union(nulls), TableSpec("tab", "basic", keys=("k",))).samples) == [
        ("only_in_source", '{"k":null}', None, "EXISTS", None), ("only_in_target", '{"k":null}', None, None, "EXISTS"),
    ]


def test_hash(small):
    first, got = outcome(*small, "hash")
    assert (first.source_count, first.target_count, first.rows_only_in_source, first.rows_only_in_target, first.rows_with_mismatches) == (5, 5, 1, 1, 3)
    assert first.raw_status == "FAIL"
    assert Counter(r.mismatch_type for r in got.samples.collect()) == {"hash_diff": 3, "only_in_source": 1, "only_in_target": 1}


def test_advanced_applies_the_tolerance(small):
    first, got = outcome(*small, "advanced")
    assert (first.comparison_mode, first.rows_with_mismatches) == ("advanced", 2)
    assert [r for r in rows(got.samples) if r[0] == "value_diff"] == [
        ("value_diff", '{"k":"3"}', "s", None, "c"),
        ("value_diff", '{"k":"5"}', "s", "e", "E"),
        ("value_diff", '{"k":"5"}', "v", "5.0", "5.5"),
    ]
    assert outcome(*small, "advanced", tolerance=0.0)[0].rows_with_mismatches == 3
    assert outcome(*small, "advanced", tolerance=1.0, skip=("s",))[0].rows_with_mismatches == 0


def test_advanced_shuffles_when_many_keys_differ(small, monkeypatch):
    want = outcome(*small, "advanced")[0]
    monkeypatch.setattr(keyed, "_BROADCAST_BYTES", 0)
    first, got = outcome(*small, "advanced")
    assert first == want
    assert "Broadcast" not in got.outcome._jdf.queryExecution().analyzed().toString()


def test_the_tolerance_holds_at_any_size(spark):
    s = spark.range(0, 600_000, 1, 8).selectExpr("id AS k", "CAST(id AS DOUBLE) AS v")
    got = compare(s, s.selectExpr("k", "v + 0.0004 AS v"), TableSpec("t", "advanced", keys=("k",), tolerance=0.001)).outcome.first()
    assert (got.comparison_mode, got.raw_status, got.source_count) == ("advanced", "PASS", 600_000)


def test_evidence_is_whole(spark):
    s = spark.range(0, 4500).selectExpr("id AS k", "1.0D AS v", "repeat('x', 9000) AS s")
    t = spark.range(1500, 6000).selectExpr("id AS k", "if(id < 3000, 2.0D, 1.0D) AS v", "repeat('x', 9000) AS s")
    _, got = outcome(s, t, "advanced")
    assert Counter(r.mismatch_type for r in got.samples.collect()) == {"only_in_source": 1500, "only_in_target": 1500, "value_diff": 1500}
    for mode, n in (("hash_no_pk", 6000), ("advanced_no_pk", 6000)):
        found = outcome(s, t, mode, keys=())[1].samples
        assert found.count() == n and found.filter("length(pk_values) > 9000").count() == n


def test_evidence_is_joined_by_size(spark, monkeypatch):
    s, t = spark.range(50).selectExpr("CAST(id % 7 AS STRING) AS x"), spark.range(60).selectExpr("CAST(id % 9 AS STRING) AS x")
    want = rows(multiset.bucket_samples(s, t, ["x"]))
    monkeypatch.setattr(multiset, "_BROADCAST_BYTES", 0)
    assert rows(multiset.bucket_samples(s, t, ["x"])) == want and len(want) == 4


def test_values_beyond_doubles_differ(spark):
    amount = lambda x: spark.sql(f"SELECT 1 AS k, CAST({x} AS DECIMAL(38,2)) AS v")
    s, t = amount("9007199254740993.00"), amount("9007199254740992.00")
    assert compare(s, t, TableSpec("t", "advanced", keys=("k",))).outcome.first().raw_status == "FAIL"
    assert compare(s, t, TableSpec("t", "advanced_no_pk")).outcome.first().raw_status == "INCONCLUSIVE"
    assert compare(s, amount("9007199254740993.0004"), TableSpec("t", "advanced_no_pk")).outcome.first().raw_status == "PASS"


def test_a_tolerance_of_nothing_is_exact(spark):
    s, t = spark.sql("SELECT 1e-12D AS v, -0.0D AS z"), spark.sql("SELECT 2e-12D AS v, 0.0D AS z")
    assert compare(s, t, TableSpec("t", "advanced_no_pk", tolerance=0.0)).outcome.first().raw_status == "INCONCLUSIVE"
    assert compare(s, t, TableSpec("t", "advanced_no_pk", tolerance=1e-13)).outcome.first().raw_status == "INCONCLUSIVE"
    assert compare(s, t, TableSpec("t", "advanced_no_pk", tolerance=1e-3)).outcome.first().raw_status == "PASS"
    assert compare(s, s.selectExpr("v", "0.0D AS z"), TableSpec("t", "advanced_no_pk", tolerance=0.0)).outcome.first().raw_status == "PASS"


def test_nested_times_are_compared_by_the_microsecond(spark):
    def at(t):
        return spark.sql(f"SELECT 1 AS k, named_struct('t', TIMESTAMP '{t}') AS a, array(TIMESTAMP_NTZ '{t}') AS b, map('x', TIMESTAMP '{t}') AS c")

    first, got = outcome(at("2024-01-01 00:00:00.000001"), at("2024-01-01 00:00:00.000002"), "advanced")
    assert first.raw_status == "FAIL" and sorted(r.column_name for r in got.samples.collect()) == ["a", "b", "c"]
    assert all(".000001" in r.source_value for r in got.samples.collect())


def test_rows_that_go_between_the_passes_are_reported(spark):
    s = spark.range(10).selectExpr("id AS k", "1.0D AS v")
    t = s.selectExpr("k", "if(k < 3, 5.0D, v) AS v")
    first = keyed.exact_findings(s, t, ["k"], ["k", "v"])
    found = keyed.column_findings(s.filter("k <> 1"), t, ["k"], ["k", "v"], 0.001, first)
    got = keyed.keyed_outcome(found, "advanced", "value_diff").first()
    assert (got.source_count, got.target_count, got.rows_with_mismatches) == (10, 10, 3)
    assert ("value_diff", '{"k":"1"}', None, "row changed during the comparison", "EXISTS") in rows(keyed.keyed_samples(found, ["k"]))


def test_binary_keys_are_shown_whole(spark):
    s = spark.sql("SELECT X'ff01' AS k, 1 AS v")
    assert [r.pk_values for r in outcome(s, s.limit(0), "hash", skip=())[1].samples.collect()] == ['{"k":"FF01"}']


def test_keyless_modes(spark):
    s = spark.createDataFrame([("a", 1.0)] * 3 + [("b", 2.0)], "x string, y double")
    t = spark.createDataFrame([("a", 1.0)] + [("c", 3.0)] * 2 + [("b", 2.0004)], "x string, y double")
    first, got = outcome(s, t, "hash_no_pk", keys=())
    assert (first.rows_only_in_source, first.rows_only_in_target, first.rows_with_mismatches, first.raw_status) == (3, 3, 0, "INCONCLUSIVE")
    assert {(r.mismatch_type, r.source_value, r.target_value) for r in got.samples.collect()} == {
        ("multiset_count_diff", "3", "1"), ("only_in_target_multiset", "0", "2"),
        ("only_in_source_multiset", "1", "0"), ("only_in_target_multiset", "0", "1"),
    }
    first, got = outcome(s, t, "advanced_no_pk", keys=())
    assert (first.rows_only_in_source, first.rows_only_in_target, first.raw_status) == (2, 2, "INCONCLUSIVE")
    assert rows(got.samples) == [
        ("only_in_source_no_pk", '{"x":"a","y":"1.0"}', None, "2", "0"),
        ("only_in_target_no_pk", '{"x":"c","y":"3.0"}', None, "0", "2"),
    ]
    first, _ = outcome(s, t.limit(3), "hash_no_pk", keys=())
    assert (first.raw_status, first.count_match) == ("FAIL", False)
    assert outcome(s, s.repartition(7), "hash_no_pk", keys=())[0].raw_status == "PASS"


def test_key_problems_stop_a_keyed_diff(spark):
    s = spark.createDataFrame([(1, 1.0, "a"), (None, 1.0, "a"), (2, 2.0, "x")], SCHEMA)
    t = spark.createDataFrame([(1, 1.0, "a"), (1, 9.0, "z"), (1, 9.0, "z")], SCHEMA)
    for mode in ("hash", "advanced"):
        first, _ = outcome(s, t, mode)
        assert (first.raw_status, first.count_match, first.source_count, first.rows_only_in_source) == ("DATA_QUALITY_ERROR", None, 3, None)
        assert first.error_message == "target: 2 duplicate PK rows; source: 1 rows with NULL PK values"
    first, _ = outcome(s, t, "hash", skip=("k",))
    assert first.raw_status == "DATA_QUALITY_ERROR" and "missing" in first.error_message


def test_routing(small):
    s, t = small
    first, _ = outcome(s, t, "hash", keys=())
    assert first.raw_status == "DATA_QUALITY_ERROR" and "requires entries in" in first.error_message
    assert outcome(s, t, "hash", keys=(), pk_fallback_strategy="no_pk_hash")[0].comparison_mode == "hash_no_pk"
    assert outcome(s, t, "advanced", keys=(), pk_fallback_strategy="NO_PK_ADVANCED")[0].comparison_mode == "advanced_no_pk"
    assert outcome(s, t, "advanced", keys=(), pk_fallback_strategy="no_pk_hash")[0].raw_status == "DATA_QUALITY_ERROR"
    assert outcome(s, t, "fingerprint")[0].error_message == "Unknown mode: fingerprint"
    assert outcome(s, t, "hash_no_pk", keys=(), skip=("k", "v", "s"))[0].raw_status == "DATA_QUALITY_ERROR"
    assert outcome(s, t, "hash", skip=("v", "s"))[0].rows_with_mismatches == 0
    with pytest.raises(SchemaDrift):
        compare(s, t.drop("v"), TableSpec("tab", "hash", keys=("k",)))


def test_type_pairs(spark):
    s = spark.sql("SELECT 1 AS k, CAST('1.50' AS DECIMAL(8,2)) AS d, TIMESTAMP_NTZ '2024-01-01 00:00:00.3' AS ts, 7 AS n, map('a', 1, 'b', 2) AS m, float(0.1) AS f")
    t = spark.sql("SELECT 1L AS k, CAST('1.5' AS DECIMAL(8,1)) AS d, TIMESTAMP '2024-01-01 00:00:00.7' AS ts, '7' AS n, map('b', 2, 'a', 1) AS m, 0.1D AS f")
    for mode in ("hash", "advanced_no_pk", "hash_no_pk"):
        assert outcome(s, t, mode)[0].raw_status == "PASS", mode  # whole seconds
    first, got = outcome(s, t, "advanced")
    assert [r.column_name for r in got.samples.collect()] == ["ts"]  # microseconds
    assert outcome(s, t, "hash", timestamp_unit="microsecond")[0].raw_status == "FAIL"


def test_empty_and_one_sided(small):
    s, t = small
    none = t.limit(0)
    for mode in ("basic", "hash", "hash_no_pk", "advanced", "advanced_no_pk"):
        assert outcome(none, none, mode)[0].raw_status == "PASS", mode
        assert outcome(s, none, mode)[0].raw_status == "FAIL", mode
    assert outcome(s, none, "hash")[0].rows_only_in_source == 5


def test_sample_cap_takes_the_first_keys(spark):
    s = spark.range(0, 500, 1, 13).selectExpr("CAST(id AS INT) AS k", "1.0D AS v", "'x' AS s")
    t = s.filter("k % 2 = 0").selectExpr("k", "if(k % 4 = 0, 2.0D, v) AS v", "s")
    _, got = outcome(s, t, "advanced", sample_cap=10)
    picked = {(r.mismatch_type, int(r.pk_values.split('"')[3])) for r in got.samples.collect()}
    assert picked == {("only_in_source", k) for k in range(1, 21, 2)} | {("value_diff", k) for k in range(0, 40, 4)}


def test_except_all_keeps_copies(spark):
    s = spark.createDataFrame([("a",)] * 3 + [("b",), (None,)], "x string")
    t = spark.createDataFrame([("a",), ("c",), (None,)], "x string")
    assert rows(multiset.except_all(s, t, ["x"])) == [("a",), ("a",), ("b",)]
    assert rows(multiset.except_all(t, s, ["x"])) == [("c",)]


def brute_keyed(s, t):
    a, b = dict((r[0], r[1:]) for r in s), dict((r[0], r[1:]) for r in t)
    return len(a.keys() - b.keys()), len(b.keys() - a.keys()), sum(a[k] != b[k] for k in a.keys() & b.keys())


value = st.tuples(st.sampled_from([None, 0.0, 1.5, 1e300, -7.25]), st.sampled_from([None, "", "a", " ", "é", '"']))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 8), value, max_size=8), st.dictionaries(st.integers(0, 8), value, max_size=8))
def test_modes_match_brute_force(spark, a, b):
    left, right = [(k, *v) for k, v in a.items()], [(k, *v) for k, v in b.items()]
    s, t = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    only_s, only_t, changed = brute_keyed(left, right)
    for mode in ("hash", "advanced"):
        got = compare(s, t, TableSpec("x", mode, keys=("k",), tolerance=0.0)).outcome.first()
        assert (got.rows_only_in_source, got.rows_only_in_target, got.rows_with_mismatches) == (only_s, only_t, changed)
    x, y = Counter(r[1:] for r in left), Counter(r[1:] for r in right)
    for mode in ("hash_no_pk", "advanced_no_pk"):
        got = compare(s.drop("k"), t.drop("k"), TableSpec("x", mode)).outcome.first()
        assert (got.rows_only_in_source, got.rows_only_in_target) == (sum((x - y).values()), sum((y - x).values()))
        assert got.rows_only_in_target - got.rows_only_in_source == got.target_count - got.source_count
        mirror = compare(t.drop("k"), s.drop("k"), TableSpec("x", mode)).outcome.first()
        assert (mirror.rows_only_in_source, mirror.rows_only_in_target) == (got.rows_only_in_target, got.rows_only_in_source)


def test_hot_keys_do_not_multiply(spark):
    """One key holds a third of all rows on both sides: a join would make 4 million pairs of it."""
    n = 6000
    rng = random.Random(7)
    left = [(0 if i % 3 == 0 else i, float(rng.randint(0, 3)), "s") for i in range(n)]
    right = [(0 if i % 3 == 0 else i, float(rng.randint(0, 3)), "s") for i in range(n)]
    s, t = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    pairs = keyed.hash_pairs(s, t, ["k"], ["k", "v", "s"])
    hot = pairs.filter("k = 0").first()
    assert (hot.n_source, hot.n_target, hot.diff_class) == (2000, 2000, "duplicate_key")
    assert pairs.count() == 4001
    x, y = Counter(r[1:] for r in left), Counter(r[1:] for r in right)
    got = compare(s.drop("k"), t.drop("k"), TableSpec("x", "hash_no_pk")).outcome.first()
    assert (got.rows_only_in_source, got.rows_only_in_target) == (sum((x - y).values()), sum((y - x).values()))


def test_bigints_beside_doubles_and_dates_beside_times(spark):
    s = spark.sql("SELECT 1 AS k, 9007199254740993L AS v, DATE '2024-01-01' AS d")
    t = spark.sql("SELECT 1 AS k, 9007199254740992D AS v, TIMESTAMP '2024-01-01 00:00:00' AS d")
    for mode in ("hash", "advanced"):
        assert outcome(s, t, mode, tolerance=0.0)[0].rows_with_mismatches == 1
        assert outcome(s.withColumn("v", s.v - 1), t, mode, tolerance=0.0)[0].raw_status == "PASS"
    for odd in ("1e30D", "CAST('NaN' AS DOUBLE)", "-1e25D", "0.5D"):
        assert outcome(spark.sql("SELECT 1 AS k, CAST(NULL AS BIGINT) AS v"), spark.sql(f"SELECT 1 AS k, {odd} AS v"), "advanced")[0].raw_status == "FAIL"
