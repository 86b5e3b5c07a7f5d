"""Values in another form: JSON, collations, numbers beside doubles, renamed columns."""

import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel import TableSpec, compare
from evenkeel.errors import ConfigError
from evenkeel.functions.normal import COLLATIONS, collated, json_text
from evenkeel.operators.renames import column_renames


MODES = ("hash", "advanced", "hash_no_pk", "advanced_no_pk")


def statuses(source, target, **spec):
    return {m: compare(source, target, TableSpec("t", m, keys=("k",), **spec)).outcome.first().raw_status for m in MODES}


JSON = [
    ('{"a":1,"b":2}', '{"b": 2, "a": 1}', True), ('{"a":[1,2]}', '{"a":[2,1]}', False), ('{"a":1}', '{"a":"1"}', False), ('{"a":1.0}', '{"a":1}', True),
    ('{"a":{"z":null,"y":[{"d":1,"c":2}]}}', '{"a":{"y":[{"c":2,"d":1}],"z":null}}', True), ('{"a":null}', '{}', False), ("{broken", "{broken", True),
    ("{broken", "{ broken", False), (None, "null", False), ("null", " null ", True), ('"x"', '"x" ', True), ('"x"', '"X"', False), ("", "", True), ("1e2", "1E+2", True), ("1e2", "100", False),
    ('{"k":"é\\u00e9"}', '{"k":"éé"}', True), ('{"a":9007199254740993}', '{"a":9007199254740992}', False),
]


def test_json_values(spark):
    df = spark.createDataFrame([(k, a, b) for k, (a, b, _) in enumerate(JSON)], "k long, a string, b string")
    same = f"{json_text('a', T.StringType())} <=> {json_text('b', T.StringType())}"
    assert {r.k: r.same for r in df.selectExpr("k", f"{same} AS same").collect()} == {k: same for k, (*_, same) in enumerate(JSON)}
    s, t = df.selectExpr("k", "a AS v"), df.selectExpr("k", "b AS v")
    n = sum(not same for *_, same in JSON)
    for mode in MODES:
        row = compare(s, t, TableSpec("t", mode, keys=("k",), json_columns=("v",))).outcome.first()
        assert row.rows_only_in_source + row.rows_with_mismatches == n, mode


def test_json_of_other_types(spark):
    s = spark.range(1).selectExpr("id AS k", "named_struct('b', 1, 'a', array('x')) AS v")
    t = spark.range(1).selectExpr("id AS k", """'{"a": ["x"], "b": 1}' AS v""")
    v = spark.range(1).selectExpr("id AS k", """parse_json('{"b":1,"a":["x"]}') AS v""")
    for other in (t, v):
        assert set(statuses(s, other, json_columns=("v",)).values()) == {"PASS"}
    with pytest.raises(ConfigError):
        json_text("v", T.LongType())


@pytest.mark.parametrize("collation", COLLATIONS)
def test_texts_are_equal_when_the_collation_says_so(spark, collation):
    texts = ["x", "x ", "x  ", "X", " x", "x\t", "", " ", "é", "É", "ΑΣ", "ας", "ασ", "İ", "i", "straße", "STRASSE", "ǅ", "ǆ"]
    df = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    mine = f"{collated('a', T.StringType(), collation)} = {collated('b', T.StringType(), collation)}"
    wrong = df.filter(f"({mine}) <> (a COLLATE {collation} = b COLLATE {collation})")
    assert wrong.collect() == []
    grouped = df.groupBy(F.expr(f"a COLLATE {collation}")).count().count()
    assert df.select(F.expr(collated("a", T.StringType(), collation))).distinct().count() == grouped


def test_collated_keys_and_values(spark):
    s = spark.createDataFrame([("x", "Ab"), ("y", "c")], "k string, v string")
    t = spark.createDataFrame([("x  ", "aB "), ("y ", "c")], "k string, v string")
    both = (("k", "UTF8_BINARY_RTRIM"), ("v", "UTF8_LCASE_RTRIM"))
    assert set(statuses(s, t, collations=both).values()) == {"PASS"}
    assert statuses(s, t) == {"hash": "FAIL", "advanced": "FAIL", "hash_no_pk": "INCONCLUSIVE", "advanced_no_pk": "INCONCLUSIVE"}
    twice = t.unionByName(spark.createDataFrame([("x", "ab")], "k string, v string"))
    assert statuses(s, twice, collations=both)["hash"] == "DATA_QUALITY_ERROR"  # one key in two spellings
    for bad in ((("v", "GERMAN"),), (("v", "UTF8_LCASE"),)):
        with pytest.raises(ConfigError):
            compare(s, t, TableSpec("t", "hash", keys=("k",), collations=bad, json_columns=("v",)))


WIDE = [
    ("decimal(38,0)", "9007199254740993", 9007199254740992.0, False), ("decimal(38,0)", "9007199254740992", 9007199254740992.0, True),
    ("bigint", "0", 1e-20, False), ("bigint", "0", -0.0, True), ("bigint", "9223372036854775807", 9.223372036854775807e18, False),
    ("decimal(20,5)", "0.10000", 0.1, True), ("decimal(20,5)", "0.10000", 0.10000000000000002, False), ("decimal(38,18)", "0.1", 0.1, True),
    ("decimal(38,18)", "0", 1e-20, False), ("decimal(38,0)", "1", float("inf"), False), ("decimal(38,0)", "1", float("nan"), False), ("bigint", None, None, True),
    ("bigint", "7", 7.000000001, False), ("decimal(38,37)", "1.5", 1.5, True), ("decimal(38,37)", "1.5", 100.0, False), ("decimal(10,2)", "0.10", 0.1, True),
]


@pytest.mark.parametrize("kind", sorted({c[0] for c in WIDE}))
def test_wide_numbers_beside_doubles(spark, kind):
    cases = [(k, a, b, same) for k, (of, a, b, same) in enumerate(WIDE) if of == kind]
    s = spark.createDataFrame([(k, a) for k, a, *_ in cases], "k long, v string").withColumn("v", F.col("v").cast(kind))
    t = spark.createDataFrame([(k, b) for k, _, b, _ in cases], "k long, v double")
    wrong = {k for k, *_, same in cases if not same}
    for one, other in ((s, t), (t, s)):
        for mode in MODES:
            found = compare(one, other, TableSpec("t", mode, keys=("k",), tolerance=0.0))
            row = found.outcome.first()
            assert row.rows_only_in_source + row.rows_with_mismatches == len(wrong), mode
            if "no_pk" not in mode and wrong:
                assert {r.pk_values for r in found.samples.collect()} == {f'{{"k":"{k}"}}' for k in wrong}


def test_a_tolerance_still_reaches_over(spark):
    s = spark.createDataFrame([(1, Decimal(5)), (2, Decimal(0))], "k long, v decimal(30,0)")
    t = spark.createDataFrame([(1, 5.0004), (2, 1e-20)], "k long, v double")
    assert compare(s, t, TableSpec("t", "advanced", keys=("k",), tolerance=0.001)).outcome.first().raw_status == "PASS"
    assert compare(s, t, TableSpec("t", "advanced_no_pk", tolerance=0.001)).outcome.first().raw_status == "PASS"
    assert compare(s, t, TableSpec("t", "advanced", keys=("k",), tolerance=0.0001)).outcome.first().raw_status == "FAIL"


def renames(s, t):
    return {(r.source_column, r.target_column): (r.match, r.unique) for r in column_renames(s, t).collect()}


def test_renamed_columns(spark):
    rng = random.Random(6)
    data = [(i, f"name {i}", rng.randrange(5), rng.random(), None) for i in range(3000)]
    s = spark.createDataFrame(data, "k long, name string, grade int, score double, hollow string").repartition(3)
    assert renames(s, s) == {}
    t = s.withColumnsRenamed({"name": "title", "grade": "level", "score": "points", "hollow": "void"})
    assert renames(s, t) == {("name", "title"): ("identical", True), ("grade", "level"): ("identical", True), ("score", "points"): ("identical", True)}
    fewer = t.filter("k % 30 <> 0").withColumn("level2", F.col("level"))
    assert renames(s, fewer) == {("name", "title"): ("similar", True), ("grade", "level"): ("similar", False), ("grade", "level2"): ("similar", False), ("score", "points"): ("similar", True)}
    # what moved within the column is no rename
    shifted = s.select("k", F.concat("name", F.lit("!")).alias("title"))
    assert renames(s.select("k", "name"), shifted) == {}
    assert renames(s.filter("false"), t.filter("false")) == {}
    cast = s.select("k", F.col("grade").cast("long").alias("level"))
    assert renames(s.select("k", "grade"), cast) == {("grade", "level"): ("identical", True)}


def test_one_scan_per_side(spark, sf):
    from evenkeel.operators.renames import column_facts

    orders = spark.read.parquet(f"{sf}/orders.parquet")
    text = column_facts(orders, ["o_custkey", "o_orderdate"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in text
    assert rows(column_facts(orders, ["o_custkey"]).select("column", "nulls")) == [("o_custkey", 0)]


def test_json_is_parsed_once_for_all_modes(spark, sf, monkeypatch):
    from workload import forms

    seen = []
    monkeypatch.setattr(forms, "compare", lambda s, t, spec, keep=compare: (seen.extend((s, t)), keep(s, t, spec))[1])
    found = forms.diff_json(spark, sf)
    assert len(seen) == 8 and all("parse_json" not in df._jdf.queryExecution().optimizedPlan().toString().lower() for df in [*seen, found])
