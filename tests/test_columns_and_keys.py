"""Column resolution, schema drift, key checks."""

import pytest
from conftest import rows

from evenkeel import ConfigError, SchemaDrift
from evenkeel.operators import keys
from evenkeel.operators.columns import align, coerce_complex_to_json, resolve_columns, schema_drift


@pytest.fixture
def pair(spark):
    return spark.createDataFrame([], "k int, a string, s double"), spark.createDataFrame([], "k int, a string, t double")


def test_policies(pair):
    s, t = pair
    assert resolve_columns(s, t, policy="intersect") == ["a", "k"]
    assert resolve_columns(s, t, ["a"], "ignore_extra") == ["k"]
    with pytest.raises(SchemaDrift) as drift:
        resolve_columns(s, t, policy="fail")
    assert (drift.value.extra_in_source, drift.value.extra_in_target) == (["s"], ["t"])
    assert str(drift.value).startswith("Schema mismatch:")
    with pytest.raises(SchemaDrift):  # skipped columns count as drift under this policy
        resolve_columns(s, t, ["s", "t"], "fail")
    with pytest.raises(SchemaDrift):
        resolve_columns(s, t, policy="require_source_columns")
    assert resolve_columns(s.drop("s"), t, policy="require_source_columns") == ["a", "k"]
    with pytest.raises(ConfigError):
        resolve_columns(s, t, policy="whatever")


def test_schema_drift_report(spark, pair):
    s, t = pair
    assert rows(schema_drift(s, t)) == [("s", "extra_in_source", "double", None), ("t", "extra_in_target", None, "double")]
    u = spark.createDataFrame([], "k string, a string, s float")
    assert rows(schema_drift(s, u)) == [("k", "type_mismatch", "int", "string")]
    assert rows(schema_drift(s, s)) == []


def test_align_to_common_types(spark):
    s = spark.sql("SELECT 1 AS a, CAST('1.50' AS DECIMAL(5,2)) AS b, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS c, 'x' AS d, 1 AS e")
    t = spark.sql("SELECT 1L AS a, CAST('1.5' AS DECIMAL(5,1)) AS b, TIMESTAMP '2024-01-01 00:00:00' AS c, 'x' AS d, '1' AS e")
    a, b = align(s, t, ["a", "b", "c", "d", "e"])
    assert a.dtypes == b.dtypes == [("a", "bigint"), ("b", "decimal(6,2)"), ("c", "timestamp"), ("d", "string"), ("e", "string")]
    assert a.first() == b.first()


def test_key_quality_counts_null_keys_as_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, None), (None, "b")], "k int, l string")
    assert rows(keys.key_quality(df, ["k", "l"])) == [(5, 3, 3, 2)]
    assert rows(keys.key_quality(df.limit(0), ["k"])) == [(0, 0, 0, 0)]
    assert rows(keys.duplicate_keys(df, ["k", "l"])) == [(1, "a", 2), (None, "b", 2)]
    with pytest.raises(ConfigError):
        keys.key_quality(df, ["nope"])


def test_key_only_diff(spark):
    s = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    t = spark.createDataFrame([(2,), (3,), (None,)], "k long")
    assert rows(keys.keys_only_in_source(s, t, ["k"])) == [(1, 2), (None, 1)]
    assert rows(keys.keys_only_in_target(s, t, ["k"])) == [(3, 1), (None, 1)]


def test_coerce_complex(spark):
    df = spark.sql("SELECT 1 AS a, array(1, NULL) AS b, map('k', 2) AS c, named_struct('x', 1) AS d, CAST(NULL AS ARRAY<INT>) AS e")
    assert tuple(coerce_complex_to_json(df).first()) == (1, "[1,null]", '{"k":2}', '{"x":1}', None)
