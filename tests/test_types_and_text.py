"""Canonical text, digests and the 'differs' rule, type by type."""

import hashlib
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import types as T

from evenkeel.functions import sqltext
from evenkeel.functions.canonical import canonical_rows, decimals_for, key_json, rounded, row_json, with_row_hash
from evenkeel.functions.predicates import differs
from evenkeel.functions.types import as_text, common_type


def one(spark, sql):
    return spark.sql(f"SELECT {sql} AS v")


def text(spark, sql, **form):
    return canonical_rows(one(spark, sql), ["v"], **form).first()[0]


@pytest.mark.parametrize(
    ("sql", "form", "want"),
    [
        ("1.123456789D", {}, "1.12345679"),
        ("1.123456789D", {"decimals": 3}, "1.123"),
        ("1.123456789D", {"decimals": None}, "1.123456789"),
        ("-0.0D", {}, "0.0"),
        ("double('NaN')", {}, "NaN"),
        ("double('Infinity')", {}, "Infinity"),
        ("CAST('1.10' AS DECIMAL(10,2))", {}, "1.10"),
        ("CAST('1.10' AS DECIMAL(10,2))", {"round_decimals": True, "decimals": 3}, "1.10"),
        ("CAST('9007199254740993.06' AS DECIMAL(38,2))", {"round_decimals": True, "decimals": 1}, "9007199254740993.1"),
        ("-0.0D", {"decimals": None}, "0.0"),
        ("named_struct('t', TIMESTAMP_NTZ '2024-01-01 00:00:00.000001')", {}, '{"t":"2024-01-01T00:00:00.000001"}'),
        ("X'00ff'", {}, "00FF"),
        ("array(1, NULL, 3)", {}, "[1,null,3]"),
        ("TIMESTAMP '2024-01-01 00:00:01.9'", {}, "1704067201"),
        ("TIMESTAMP_NTZ '2024-01-01 00:00:01.9'", {}, "1704067201"),
        ("TIMESTAMP_NTZ '2024-01-01 00:00:01.9'", {"timestamp_unit": "microsecond"}, "1704067201900000"),
        ("TIMESTAMP '1969-12-31 23:59:59.5'", {}, "-1"),
        ("DATE '2024-02-29'", {}, "2024-02-29"),
        ("true", {}, "true"),
        ("9007199254740993", {}, "9007199254740993"),
        ("map('b', 1, 'a', 2)", {}, '{"a":2,"b":1}'),
        ("named_struct('x', NULL, 'y', 1)", {}, '{"x":null,"y":1}'),
        ("array(map('z', 1, 'y', 2))", {}, '[{"y":2,"z":1}]'),
        ("named_struct('m', map('q', map('b', 1, 'a', 2)))", {}, '{"m":{"q":"{\\"a\\":2,\\"b\\":1}"}}'),
        ("CAST(NULL AS STRING)", {}, None),
        ("CAST(NULL AS STRUCT<m: MAP<STRING, INT>>)", {}, None),
    ],
)
def test_canonical_text(spark, sql, form, want):
    assert text(spark, sql, **form) == want


def test_fast_rounding_equals_round(spark):
    """Values with few decimals, their neighbours, ties, large and special values."""
    values = spark.range(0, 40_000, 1, 8).selectExpr("CAST(pmod(xxhash64(id), 2000000000000000) - 1000000000000000 AS DOUBLE) AS u", "id")
    shapes = ["u / 1e8D", "u / 1e2D", "u / 1e9D", "u / 1e15D", "(rint(u / 1e5D) + 0.5D) / 1e8D", "u / 1e8D * (1 + 2.220446049250313e-16D)",
              "u / 1e8D * (1 - 1.1102230246251565e-16D)", "u", "u * 1e290D", "rint(u / 1e12D)", "-0.0D", "double('NaN')", "double('-Infinity')",
              "CAST(NULL AS DOUBLE)", "u * 4.9e-324D"]
    for decimals in (8, 3, 0):
        for shape in shapes:
            df = values.selectExpr(f"{shape} AS v")
            wrong = df.selectExpr("v", f"CAST({rounded('v', decimals)} AS STRING) AS a", f"CAST(round(v, {decimals}) AS STRING) AS b").filter("NOT (a <=> b)")
            assert wrong.limit(3).collect() == [], (decimals, shape)


def test_row_json_keeps_columns_apart(spark):
    df = spark.createDataFrame([("a||b", "c"), ("a", "b||c"), (None, "x"), ("x", None)], "p string, q string")
    texts = {r[0] for r in df.selectExpr(row_json(df, ["q", "p"])).collect()}
    assert len(texts) == 4
    assert '{"p":null,"q":"x"}' in texts


def test_row_hash_is_sha256_of_the_json(spark):
    df = spark.createDataFrame([(1, "é\n\"", None)], "k int, a string, b int")
    got = with_row_hash(df, ["k", "a", "b"], ["k"]).first()["row_hash"]
    assert got == hashlib.sha256('{"a":"é\\n\\"","b":null}'.encode()).hexdigest()
    assert with_row_hash(df, ["k"], ["k"]).first()["row_hash"] == "no_compare_cols"


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, 2)], ["a`b", "it's"])
    assert df.selectExpr(row_json(df, df.columns)).first()[0] == '{"a`b":"1","it\'s":"2"}'
    assert df.selectExpr(key_json(["it's"], df)).first()[0] == '{"it\'s":"2"}'


@pytest.mark.parametrize(("tol", "want"), [(0.001, 3), (0.01, 2), (0.0, None), (-1, None), (1e-12, 12), (5.0, 0), (0.002, 3), (1e-8, 8)])
def test_decimals_for(tol, want):
    assert decimals_for(tol) == want


def differ(spark, a, b, tol=0.0):
    df = spark.sql(f"SELECT {a} AS a, {b} AS b")
    assert df.schema["a"].dataType == df.schema["b"].dataType
    value = df.selectExpr(differs("a", "b", df.schema["a"].dataType, tol)).first()[0]
    assert value is not None
    return value


@pytest.mark.parametrize(
    ("a", "b", "tol", "want"),
    [
        ("1.0D", "1.0005D", 0.001, False),
        ("1.0D", "1.01D", 0.001, True),
        ("1.0D", "1.0005D", 0.0, True),
        ("double('NaN')", "double('NaN')", 0.001, False),
        ("double('NaN')", "1D", 0.001, True),
        ("0.0D", "-0.0D", 0.0, False),
        ("double('Infinity')", "double('Infinity')", 0.001, False),
        ("double('Infinity')", "double('-Infinity')", 0.001, True),
        ("CAST(NULL AS DOUBLE)", "1D", 0.001, True),
        ("CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", 0.001, False),
        ("9007199254740993", "9007199254740992", 0.001, True),
        ("10", "12", 2.0, False),
        ("10", "13", 2.0, True),
        ("-9223372036854775808", "9223372036854775807", 5.0, True),
        ("CAST('1.001' AS DECIMAL(10,3))", "CAST('1.002' AS DECIMAL(10,3))", 0.001, False),
        ("CAST('1.001' AS DECIMAL(10,3))", "CAST('1.003' AS DECIMAL(10,3))", 0.001, True),
        ("CAST('1' AS DECIMAL(38,18))", "CAST('1.000000000000000001' AS DECIMAL(38,18))", 0.0, True),
        ("CAST('99999999999999999999' AS DECIMAL(38,18))", "CAST('-99999999999999999999' AS DECIMAL(38,18))", 0.001, True),
        ("X'0102'", "X'0102'", 0.001, False),
        ("array(1, 2)", "array(2, 1)", 0.001, True),
        ("map('a', 1, 'b', 2)", "map('b', 2, 'a', 1)", 0.001, False),
        ("map('a', 1)", "map('a', 2)", 0.001, True),
        ("'a'", "'a '", 0.001, True),
        ("'1.0'", "'1.0001'", 0.001, True),
        ("TIMESTAMP '2024-01-01 00:00:00.000001'", "TIMESTAMP '2024-01-01 00:00:00'", 0.001, True),
    ],
)
def test_differs(spark, a, b, tol, want):
    assert differ(spark, a, b, tol) is want
    assert differ(spark, b, a, tol) is want


def test_common_type():
    dec = T.DecimalType
    assert common_type(T.IntegerType(), T.LongType()) == T.LongType()
    assert common_type(T.FloatType(), T.DoubleType()) == T.DoubleType()
    assert common_type(dec(10, 2), T.LongType()) == dec(21, 2)
    assert common_type(dec(38, 0), dec(38, 18)) is None
    assert common_type(dec(10, 2), T.DoubleType()) == T.DoubleType()
    assert common_type(T.TimestampType(), T.TimestampNTZType()) == T.TimestampType()
    assert common_type(T.TimestampNTZType(), T.TimestampNTZType()) == T.TimestampType()
    assert common_type(T.StringType(), T.IntegerType()) is None
    assert common_type(T.DateType(), T.TimestampType()) == common_type(T.TimestampNTZType(), T.DateType()) == T.TimestampType()
    assert common_type(T.LongType(), T.DoubleType()) == dec(38, 18) and common_type(T.IntegerType(), T.DoubleType()) == T.DoubleType()


def test_evidence_text(spark):
    df = spark.createDataFrame([(bytearray(b"\x01"), datetime(2024, 1, 1, 0, 0, 0, 5), Decimal("1.50"), {"b": 1, "a": None})],
                               "a binary, b timestamp, c decimal(5,2), d map<string,int>")
    got = df.selectExpr(*[as_text(sqltext.name(f.name), f.dataType) for f in df.schema.fields]).first()
    assert tuple(got) == ("01", "2024-01-01 00:00:00.000005", "1.50", '{"a":null,"b":1}')


def test_rows_helper_sorts(spark):
    assert rows(spark.createDataFrame([(2,), (1,)], "a int")) == [(1,), (2,)]
