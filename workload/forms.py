"""Values in another form: JSON documents, padded text, renamed columns, and numbers beside doubles."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel import TableSpec, compare
from evenkeel.functions.normal import normalised
from evenkeel.operators.renames import column_renames as find_renames
from evenkeel.sources.tables import snapshot
from workload.inputs import load

_MODES = ("hash", "advanced", "hash_no_pk", "advanced_no_pk")


def _in_all_modes(source, target, key, json_columns=(), **spec):
    """The four row modes' outcomes, as their counts and status. JSON is parsed once for all of them."""
    if json_columns:
        source, target = (snapshot(normalised(df, json_columns), "json") for df in (source, target))
    out = None
    for mode in _MODES:
        one = compare(source, target, TableSpec("t", mode, keys=(key,), **spec)).outcome.selectExpr(
            "comparison_mode", "source_count", "target_count", "rows_only_in_source + rows_only_in_target + rows_with_mismatches AS n_differences", "raw_status")
        out = one if out is None else out.unionByName(one)
    return out


def diff_json(spark, d):
    """JSON whose keys come back in another order: some with a number that became a string, some broken."""
    orders = load(spark, d, "orders")
    price = "CAST(o_totalprice AS STRING)"
    given = f"""if(o_orderkey % 9 = 1, concat('{{broken ', o_orderkey), concat('{{"status":"', o_orderstatus, '","items":[1, {{"b":', o_custkey, ',"a":null}}],"price":', {price}, '}}'))"""
    stored = f"""if(o_orderkey % 9 = 1, concat('{{broken ', o_orderkey), concat('{{ "price": ', {price}, ', "items": [1,{{"a":null, "b": ',
        if(o_orderkey % 40 = 3, concat('"', o_custkey, '"'), CAST(o_custkey AS STRING)), '}}], "status" : "', o_orderstatus, '" }}'))"""
    source, target = (orders.selectExpr("o_orderkey", f"{e} AS payload") for e in (given, stored))
    return _in_all_modes(source, target, "o_orderkey", json_columns=("payload",))


def diff_collated(spark, d):
    """Keys padded with blanks and codes in another case, as CHAR and case-blind columns give them back."""
    orders = load(spark, d, "orders")
    source = orders.selectExpr("concat('key ', o_orderkey) AS id", "o_orderpriority AS code", "o_orderstatus AS plain")
    target = orders.selectExpr("rpad(concat('key ', o_orderkey), 20, ' ') AS id", "if(o_orderkey % 30 = 7, concat(' ', o_orderpriority), concat(lower(o_orderpriority), '  ')) AS code",
                               "if(o_orderkey % 50 = 1, concat(o_orderstatus, ' '), o_orderstatus) AS plain")
    return _in_all_modes(source, target, "id", collations=(("id", "UTF8_BINARY_RTRIM"), ("code", "UTF8_LCASE_RTRIM")))


def diff_wide_numbers(spark, d):
    """Decimals of 38 digits and bigints beside doubles: off by one beyond 2^53, and by less than any place of a decimal."""
    orders = load(spark, d, "orders")
    even = "9007199254740992L + 2 * o_orderkey"
    source = orders.selectExpr("o_orderkey", f"CAST({even} + if(o_orderkey % 10 = 3, 1, 0) AS DECIMAL(38,0)) AS a", "0L AS b")
    target = orders.selectExpr("o_orderkey", f"CAST({even} AS DOUBLE) AS a", "if(o_orderkey % 25 = 4, 1e-20D, 0D) AS b")
    return _in_all_modes(source, target, "o_orderkey", tolerance=0.0)


def column_renames(spark, d):
    """Orders with columns renamed, one of them after rows were lost and prices changed, one under two names."""
    orders = load(spark, d, "orders")
    target = orders.filter("o_orderkey % 50 <> 0").select(
        "o_orderkey", F.col("o_custkey").alias("customer"), F.expr("if(o_orderkey % 60 = 1, o_totalprice + 1, o_totalprice) AS amount"),
        F.col("o_orderdate").alias("placed_on"), F.expr("o_orderstatus AS state"), F.expr("o_orderstatus AS state_again"), F.expr("concat('x', o_orderkey) AS fresh"))
    same = orders.select("o_orderkey", F.col("o_orderdate").alias("day"), F.col("o_orderpriority").alias("urgency"),
                         F.col("o_orderpriority").alias("urgency_again"), F.col("o_custkey").alias("customer"))
    out = [find_renames(orders, t).select(F.lit(n).alias("copy"), "source_column", "target_column", "match", "unique") for n, t in (("drifted", target), ("equal", same))]
    return out[0].unionByName(out[1])


QUERIES = {
    "diff_json": diff_json,
    "diff_collated": diff_collated,
    "diff_wide_numbers": diff_wide_numbers,
    "column_renames": column_renames,
}


def _modes_sql(differs: str) -> str:
    """Outcomes of the four modes if rows with ``differs`` differ: one difference with a key, two without."""
    parts = []
    for mode in _MODES:
        keyless = mode.endswith("_no_pk")
        parts.append(f"""SELECT '{mode}' AS comparison_mode, COUNT(*) AS source_count, COUNT(*) AS target_count,
          {2 if keyless else 1} * COUNT(*) FILTER ({differs}) AS n_differences,
          CASE WHEN COUNT(*) FILTER ({differs}) = 0 THEN 'PASS' ELSE '{'INCONCLUSIVE' if keyless else 'FAIL'}' END AS raw_status FROM orders""")
    return " UNION ALL ".join(parts)


def _texts(columns: dict[str, str], where: str) -> str:
    """(column, value, number of rows) of some columns as text."""
    return " UNION ALL ".join(f"SELECT '{n}' AS c, CAST({e} AS VARCHAR) AS v, COUNT(*) AS n FROM orders WHERE {where} GROUP BY 2" for n, e in columns.items())


def _renames_sql(copy: str, lone: list[str], renamed: dict[str, str], where: str) -> str:
    return f"""SELECT '{copy}' AS copy, x.c AS source_column, y.c AS target_column, x.size AS nx, y.size AS ny,
        (SELECT COUNT(*) FROM s{copy} a JOIN t{copy} b ON a.v = b.v WHERE a.c = x.c AND b.c = y.c) AS common,
        (SELECT COUNT(*) FROM s{copy} a JOIN t{copy} b ON a.v = b.v AND a.n = b.n WHERE a.c = x.c AND b.c = y.c) AS equal
        FROM (SELECT c, COUNT(*) AS size FROM s{copy} GROUP BY c) x CROSS JOIN (SELECT c, COUNT(*) AS size FROM t{copy} GROUP BY c) y"""


_DRIFTED = {"customer": "o_custkey", "amount": "CASE WHEN o_orderkey % 60 = 1 THEN o_totalprice + 1 ELSE o_totalprice END", "placed_on": "o_orderdate",
            "state": "o_orderstatus", "state_again": "o_orderstatus", "fresh": "'x' || o_orderkey"}
_EQUAL = {"day": "o_orderdate", "urgency": "o_orderpriority", "urgency_again": "o_orderpriority", "customer": "o_custkey"}
_GONE = ["o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority"]

ORACLES = {
    "diff_json": _modes_sql("o_orderkey % 40 = 3 AND o_orderkey % 9 <> 1"),
    "diff_collated": _modes_sql("o_orderkey % 30 = 7 OR o_orderkey % 50 = 1"),
    "diff_wide_numbers": _modes_sql("o_orderkey % 10 = 3 OR o_orderkey % 25 = 4"),
    "column_renames": f"""WITH sdrifted AS ({_texts({c: c for c in _GONE}, "TRUE")}), tdrifted AS ({_texts(_DRIFTED, "o_orderkey % 50 <> 0")}),
        sequal AS (SELECT * FROM sdrifted), tequal AS ({_texts(_EQUAL, "TRUE")}),
        p AS ({_renames_sql("drifted", _GONE, _DRIFTED, "")} UNION ALL {_renames_sql("equal", _GONE, _EQUAL, "")}),
        m AS (SELECT copy, source_column, target_column, nx = equal AND ny = equal AS same FROM p WHERE common >= 0.8 * (nx + ny - common)),
        r AS (SELECT *, COUNT(*) FILTER (same) OVER (PARTITION BY copy, source_column) AS si, COUNT(*) OVER (PARTITION BY copy, source_column) AS sa,
          COUNT(*) FILTER (same) OVER (PARTITION BY copy, target_column) AS ti, COUNT(*) OVER (PARTITION BY copy, target_column) AS ta FROM m)
        SELECT copy, source_column, target_column, CASE WHEN same THEN 'identical' ELSE 'similar' END AS match,
          CASE WHEN same THEN si = 1 AND ti = 1 ELSE sa = 1 AND ta = 1 END AS "unique" FROM r WHERE same OR (si = 0 AND ti = 0)""",
}
