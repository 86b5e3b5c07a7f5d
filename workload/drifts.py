"""Drift injection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from evenkeel import TableSpec, compare
from evenkeel.operators import drift
from evenkeel.plans.scenario import apply_mutation
from workload.inputs import ORDERS_NOW, load

_KEY = ["o_orderkey"]
_AT = ORDERS_NOW
_AT_SQL = "TIMESTAMP '2000-01-01 00:30:00'"
_NEWEST = "(SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT {n})"


def _orders(spark, d):
    return load(spark, d, "orders")


def _events(spark, d):
    return load(spark, d, "events").select("user_id", "event_type")


def drift_noop(spark, d):
    """An unchanged copy must pass."""
    orders = _orders(spark, d)
    return compare(orders, drift.noop(orders), TableSpec("orders", "hash", keys=("o_orderkey",))).outcome


def drift_delete(spark, d):
    return drift.delete_rows(_orders(spark, d), _KEY, 50, "o_orderdate")


def drift_insert(spark, d):
    return drift.insert_extra_rows(_orders(spark, d), _KEY, _AT, 30, "o_orderdate")


def drift_update(spark, d):
    return drift.update_column(_orders(spark, d), _KEY, "o_orderpriority", F.lit("SCENARIO_1"), _AT, 20, "o_orderdate")


def drift_null_key(spark, d):
    return drift.null_out_key(_orders(spark, d), _KEY, 5)


def drift_delete_rows(spark, d):
    return drift.delete_rows_keyless(load(spark, d, "lineitem"), 7, "l_shipdate")


def drift_delete_copies(spark, d):
    """A row without a key goes with all its exact copies."""
    return drift.delete_rows_keyless(_events(spark, d), 2)


def drift_duplicate(spark, d):
    return drift.insert_extra_rows_keyless(load(spark, d, "lineitem"), count=3, filter_column="l_shipdate")


def drift_insert_mutated(spark, d):
    return drift.insert_extra_rows_keyless(load(spark, d, "lineitem"), _AT, 3, mutate=True, filter_column="l_shipdate")


def drift_swap(spark, d):
    return drift.content_swap_keyless(load(spark, d, "lineitem"), filter_column="l_shipdate")


def drift_update_fraction(spark, d):
    changes = {"o_orderstatus": F.lit("U"), "o_custkey": F.col("o_custkey") + 1}
    return drift.update_fraction(_orders(spark, d), _KEY, changes, _AT, 0.3, "o_orderdate")


_KEYED = ("noop", "delete_rows", "insert_extra_rows", "update_column", "null_out_pk")
_KEYLESS = ("delete_rows_no_pk", "insert_extra_rows_no_pk", "content_swap_no_pk")


def drift_detected(spark, d):
    """Every mutation that changes rows, injected into orders and found by a diff."""
    orders = _orders(spark, d)
    found = []
    for mutation in (*_KEYED, *_KEYLESS):
        damaged = apply_mutation(orders, mutation, {"column": "o_orderpriority"}, _KEY, _AT, "s1", "o_orderdate")
        spec = TableSpec("orders", "hash_no_pk" if mutation in _KEYLESS else "hash", keys=() if mutation in _KEYLESS else ("o_orderkey",))
        found.append(compare(orders, damaged, spec).outcome.drop("error_message").withColumn("mutation", F.lit(mutation)))
    return reduce(lambda a, b: a.unionByName(b), found)


QUERIES = {
    "drift_noop": drift_noop,
    "drift_delete": drift_delete,
    "drift_insert": drift_insert,
    "drift_update": drift_update,
    "drift_null_key": drift_null_key,
    "drift_delete_rows": drift_delete_rows,
    "drift_delete_copies": drift_delete_copies,
    "drift_duplicate": drift_duplicate,
    "drift_insert_mutated": drift_insert_mutated,
    "drift_swap": drift_swap,
    "drift_update_fraction": drift_update_fraction,
    "drift_detected": drift_detected,
}

_LINE_ORDER = "l_shipdate DESC, " + ", ".join(
    f"CAST({c} AS VARCHAR)" for c in ("l_discount", "l_extendedprice", "l_linenumber", "l_linestatus", "l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_suppkey", "l_tax")
)
_LINES = f"(SELECT * FROM lineitem ORDER BY {_LINE_ORDER} LIMIT {{n}})"
_SHARE = "CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) < 1288490188"


def _found(mutation, mode, source, target, only_source, only_target, changed, raw, match="source_count = target_count"):
    return f"""SELECT '{mutation}' AS mutation, '{mode}' AS comparison_mode, {source} AS source_count, {target} AS target_count, {match} AS count_match,
      CAST({only_source} AS BIGINT) AS rows_only_in_source, CAST({only_target} AS BIGINT) AS rows_only_in_target,
      CAST({changed} AS BIGINT) AS rows_with_mismatches, '{raw}' AS raw_status FROM c"""


ORACLES = {
    "drift_noop": """SELECT 'hash' AS comparison_mode, COUNT(*) AS source_count, COUNT(*) AS target_count, TRUE AS count_match,
        CAST(0 AS BIGINT) AS rows_only_in_source, CAST(0 AS BIGINT) AS rows_only_in_target, CAST(0 AS BIGINT) AS rows_with_mismatches,
        'PASS' AS raw_status, CAST(NULL AS VARCHAR) AS error_message FROM orders""",
    "drift_delete": f"SELECT * FROM orders WHERE o_orderkey NOT IN {_NEWEST.format(n=50)}",
    "drift_insert": f"""SELECT * FROM orders UNION ALL SELECT * REPLACE (o_orderkey + (SELECT MAX(o_orderkey) FROM orders) + 10000000 AS o_orderkey,
        {_AT_SQL} AS o_orderdate) FROM orders WHERE o_orderkey IN {_NEWEST.format(n=30)}""",
    "drift_update": f"""SELECT * REPLACE (CASE WHEN o_orderkey IN {_NEWEST.format(n=20)} THEN 'SCENARIO_1' ELSE o_orderpriority END AS o_orderpriority,
        CASE WHEN o_orderkey IN {_NEWEST.format(n=20)} THEN {_AT_SQL} ELSE o_orderdate END AS o_orderdate) FROM orders""",
    "drift_null_key": "SELECT * REPLACE (CASE WHEN o_orderkey NOT IN (SELECT o_orderkey FROM orders ORDER BY 1 LIMIT 5) THEN o_orderkey END AS o_orderkey) FROM orders",
    "drift_delete_rows": f"SELECT * FROM lineitem EXCEPT ALL SELECT * FROM {_LINES.format(n=7)}",
    "drift_delete_copies": """SELECT user_id, event_type FROM events WHERE (user_id, event_type) NOT IN
        (SELECT (user_id, event_type) FROM (SELECT user_id, event_type FROM events ORDER BY event_type, CAST(user_id AS VARCHAR) LIMIT 2))""",
    "drift_duplicate": f"SELECT * FROM lineitem UNION ALL SELECT * FROM {_LINES.format(n=3)}",
    "drift_insert_mutated": f"SELECT * FROM lineitem UNION ALL SELECT * REPLACE (l_returnflag || '_scn' AS l_returnflag, {_AT_SQL} AS l_shipdate) FROM {_LINES.format(n=3)}",
    "drift_swap": f"""SELECT * FROM (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM {_LINES.format(n=1)})
        UNION ALL SELECT * REPLACE (l_returnflag || '_swap' AS l_returnflag) FROM {_LINES.format(n=1)}""",
    "drift_update_fraction": f"""SELECT * REPLACE (CASE WHEN {_SHARE} THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN {_SHARE} THEN o_custkey + 1 ELSE o_custkey END AS o_custkey, CASE WHEN {_SHARE} THEN {_AT_SQL} ELSE o_orderdate END AS o_orderdate) FROM orders""",
    "drift_detected": f"""WITH c AS (SELECT COUNT(*) AS n FROM orders) SELECT * FROM (
        {_found("noop", "hash", "n", "n", 0, 0, 0, "PASS")}
        UNION ALL {_found("delete_rows", "hash", "n", "n - 50", 50, 0, 0, "FAIL")}
        UNION ALL {_found("insert_extra_rows", "hash", "n", "n + 30", 0, 30, 0, "FAIL")}
        UNION ALL {_found("update_column", "hash", "n", "n", 0, 0, 20, "FAIL")}
        UNION ALL {_found("null_out_pk", "hash", "n", "n", "NULL", "NULL", "NULL", "DATA_QUALITY_ERROR", "NULL")}
        UNION ALL {_found("delete_rows_no_pk", "hash_no_pk", "n", "n - 1", 1, 0, 0, "FAIL")}
        UNION ALL {_found("insert_extra_rows_no_pk", "hash_no_pk", "n", "n + 1", 0, 1, 0, "FAIL")}
        UNION ALL {_found("content_swap_no_pk", "hash_no_pk", "n", "n", 1, 1, 0, "INCONCLUSIVE")})""",
}
