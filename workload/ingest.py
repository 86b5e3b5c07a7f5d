"""Copies, merges and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.operators.columns import coerce_complex_to_json as coerce
from evenkeel.operators.merge import check_merge_source, upsert_merge as merge
from evenkeel.sources import tables as t
from workload.inputs import load


def discover_tables(spark, d):
    """The tables of the folder, each with its width and number of rows."""
    return t.table_counts({name: load(spark, d, name) for name in t.discover_tables(spark, d)})


def copy_table(spark, d):
    """What a copy reads back as."""
    path = t.scratch_path(spark, "copy")
    t.copy_table(load(spark, d, "orders"), path)
    return spark.read.parquet(path)


def copy_summary(spark, d):
    """A bulk copy in which one table has a bad name and one does not exist."""
    out = t.scratch_path(spark, "copies")
    jobs = [t.CopyJob(n, lambda n=n: load(spark, d, n), f"{out}/{n}") for n in t.discover_tables(spark, d)]
    jobs += [t.CopyJob("bad name", lambda: load(spark, d, "orders"), f"{out}/bad"), t.CopyJob("absent", lambda: load(spark, d, "absent"), f"{out}/absent")]
    return t.copy_summary(t.copy_tables(spark, jobs)).drop("seconds")


def _orders(spark, d):
    orders = load(spark, d, "orders")
    source = orders.filter("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("N"))
    return orders.filter("o_orderkey % 10 <> 0"), source


def upsert_merge(spark, d):
    target, source = _orders(spark, d)
    check_merge_source(source, ["o_orderkey"])
    return merge(target, source, ["o_orderkey"])


def merge_into(spark, d):
    """A table that is merged into where it lies, twice."""
    path = t.scratch_path(spark, "merged")
    target, source = _orders(spark, d)
    t.merge_into(path, target, ["o_orderkey"])
    return t.merge_into(path, source, ["o_orderkey"])


def upsert_merge_delete(spark, d):
    target, source = _orders(spark, d)
    check_merge_source(source, ["o_orderkey"])
    return merge(target, source, ["o_orderkey"], delete_unmatched=True)


def upsert_merge_partial(spark, d):
    """The target holds copies of a key, the source has fewer columns: every copy is updated, new rows
    get nulls."""
    target = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey")
    source = load(spark, d, "orders").filter("o_orderkey % 4 <> 1").select(
        F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit("M").alias("l_returnflag")
    )
    check_merge_source(source, ["l_orderkey", "l_linenumber"])
    return merge(target, source, ["l_orderkey", "l_linenumber"])


def coerce_complex_to_json(spark, d):
    shaped = load(spark, d, "orders").select(
        "o_orderkey",
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
        F.struct("o_custkey", "o_orderstatus").alias("detail"),
        F.create_map(F.lit("customer"), "o_custkey").alias("refs"),
    )
    return coerce(shaped)


QUERIES = {
    "discover_tables": discover_tables,
    "copy_table": copy_table,
    "copy_summary": copy_summary,
    "upsert_merge": upsert_merge,
    "merge_into": merge_into,
    "upsert_merge_delete": upsert_merge_delete,
    "upsert_merge_partial": upsert_merge_partial,
    "coerce_complex_to_json": coerce_complex_to_json,
}

_WIDTHS = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6, "documents": 5,
    "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4,
}

ORACLES = {
    "discover_tables": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, CAST({w} AS INT) AS n_columns, COUNT(*) AS n_rows FROM {n}" for n, w in _WIDTHS.items()),
    "copy_table": "SELECT * FROM orders",
    "copy_summary": f"""SELECT 'success' AS status, CAST({len(_WIDTHS)} AS BIGINT) AS n_tables,
          CAST({" + ".join(f"(SELECT COUNT(*) FROM {n})" for n in _WIDTHS)} AS BIGINT) AS n_rows
        UNION ALL SELECT 'failed', 2, 0""",
    "upsert_merge": """SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 'N' ELSE o_orderstatus END AS o_orderstatus) FROM orders
        WHERE o_orderkey % 10 <> 0 OR o_orderkey % 3 = 0""",
    "merge_into": """SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 'N' ELSE o_orderstatus END AS o_orderstatus) FROM orders
        WHERE o_orderkey % 10 <> 0 OR o_orderkey % 3 = 0""",
    "upsert_merge_delete": "SELECT * REPLACE ('N' AS o_orderstatus) FROM orders WHERE o_orderkey % 3 = 0",
    "upsert_merge_partial": """WITH t AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_partkey FROM lineitem),
        s AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 4 <> 1)
        SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 AND l_orderkey IN (SELECT o_orderkey FROM s) THEN 'M' ELSE l_returnflag END AS l_returnflag, l_partkey FROM t
        UNION ALL SELECT o_orderkey, 1, 'M', NULL FROM s WHERE o_orderkey NOT IN (SELECT l_orderkey FROM t WHERE l_linenumber = 1)""",
    "coerce_complex_to_json": """SELECT o_orderkey, '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS tags,
        '{"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS detail, '{"customer":' || o_custkey || '}' AS refs FROM orders""",
}
