"""Stored tables: merges that rewrite few files, copies that can be repeated, schemas that grow."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.sources import copies, evolution, merges
from evenkeel.sources.tables import CopyJob, copy_tables, scratch_path
from workload.inputs import load

_SHIPPED = (datetime(1995, 3, 10, 12), datetime(1995, 6, 2, 8))


def _parts(spark, d):
    """Orders as a table with a folder and a file per priority, and a source for some of them."""
    orders = load(spark, d, "orders")
    path = scratch_path(spark, "orders")
    merges.merge_touched(path, orders.filter("o_orderkey % 10 <> 0"), ["o_orderkey"], partition_by=["o_orderpriority"])
    source = orders.filter("o_orderpriority IN ('1-URGENT', '3-MEDIUM') AND o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("N"))
    return path, source


def merge_touched(spark, d):
    """The rows after a merge that concerns two of five partitions."""
    path, source = _parts(spark, d)
    merges.merge_touched(path, source, ["o_orderkey"])
    return spark.read.parquet(path)


def merge_touched_files(spark, d):
    """What that merge did to the files: by partition, what became of the files that were there before."""
    path, source = _parts(spark, d)
    files = merges.merge_touched(path, source, ["o_orderkey"]).files(spark).filter("action <> 'added'")
    part = F.regexp_extract("file", "o_orderpriority=([^/]*)/", 1)
    return files.select(part.alias("o_orderpriority"), "action").distinct()


def merge_into_table(spark, d):
    """A merge into a partitioned table of the catalog, as the catalog then reads it."""
    orders = load(spark, d, "orders")
    table = "merged_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    orders.filter("o_orderkey % 10 <> 0").write.partitionBy("o_orderstatus").saveAsTable(table)
    merges.merge_into_table(spark, table, orders.filter("o_orderkey % 7 = 0").withColumn("o_orderstatus", F.lit("N")), ["o_orderkey"])
    return spark.table(table).select(*orders.columns)


def copy_window_twice(spark, d):
    """Line items copied as they were, then a window once more after some of them changed or went."""
    lines = load(spark, d, "lineitem")
    path = scratch_path(spark, "copy")
    every = (datetime(1990, 1, 1), datetime(2010, 1, 1))
    copies.copy_window(lines, path, "l_shipdate", *every, period="month")
    changed = lines.filter("l_orderkey % 11 <> 0").withColumn("l_returnflag", F.expr("if(l_orderkey % 5 = 0, 'C', l_returnflag)"))
    for _ in range(2):
        copies.copy_window(changed, path, "l_shipdate", *_SHIPPED, period="month")
    return copies.read_copy(spark, path, T.StructType([*lines.schema.fields, T.StructField(copies.PERIOD, T.StringType())])).select(*lines.columns)


def copy_windows(spark, d):
    """Several tables by their windows, four at a time, twice over: what each copy holds in the end."""
    out = scratch_path(spark, "copies")
    jobs = [
        CopyJob("events", lambda: load(spark, d, "events"), f"{out}/events", window=("ts", datetime(2024, 1, 5), datetime(2024, 1, 12))),
        CopyJob("orders", lambda: load(spark, d, "orders"), f"{out}/orders", window=("o_orderdate", datetime(1996, 1, 1), datetime(1996, 2, 1))),
        CopyJob("customer", lambda: load(spark, d, "customer"), f"{out}/customer"),
        CopyJob("absent", lambda: load(spark, d, "absent"), f"{out}/absent", window=("ts", *_SHIPPED)),
    ]
    copy_tables(spark, jobs)
    report = copy_tables(spark, jobs).select("table_name", "status", "n_rows")
    held = None
    for n in ("events", "orders", "customer"):
        one = spark.read.parquet(f"{out}/{n}").agg(F.count(F.lit(1)).alias("held")).select(F.lit(n).alias("table_name"), "held")
        held = one if held is None else held.unionByName(one)
    return report.join(held, "table_name", "left")


def evolve_stored(spark, d):
    """Orders of three schemas in one table: narrow, then with wider types and later columns, read as one."""
    orders = load(spark, d, "orders")
    path = scratch_path(spark, "evolved")
    narrow = orders.filter("o_orderkey % 3 = 0").select(
        F.col("o_orderkey").cast("int").alias("o_orderkey"), "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"))
    evolution.store_schema(spark, path, narrow.schema)
    evolution.append_stored(narrow, path)
    wide = {"o_orderkey": T.LongType(), "o_orderdate": T.TimestampNTZType(), "o_totalprice": T.DecimalType(20, 4)}
    later = [("last_updated", T.TimestampNTZType(), evolution.Fill("last_updated", fill_from="o_orderdate"))]
    evolution.evolve_stored(spark, path, later, wide)
    second = orders.filter("o_orderkey % 3 = 1").select(
        "o_orderkey", "o_orderstatus", "o_orderdate", F.col("o_totalprice").cast("decimal(20,4)").alias("o_totalprice"),
        F.expr("if(o_orderkey % 2 = 0, o_orderdate + INTERVAL 1 HOUR, NULL) AS last_updated"))
    evolution.append_stored(second, path)
    for _ in range(2):  # a second run changes nothing
        evolution.evolve_stored(spark, path, [("origin", T.StringType(), evolution.Fill("origin", default="'before'"))])
    third = orders.filter("o_orderkey % 3 = 2").select(
        "o_orderkey", "o_orderstatus", "o_orderdate", F.col("o_totalprice").cast("decimal(20,4)").alias("o_totalprice"),
        F.lit("after").alias("origin"))
    evolution.append_stored(third, path)
    return evolution.read_evolved(spark, path)


QUERIES = {
    "merge_touched": merge_touched,
    "merge_touched_files": merge_touched_files,
    "merge_into_table": merge_into_table,
    "copy_window_twice": copy_window_twice,
    "copy_windows": copy_windows,
    "evolve_stored": evolve_stored,
}

_TAKEN = "o_orderpriority IN ('1-URGENT', '3-MEDIUM') AND o_orderkey % 3 = 0"
ORACLES = {
    "merge_touched": f"""SELECT * REPLACE (CASE WHEN {_TAKEN} THEN 'N' ELSE o_orderstatus END AS o_orderstatus) FROM orders
        WHERE o_orderkey % 10 <> 0 OR {_TAKEN}""",
    "merge_touched_files": """SELECT DISTINCT o_orderpriority, CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN 'rewritten' ELSE 'kept' END AS action
        FROM orders WHERE o_orderkey % 10 <> 0""",
    "merge_into_table": """SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0 THEN 'N' ELSE o_orderstatus END AS o_orderstatus) FROM orders
        WHERE o_orderkey % 10 <> 0 OR o_orderkey % 7 = 0""",
    "copy_window_twice": """SELECT * REPLACE (CASE WHEN l_orderkey % 5 = 0 AND l_shipdate >= TIMESTAMP '1995-03-01' AND l_shipdate < TIMESTAMP '1995-07-01'
          THEN 'C' ELSE l_returnflag END AS l_returnflag) FROM lineitem
        WHERE l_shipdate >= TIMESTAMP '1990-01-01' AND l_shipdate < TIMESTAMP '2010-01-01'
          AND NOT (l_orderkey % 11 = 0 AND l_shipdate >= TIMESTAMP '1995-03-01' AND l_shipdate < TIMESTAMP '1995-07-01')""",
    "copy_windows": """WITH n AS (
          SELECT 'events' AS table_name, COUNT(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'
          UNION ALL SELECT 'orders', COUNT(*) FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-02-01'
          UNION ALL SELECT 'customer', COUNT(*) FROM customer)
        SELECT table_name, 'success' AS status, n AS n_rows, n AS held FROM n UNION ALL SELECT 'absent', 'failed', 0, NULL""",
    "evolve_stored": """SELECT o_orderkey, o_orderstatus,
          CASE WHEN o_orderkey % 3 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) ELSE o_orderdate END AS o_orderdate,
          CAST(CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_totalprice AS DECIMAL(12, 2)) ELSE CAST(o_totalprice AS DECIMAL(20, 4)) END AS DECIMAL(20, 4)) AS o_totalprice,
          CASE WHEN o_orderkey % 3 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)
            WHEN o_orderkey % 6 = 4 THEN o_orderdate + INTERVAL 1 HOUR ELSE o_orderdate END AS last_updated,
          CASE WHEN o_orderkey % 3 = 2 THEN 'after' ELSE 'before' END AS origin FROM orders""",
}
