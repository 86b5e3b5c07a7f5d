"""Inputs of the registered queries, all derived from the given tables.

Each derived table is a list of SQL expressions that Spark and DuckDB read alike: Spark evaluates
them with ``selectExpr``, the reference SQL places them in a CTE. Operators never see this text.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.sources.window import use_utc

NOW = datetime(2024, 1, 20, 0, 30)  # inside the time span of ``events``
ORDERS_NOW = datetime(2000, 1, 1, 0, 30)  # inside the time span of ``orders``


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def derive(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


def derive_sql(columns: dict[str, str], table: str, where: str = "") -> str:
    body = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    return f"SELECT {body} FROM {table}" + (f" WHERE {where}" if where else "")


# --- orders and a drifted copy: rows lost, rows added, statuses and prices changed ---------------
DRIFT_STATUS = "CASE WHEN o_orderkey % 101 = 0 THEN 'X' ELSE o_orderstatus END"
DRIFT_PRICE = ("CASE WHEN o_orderkey % 103 = 0 THEN o_totalprice + 0.0005 "
               "WHEN o_orderkey % 107 = 0 THEN o_totalprice + 1 ELSE o_totalprice END")


def orders_pair(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    source = load(spark, folder, "orders")
    kept = (
        source.filter("o_orderkey % 97 <> 0")
        .withColumn("o_orderstatus", F.expr(DRIFT_STATUS))
        .withColumn("o_totalprice", F.expr(DRIFT_PRICE.replace("0.0005", "0.0005D")))
    )
    # negative keys cannot meet an existing one, at any scale
    added = source.filter("o_orderkey % 89 = 0").withColumn("o_orderkey", F.expr("-o_orderkey - 1"))
    return source, kept.unionByName(added)


ORDERS_PAIR_SQL = f"""
s AS (SELECT * FROM orders),
t AS (SELECT * REPLACE ({DRIFT_STATUS} AS o_orderstatus, {DRIFT_PRICE.replace("0.0005", "CAST(0.0005 AS DOUBLE)")} AS o_totalprice)
      FROM orders WHERE o_orderkey % 97 <> 0
      UNION ALL SELECT * REPLACE (-o_orderkey - 1 AS o_orderkey) FROM orders WHERE o_orderkey % 89 = 0)"""


# --- events without their key: real duplicates, some copies lost, some rows added -----------------
def events_pair(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    events = load(spark, folder, "events")
    source = events.select("user_id", "event_type")
    target = events.filter("event_id % 50 <> 0").select("user_id", "event_type").unionByName(
        events.filter("event_id % 200 = 1").select("user_id", F.lit("dup").alias("event_type"))
    )
    return source, target


EVENTS_PAIR_SQL = """
s AS (SELECT user_id, event_type FROM events),
t AS (SELECT user_id, event_type FROM events WHERE event_id % 50 <> 0
      UNION ALL SELECT user_id, 'dup' FROM events WHERE event_id % 200 = 1)"""

# --- config tables: one compared table per customer ----------------------------------------------
TABLE_OF_ORDER = "concat('cust_', CAST(o_custkey AS STRING))"

CONFIG = {
    "table_name": "concat(CASE WHEN c_custkey % 50 = 7 THEN '9 ' ELSE '' END, 'cust_', CAST(c_custkey AS STRING))",
    "source_schema": "concat('region', CASE WHEN c_custkey % 61 = 0 THEN '-' ELSE '' END, CAST(c_nationkey AS STRING))",
    "source_table_name": "CASE WHEN c_custkey % 3 = 0 THEN CAST(NULL AS STRING) ELSE concat('src_', CAST(c_custkey AS STRING)) END",
    "target_schema": "'copy'",
    "comparison_mode": "CASE c_custkey % 7 WHEN 0 THEN 'basic' WHEN 1 THEN 'hash_no_pk' WHEN 2 THEN 'advanced' WHEN 3 THEN 'advanced_no_pk' WHEN 4 THEN 'fingerprint' ELSE 'hash' END",
    "filter_column": "CASE WHEN c_custkey % 5 = 0 THEN 'created_at >= ''{window_start}'' OR last_updated >= ''{window_start}''' ELSE 'last_updated' END",
    "filter_column_source": "CASE WHEN c_custkey % 4 = 0 THEN 'modified_at' END",
    "filter_days": "CASE WHEN c_nationkey < 5 THEN CAST(NULL AS INT) ELSE CAST(c_nationkey % 10 AS INT) END",
    "safety_lag_minutes": "CASE WHEN c_nationkey % 3 = 0 THEN CAST(NULL AS INT) ELSE CAST(c_nationkey * 5 AS INT) END",
    "schema_drift_policy": "CASE c_custkey % 9 WHEN 0 THEN 'intersect' WHEN 1 THEN 'ignore_extra' WHEN 2 THEN 'merge' ELSE 'fail' END",
    "numeric_tolerance": "CASE c_custkey % 4 WHEN 0 THEN CAST(NULL AS DOUBLE) WHEN 1 THEN CAST(0 AS DOUBLE) ELSE CAST(0.25 AS DOUBLE) END",
    "max_rows_advanced": "CASE WHEN c_custkey % 6 = 0 THEN CAST(NULL AS INT) ELSE CAST(c_nationkey * 1000 AS INT) END",
    "severity": "CASE c_mktsegment WHEN 'BUILDING' THEN 'critical' WHEN 'MACHINERY' THEN 'urgent' ELSE 'warning' END",
    "enabled": "c_acctbal > 0",
    "pk_fallback_strategy": "CASE c_custkey % 5 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN 'NO_PK_HASH' WHEN 2 THEN 'no_pk_advanced' WHEN 3 THEN 'no_pk_hash' ELSE 'fail' END",
}
KEY_COLUMNS = {
    "table_name": TABLE_OF_ORDER,
    "column_name": "CASE o_orderkey % 5 WHEN 0 THEN 'tenant_id' WHEN 1 THEN 'entity_id' WHEN 2 THEN 'version' WHEN 3 THEN 'entity id' ELSE 'id' END",
    "ordinal": "CAST(CASE o_orderkey % 5 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 5 WHEN 3 THEN 4 ELSE 1 END AS INT)",
}
SKIP_COLUMNS = {
    "table_name": TABLE_OF_ORDER,
    "column_name": "CASE o_orderkey % 4 WHEN 0 THEN 'created_at' WHEN 1 THEN 'etl_batch_id' WHEN 2 THEN 'notes' ELSE 'id' END",
}


def configs(spark: SparkSession, folder: str) -> DataFrame:
    return derive(load(spark, folder, "customer"), CONFIG)


def key_columns(spark: SparkSession, folder: str) -> DataFrame:
    return derive(load(spark, folder, "orders"), KEY_COLUMNS)


def skip_columns(spark: SparkSession, folder: str) -> DataFrame:
    return derive(load(spark, folder, "orders"), SKIP_COLUMNS)


CONFIG_SQL = f"""
cfg AS ({derive_sql(CONFIG, "customer")}),
kc AS ({derive_sql(KEY_COLUMNS, "orders")}),
sc AS ({derive_sql(SKIP_COLUMNS, "orders")})"""

LOADED_SQL = f"""{CONFIG_SQL},
k2 AS (SELECT table_name, column_name, MIN(ordinal) AS ordinal FROM kc GROUP BY 1, 2),
k1 AS (SELECT table_name, list(column_name ORDER BY ordinal, column_name) AS key_cols FROM k2 GROUP BY 1),
s1 AS (SELECT table_name, list(DISTINCT column_name ORDER BY column_name) AS skip_cols FROM sc GROUP BY 1),
loaded AS (SELECT cfg.*, COALESCE(k1.key_cols, []) AS key_cols, COALESCE(s1.skip_cols, []) AS skip_cols
           FROM cfg LEFT JOIN k1 USING (table_name) LEFT JOIN s1 USING (table_name) WHERE enabled)"""

# --- results: one compared (run, table) per supplier and part -------------------------------------
OUTCOME_KEYS = {
    "run_id": "concat('run_', CAST(l_suppkey AS STRING))",
    "table_name": "concat('part_', CAST(l_partkey AS STRING))",
}
OUTCOME_AGGREGATES = {
    "part": "MIN(l_partkey)",
    "source_count": "CASE WHEN MIN(l_partkey) % 13 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(COUNT(*) AS BIGINT) END",
    "target_count": "CASE WHEN MIN(l_partkey) % 13 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(COUNT(*) + SUM(CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -1 WHEN l_linenumber = 2 AND l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) END",
    "rows_only_in_source": "CASE WHEN MIN(l_partkey) % 13 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(SUM(CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 1 ELSE 0 END) AS BIGINT) END",
    "rows_only_in_target": "CASE WHEN MIN(l_partkey) % 13 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(SUM(CASE WHEN l_returnflag = 'A' AND l_linenumber = 2 THEN 1 ELSE 0 END) AS BIGINT) END",
    "rows_with_mismatches": "CASE WHEN MIN(l_partkey) % 13 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(SUM(CASE WHEN l_linestatus = 'F' AND l_linenumber = 4 THEN 1 ELSE 0 END) AS BIGINT) END",
    "executed_at": "MAX(l_shipdate)",
}
OUTCOME_DERIVED = {
    "comparison_mode": "CASE WHEN part % 3 = 0 THEN 'advanced' ELSE 'hash' END",
    "count_match": "source_count = target_count",
    "raw_status": "CASE WHEN source_count IS NULL THEN 'DATA_QUALITY_ERROR' "
                  "WHEN rows_only_in_source + rows_only_in_target + rows_with_mismatches = 0 THEN 'PASS' "
                  "WHEN source_count = target_count AND rows_with_mismatches = 0 THEN 'INCONCLUSIVE' ELSE 'FAIL' END",
}


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    grouped = derive(load(spark, folder, "lineitem"), {**OUTCOME_KEYS, **{c: c for c in (
        "l_partkey", "l_returnflag", "l_linestatus", "l_linenumber", "l_shipdate")}})
    out = grouped.groupBy(*OUTCOME_KEYS).agg(*[F.expr(e).alias(n) for n, e in OUTCOME_AGGREGATES.items()])
    for name, e in OUTCOME_DERIVED.items():
        out = out.withColumn(name, F.expr(e))
    return out


OUTCOMES_SQL = f"""
o1 AS ({derive_sql({**OUTCOME_KEYS, **OUTCOME_AGGREGATES}, "lineitem")} GROUP BY 1, 2),
outcomes AS (SELECT *, {", ".join(f"{e} AS {n}" for n, e in OUTCOME_DERIVED.items())} FROM o1),
judged AS (SELECT *, CASE raw_status WHEN 'PASS' THEN 'pass' WHEN 'INCONCLUSIVE' THEN 'inconclusive' WHEN 'DATA_QUALITY_ERROR' THEN 'error'
             ELSE CASE WHEN NOT count_match THEN 'count_mismatch' ELSE 'hash_mismatch' END END AS status,
             CAST(COALESCE(rows_only_in_source, 0) + COALESCE(rows_only_in_target, 0) + COALESCE(rows_with_mismatches, 0) AS BIGINT) AS mismatch_count
           FROM outcomes)"""

# --- scenarios: one per order, on the customer's table --------------------------------------------
SCENARIO = {
    "scenario_id": "concat('scn_', CAST(o_orderkey AS STRING))",
    "target_table": TABLE_OF_ORDER,
    "mutation_type": "CASE o_orderkey % 11 WHEN 0 THEN 'noop' WHEN 1 THEN 'delete_rows' WHEN 2 THEN 'insert_extra_rows' WHEN 3 THEN 'update_column' "
                     "WHEN 4 THEN 'add_extra_column' WHEN 5 THEN 'drop_column' WHEN 6 THEN 'null_out_pk' WHEN 7 THEN 'clear_key_cols' "
                     "WHEN 8 THEN 'delete_rows_no_pk' WHEN 9 THEN 'insert_extra_rows_no_pk' ELSE 'content_swap_no_pk' END",
    "column": "CASE o_orderkey % 6 WHEN 0 THEN 'id' WHEN 1 THEN 'notes' WHEN 2 THEN 'last_updated' WHEN 3 THEN 'etl_batch_id' WHEN 4 THEN 'tenant_id' ELSE 'status' END",
    "n": "CAST(o_orderkey % 13 AS INT)",
    "mutate": "o_orderkey % 2 = 0",
    "expected_status": "CASE o_orderkey % 4 WHEN 0 THEN 'pass' WHEN 1 THEN 'hash_mismatch' WHEN 2 THEN 'count_mismatch' ELSE 'error' END",
    "valid_comparison_modes": "CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '2-HIGH' THEN 'hash_no_pk, advanced_no_pk' WHEN '3-MEDIUM' THEN 'basic,hash' ELSE 'hash,advanced' END",
    "enabled": "o_orderstatus <> 'P'",
    "run_id": "CASE WHEN o_orderkey % 37 = 0 THEN CAST(NULL AS STRING) ELSE concat('run_', CAST(o_orderkey AS STRING)) END",
    "seeder_status": "CASE WHEN o_orderkey % 41 = 0 THEN 'not_applicable' ELSE 'applied' END",
}


def scenarios(spark: SparkSession, folder: str) -> DataFrame:
    """Scenarios with their parameters as JSON text, which is how they are stored."""
    params = F.to_json(F.struct(
        F.col("n").alias("count"), "column", F.col("column").alias("column_name"), "mutate",
        F.lit("requires entries").alias("expected_error_substring"),
    ))
    return derive(load(spark, folder, "orders"), SCENARIO).withColumn("mutation_params", params)


SCENARIO_SQL = f"""scn AS ({derive_sql({(f'"{k}"' if k == "column" else k): v for k, v in SCENARIO.items()}, "orders")})"""
