"""Verdicts, run reports and trends."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from evenkeel import TableSpec, run_tables
from evenkeel.operators.drift import add_extra_column
from evenkeel.plans import verdict as v
from evenkeel.plans.compare import TablePair
from evenkeel.sources.tables import scratch_path
from workload.inputs import NOW, ORDERS_PAIR_SQL, OUTCOMES_SQL, load, orders_pair, outcomes

_TREND_NOW = "TIMESTAMP '2001-06-01 00:00:00'"


def verdict(spark, d):
    return v.with_verdict(outcomes(spark, d)).select("run_id", "table_name", "raw_status", "status", "mismatch_count")


def run_summary(spark, d):
    return v.run_summary(v.with_verdict(outcomes(spark, d)))


def run_digest(spark, d):
    return v.run_digest(v.with_verdict(outcomes(spark, d)))


def latest_results(spark, d):
    return v.latest_results(v.with_verdict(outcomes(spark, d))).select("table_name", "run_id", "executed_at", "status")


def failure_trend(spark, d):
    return v.failure_trend(v.with_verdict(outcomes(spark, d)), datetime(2001, 6, 1), 365)


def table_pairs(spark, d) -> list[TablePair]:
    """One pair per kind of ending: differences, a window, missing keys, tolerance, drift, equal, unknown."""
    def table(name):
        return lambda: load(spark, d, name)

    def events():
        return load(spark, d, "events").filter("event_id % 50 <> 0").withColumn(
            "event_type", F.expr("CASE WHEN event_id % 60 = 1 THEN 'changed' ELSE event_type END"))

    def customers():
        return load(spark, d, "customer").withColumn("c_acctbal", F.col("c_acctbal") + 0.0004)

    equal = {"region": ("r_regionkey",), "documents": ("doc_id",), "embeddings": ("vec_id",), "pages": ("page_id",), "benchmark": ("item_id",),
             "labels": ("doc_id",), "conversations": ("conv_id", "turn")}
    return [
        *[TablePair(TableSpec(name, "hash", keys=keys), table(name), table(name)) for name, keys in equal.items()],
        TablePair(TableSpec("orders", "hash", keys=("o_orderkey",)), lambda: orders_pair(spark, d)[0], lambda: orders_pair(spark, d)[1]),
        TablePair(TableSpec("events", "hash", keys=("event_id",), filter_column="ts"), table("events"), events),
        TablePair(TableSpec("lineitem", "advanced"), table("lineitem"), table("lineitem")),
        TablePair(TableSpec("customer", "advanced", keys=("c_custkey",)), table("customer"), customers),
        TablePair(TableSpec("part", "hash", keys=("p_partkey",)), table("part"), lambda: add_extra_column(load(spark, d, "part"))),
        TablePair(TableSpec("supplier", "basic", keys=("s_suppkey",)), table("supplier"), table("supplier")),
        TablePair(TableSpec("nation", "fingerprint"), table("nation"), table("nation")),
    ]


def validation_results(spark, d):
    """A whole run: results and samples are written, then read back."""
    out = scratch_path(spark, "run")
    results = run_tables(spark, table_pairs(spark, d), "run_1", NOW, f"{out}/results", f"{out}/samples")
    return results.drop("duration_seconds")


def run_row(spark, d):
    """What a run leaves of itself."""
    out = scratch_path(spark, "run")
    run_tables(spark, table_pairs(spark, d), "run_1", NOW, f"{out}/results", f"{out}/samples", run_path=f"{out}/runs")
    return v.run_rows(spark, f"{out}/runs").drop("ended_at")


QUERIES = {
    "run_row": run_row,
    "verdict": verdict,
    "run_summary": run_summary,
    "run_digest": run_digest,
    "latest_results": latest_results,
    "failure_trend": failure_trend,
    "validation_results": validation_results,
}

_NONE = "CAST(NULL AS BIGINT)"


def _row(table, mode, source, target, only_source, only_target, changed, status, message, match="source_count = target_count"):
    return f"""SELECT *, {status} AS status, {message} AS error_message, {match} AS count_match FROM (
      SELECT '{table}' AS table_name, '{mode}' AS comparison_mode, CAST({source} AS BIGINT) AS source_count, CAST({target} AS BIGINT) AS target_count,
        CAST({only_source} AS BIGINT) AS rows_only_in_source, CAST({only_target} AS BIGINT) AS rows_only_in_target,
        CAST({changed} AS BIGINT) AS rows_with_mismatches)"""


_MISMATCHES = """'Mismatches: ' || rows_only_in_target || ' only_in_target, ' || rows_only_in_source || ' only_in_source, ' || rows_with_mismatches || ' hash_diff'"""
_IN_WINDOW = "ts >= TIMESTAMP '2024-01-13 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'"

_EQUAL = " UNION ALL ".join(
    _row(name, "hash", f"(SELECT COUNT(*) FROM {name})", f"(SELECT COUNT(*) FROM {name})", "0", "0", "0", "'pass'", "NULL")
    for name in ("region", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"))

ORACLES = {
    "run_row": """SELECT 'run_1' AS run_id, TIMESTAMP '2024-01-20 00:30:00' AS started_at, 'partial' AS overall, CAST(14 AS BIGINT) AS total_tables,
        CAST(9 AS BIGINT) AS pass_count, CAST(5 AS BIGINT) AS fail_count""",
    "verdict": f"WITH {OUTCOMES_SQL} SELECT run_id, table_name, raw_status, status, mismatch_count FROM judged",
    "run_summary": f"""WITH {OUTCOMES_SQL}, r AS (SELECT run_id, COUNT(*) AS total_tables, COUNT(*) FILTER (status = 'pass') AS pass_count,
        COUNT(*) FILTER (status <> 'pass') AS fail_count FROM judged GROUP BY 1)
        SELECT *, CASE WHEN fail_count = 0 THEN 'success' WHEN pass_count > 0 THEN 'partial' ELSE 'failed' END AS overall FROM r""",
    "run_digest": f"""WITH {OUTCOMES_SQL} SELECT run_id, table_name, comparison_mode, status, source_count, target_count,
        CASE WHEN source_count IS NULL THEN '—' WHEN target_count = source_count THEN '0'
          WHEN target_count > source_count THEN '+' || (target_count - source_count) || ' target'
          ELSE '+' || (source_count - target_count) || ' source' END AS delta, mismatch_count AS issues FROM judged""",
    "latest_results": f"""WITH {OUTCOMES_SQL}, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY table_name ORDER BY executed_at DESC, run_id DESC) AS rn FROM judged)
        SELECT table_name, run_id, executed_at, status FROM r WHERE rn = 1""",
    "failure_trend": f"""WITH {OUTCOMES_SQL} SELECT table_name, status, COUNT(*) AS n FROM judged
        WHERE executed_at >= {_TREND_NOW} - INTERVAL 365 DAY AND status <> 'pass' GROUP BY 1, 2 ORDER BY n DESC, 1, 2""",
    "validation_results": f"""WITH {ORDERS_PAIR_SQL}, r AS ({_EQUAL} UNION ALL
        {_row("orders", "hash", "(SELECT COUNT(*) FROM s)", "(SELECT COUNT(*) FROM t)",
              "(SELECT COUNT(*) FROM s ANTI JOIN t USING (o_orderkey))", "(SELECT COUNT(*) FROM t ANTI JOIN s USING (o_orderkey))",
              "(SELECT COUNT(*) FROM s JOIN t USING (o_orderkey) WHERE s.o_orderstatus <> t.o_orderstatus OR s.o_totalprice <> t.o_totalprice)",
              "CASE WHEN source_count <> target_count THEN 'count_mismatch' ELSE 'hash_mismatch' END", _MISMATCHES)}
        UNION ALL {_row("events", "hash", f"(SELECT COUNT(*) FROM events WHERE {_IN_WINDOW})",
                        f"(SELECT COUNT(*) FROM events WHERE {_IN_WINDOW} AND event_id % 50 <> 0)",
                        f"(SELECT COUNT(*) FROM events WHERE {_IN_WINDOW} AND event_id % 50 = 0)", "0",
                        f"(SELECT COUNT(*) FROM events WHERE {_IN_WINDOW} AND event_id % 50 <> 0 AND event_id % 60 = 1)", "'count_mismatch'", _MISMATCHES)}
        UNION ALL {_row("lineitem", "advanced", "NULL", "NULL", "NULL", "NULL", "NULL", "'error'",
                        "'comparison_mode=''advanced'' requires entries in validation.comparison_key_columns for table ''lineitem'': add its keys, choose ''basic'' or ''advanced_no_pk'', or set pk_fallback_strategy=''no_pk_advanced'''", "NULL")}
        UNION ALL {_row("customer", "advanced", "(SELECT COUNT(*) FROM customer)", "(SELECT COUNT(*) FROM customer)", "0", "0", "0", "'pass'", "NULL")}
        UNION ALL {_row("part", "hash", "NULL", "NULL", "NULL", "NULL", "NULL", "'schema_drift'",
                        "'Schema mismatch: extra in target=[''scenario_extra''], extra in source=[]'", "NULL")}
        UNION ALL {_row("supplier", "basic", "(SELECT COUNT(*) FROM supplier)", "(SELECT COUNT(*) FROM supplier)", "NULL", "NULL", "NULL", "'pass'", "NULL")}
        UNION ALL {_row("nation", "fingerprint", "NULL", "NULL", "NULL", "NULL", "NULL", "'error'", "'Unknown mode: fingerprint'", "NULL")})
        SELECT 'run_1' AS run_id, *, CAST(COALESCE(rows_only_in_source, 0) + COALESCE(rows_only_in_target, 0) + COALESCE(rows_with_mismatches, 0) AS BIGINT) AS mismatch_count,
          CAST(30 AS INT) AS safety_lag_minutes, TIMESTAMP '2024-01-13 00:00:00' AS window_start, TIMESTAMP '2024-01-20 00:00:00' AS window_end,
          TIMESTAMP '2024-01-20 00:30:00' AS executed_at FROM r""",
}
