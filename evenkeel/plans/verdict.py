"""From raw outcomes to statuses, run totals, digests, stored samples and trends."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions import sqltext
from evenkeel.functions.literals import literal_frame
from evenkeel.functions.numbering import number_rows
from evenkeel.functions.topk import top_per_group
from evenkeel.operators.keyed import DIFF_CLASSES
from evenkeel.spec import FAILING_STATUSES, RESULT_SCHEMA, RUN_SCHEMA

def status_sql(distinct_column_status: bool = False) -> str:
    """Audit status from ``raw_status`` and ``count_match``; different counts win over content."""
    by_column = "WHEN comparison_mode = 'advanced' THEN 'column_mismatch'" if distinct_column_status else ""
    return f"""CASE
        WHEN raw_status = 'PASS' THEN 'pass'
        WHEN raw_status = 'INCONCLUSIVE' THEN 'inconclusive'
        WHEN raw_status = 'SCHEMA_DRIFT' THEN 'schema_drift'
        WHEN raw_status IN ('ERROR', 'DATA_QUALITY_ERROR') THEN 'error'
        WHEN NOT count_match THEN 'count_mismatch'
        {by_column}
        ELSE 'hash_mismatch' END"""


MISMATCHES_SQL = "CAST(coalesce(rows_only_in_source, 0) + coalesce(rows_only_in_target, 0) + coalesce(rows_with_mismatches, 0) AS BIGINT)"


def with_verdict(outcomes: DataFrame, distinct_column_status: bool = False) -> DataFrame:
    return outcomes.selectExpr("*", f"{status_sql(distinct_column_status)} AS status", f"{MISMATCHES_SQL} AS mismatch_count")


def as_result(outcome: DataFrame, meta: dict, seconds: float, distinct_column_status: bool = False) -> DataFrame:
    """Outcome rows with run metadata, in the shape that is stored."""
    columns = {
        **{c: c for c in RESULT_SCHEMA.names},
        "run_id": sqltext.text(meta["run_id"]),
        "table_name": sqltext.text(meta["table_name"]),
        "window_start": sqltext.moment(meta["window_start"]),
        "window_end": sqltext.moment(meta["window_end"]),
        "safety_lag_minutes": str(meta["safety_lag_minutes"]),
        "executed_at": sqltext.moment(meta["executed_at"]),
        "duration_seconds": f"{seconds:.2f}D",
    }
    judged = with_verdict(outcome, distinct_column_status)
    return judged.selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def run_summary(results: DataFrame) -> DataFrame:
    """Totals and overall status of each run."""
    failing = ", ".join(sqltext.text(x) for x in FAILING_STATUSES)
    totals = results.groupBy("run_id").agg(
        F.expr("count(1) AS total_tables"),
        F.expr("count_if(status = 'pass') AS pass_count"),
        F.expr(f"count_if(status IN ({failing})) AS fail_count"),
    )
    overall = "CASE WHEN fail_count = 0 THEN 'success' WHEN pass_count > 0 THEN 'partial' ELSE 'failed' END AS overall"
    return totals.selectExpr("*", overall)


def append_run(spark: SparkSession, path: str, run_id: str, started_at: datetime, results: DataFrame | None = None) -> None:
    """Append the row of a run: as ``running`` before its first table, with totals after its last."""
    row = [run_id, started_at, None, "running", None, None, None]
    if results is not None:
        totals = run_summary(results).first()
        ended = datetime.now(timezone.utc).replace(tzinfo=None)
        row[2:] = [ended, *([totals.overall, totals.total_tables, totals.pass_count, totals.fail_count] if totals else ["success", 0, 0, 0])]
    literal_frame(spark, [row], RUN_SCHEMA).write.mode("append").parquet(path)


def run_rows(spark: SparkSession, path: str) -> DataFrame:
    """One row per run: its totals, or ``running`` if it has not ended (or never did)."""
    stored = spark.read.schema(RUN_SCHEMA).parquet(path)
    newest = stored.groupBy("run_id").agg(F.expr("max_by(struct(*), coalesce(ended_at, TIMESTAMP_NTZ '0001-01-01 00:00:00')) AS r"))
    return newest.select("r.*")


def run_digest(results: DataFrame) -> DataFrame:
    """One line of figures per result: count delta with its direction, and number of issues."""
    delta = """CASE
        WHEN source_count IS NULL OR target_count IS NULL THEN '—'
        WHEN target_count = source_count THEN '0'
        WHEN target_count > source_count THEN concat('+', target_count - source_count, ' target')
        ELSE concat('+', source_count - target_count, ' source') END AS delta"""
    return results.selectExpr(
        "run_id", "table_name", "comparison_mode", "status", "source_count", "target_count", delta, f"{MISMATCHES_SQL} AS issues"
    )


def samples_audit(samples: DataFrame, run_id: str, table: str, captured_at: datetime, cap: int | None = None) -> DataFrame:
    """Samples of one table as stored: numbered and whole; with a ``cap`` the first so many of each class."""
    tagged = samples.selectExpr("*", f"{sqltext.text(run_id)} AS run_id", f"{sqltext.text(table)} AS table_name")
    return number_samples(tagged, cap).selectExpr("*", f"{sqltext.moment(captured_at)} AS captured_at")


def number_samples(samples: DataFrame, cap: int | None = None) -> DataFrame:
    """Sequence per (run, table): classes in their fixed order, then by key and column."""
    classes = ", ".join(sqltext.text(c) for c in DIFF_CLASSES)
    if cap is not None:
        samples = top_per_group(samples, ["run_id", "table_name", "mismatch_type"], ["pk_values", "column_name NULLS FIRST"], cap)
    order = [f"array_position(array({classes}), mismatch_type)", "mismatch_type", "pk_values", "column_name"]
    numbered = number_rows(samples, ["run_id", "table_name"], order, "sample_seq")
    return numbered.select("run_id", "table_name", "sample_seq", "mismatch_type", "column_name", "pk_values", "source_value", "target_value")


def latest_results(results: DataFrame) -> DataFrame:
    """The newest result of each table, by time of execution. A table's history collapses inside each
    task before it is shuffled, so a table with a long one is no burden."""
    newest = results.groupBy("table_name").agg(F.expr("max_by(struct(*), struct(executed_at, run_id)) AS r"))
    return newest.select(*[f"r.{c}" for c in results.columns])


def failure_trend(results: DataFrame, now: datetime, days: int = 7) -> DataFrame:
    """Results other than ``pass`` in the days before ``now``, per table and status, most first."""
    return (
        results.filter(f"executed_at >= {sqltext.moment(now - timedelta(days=days))} AND status <> 'pass'")
        .groupBy("table_name", "status")
        .agg(F.expr("count(1) AS n"))
        .orderBy(F.desc("n"), "table_name", "status")
    )
