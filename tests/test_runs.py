"""Whole runs: results, samples, statuses, reports, gate."""

from datetime import datetime, timedelta

import pytest
from conftest import NOW, rows

from evenkeel import ParityFailure, TableSpec, run_tables
from evenkeel.functions.literals import literal_frame
from evenkeel.plans import verdict as v
from evenkeel.plans.compare import TablePair
from evenkeel.sources.tables import fail_if_any
from evenkeel.spec import FAILING_STATUSES, OUTCOME_SCHEMA, RESULT_SCHEMA


@pytest.mark.parametrize(
    ("raw", "match", "mode", "flag", "want"),
    [
        ("PASS", True, "hash", False, "pass"),
        ("INCONCLUSIVE", True, "hash_no_pk", False, "inconclusive"),
        ("ERROR", None, "x", False, "error"),
        ("DATA_QUALITY_ERROR", None, "hash", False, "error"),
        ("SCHEMA_DRIFT", None, "hash", False, "schema_drift"),
        ("FAIL", False, "advanced", True, "count_mismatch"),
        ("FAIL", True, "hash", True, "hash_mismatch"),
        ("FAIL", True, "advanced", False, "hash_mismatch"),
        ("FAIL", True, "advanced", True, "column_mismatch"),
    ],
)
def test_status(spark, raw, match, mode, flag, want):
    df = literal_frame(spark, [[mode, 1, 2, match, None, 4, 5, raw, None]], OUTCOME_SCHEMA)
    got = v.with_verdict(df, flag).first()
    assert (got.status, got.mismatch_count) == (want, 9)


def result(run, table, status, at, source=1, target=1):
    values = {"run_id": run, "table_name": table, "status": status, "executed_at": at, "source_count": source, "target_count": target,
              "comparison_mode": "hash", "rows_only_in_target": 2, "duration_seconds": 1.0}
    return [values.get(f.name) for f in RESULT_SCHEMA]


@pytest.fixture
def history(spark):
    day = timedelta(days=1)
    return literal_frame(spark, [
        result("r1", "a", "pass", NOW - 9 * day), result("r1", "b", "error", NOW - 8 * day, None, None),
        result("r2", "a", "hash_mismatch", NOW - 2 * day, 5, 7), result("r2", "b", "pass", NOW - 2 * day, 7, 5),
        result("r0", "b", "hash_mismatch", NOW - day), result("r3", "a", "hash_mismatch", NOW - day),
        result("r4", "c", "pass", NOW), result("r5", "c", "error", NOW - 3 * day), result("r6", "d", "schema_drift", NOW - 3 * day),
    ], RESULT_SCHEMA)


def test_reports(history):
    assert rows(v.run_summary(history))[:3] == [("r0", 1, 0, 1, "failed"), ("r1", 2, 1, 1, "partial"), ("r2", 2, 1, 1, "partial")]
    assert ("r4", 1, 1, 0, "success") in rows(v.run_summary(history))
    deltas = {(r.run_id, r.table_name): (r.delta, r.issues) for r in v.run_digest(history).collect()}
    assert deltas["r2", "a"] == ("+2 target", 2) and deltas["r2", "b"] == ("+2 source", 2)
    assert deltas["r1", "b"] == ("—", 2) and deltas["r1", "a"] == ("0", 2)
    assert rows(v.latest_results(history).select("table_name", "run_id")) == [("a", "r3"), ("b", "r0"), ("c", "r4"), ("d", "r6")]
    assert [tuple(r) for r in v.failure_trend(history, NOW).collect()] == [
        ("a", "hash_mismatch", 2), ("b", "hash_mismatch", 1), ("c", "error", 1), ("d", "schema_drift", 1),
    ]


def test_gate(spark, history):
    with pytest.raises(ParityFailure, match="run r: failed for a, a, b, b, c, d$"):
        fail_if_any(history, FAILING_STATUSES, context="run r")
    many = literal_frame(spark, [result("r", f"t{i:02}", "error", NOW) for i in range(12)], RESULT_SCHEMA)
    with pytest.raises(ParityFailure, match="t09 and 2 more$"):
        fail_if_any(many, FAILING_STATUSES)


def test_run(spark, tmp_path):
    def frame(n, bad=-1):
        return lambda: spark.range(n).selectExpr("id", f"if(id = {bad}, 'x', 'y') AS s", "timestampadd(DAY, -CAST(id AS INT), TIMESTAMP_NTZ '2024-01-31 12:00:00') AS ts")

    def broken():
        raise RuntimeError("source is down")

    keyed = {"keys": ("id",)}
    pairs = [
        TablePair(TableSpec("same", "hash", **keyed), frame(20), frame(20)),
        TablePair(TableSpec("changed", "advanced", **keyed), frame(20), frame(20, 3)),
        TablePair(TableSpec("shorter", "hash", **keyed), frame(20), frame(15)),
        TablePair(TableSpec("shorter_in_window", "hash", filter_column="ts", **keyed), frame(20), frame(15)),
        TablePair(TableSpec("swapped", "hash_no_pk"), frame(20), frame(20, 3)),
        TablePair(TableSpec("wider", "hash", **keyed), frame(20), lambda: frame(20)().withColumnRenamed("s", "z")),
        TablePair(TableSpec("down", "hash", **keyed), broken, frame(20)),
        TablePair(TableSpec("by_expression", "basic", filter_column="ts >= '{window_start}'"), frame(20), frame(20)),
    ]
    out, samples = str(tmp_path / "results"), str(tmp_path / "samples")
    got = {r.table_name: r for r in run_tables(spark, pairs, "r1", NOW, out, samples).collect()}
    assert {n: r.status for n, r in got.items()} == {
        "same": "pass", "changed": "hash_mismatch", "shorter": "count_mismatch", "shorter_in_window": "pass", "swapped": "inconclusive",
        "wider": "schema_drift", "down": "error", "by_expression": "error",
    }
    assert got["shorter_in_window"].source_count == 7  # ids 0..6 lie in the window
    assert (got["same"].window_start, got["same"].window_end) == (datetime(2024, 1, 25), datetime(2024, 2, 1))
    assert "source is down" in got["down"].error_message
    stored = spark.read.parquet(samples)
    assert {(r.table_name, r["count"]) for r in stored.groupBy("table_name").count().collect()} == {("changed", 1), ("shorter", 5), ("swapped", 2)}
    assert [r.sample_seq for r in stored.filter("table_name = 'shorter'").orderBy("sample_seq").collect()] == [1, 2, 3, 4, 5]
    again = run_tables(spark, pairs[:1], "r2", NOW, out, samples, distinct_column_status=True)
    assert again.count() == 1 and spark.read.parquet(out).count() == 9
    assert run_tables(spark, pairs[7:], "r3", NOW, out, samples, trusted_expressions=True).first().status == "pass"


def test_stored_samples_are_whole_and_numbered(spark):
    df = spark.range(3000).selectExpr(
        "if(id % 2 = 0, 'value_diff', 'only_in_source') AS mismatch_type", "concat(lpad(CAST(id AS STRING), 4, '0'), repeat('k', 8996)) AS pk_values",
        "'c' AS column_name", "repeat('x', 9000) AS source_value", "CAST(NULL AS STRING) AS target_value")
    got = v.samples_audit(df.repartition(5), "r", "t", NOW).orderBy("sample_seq").collect()
    assert [r.sample_seq for r in got] == list(range(1, 3001))
    assert [(r.mismatch_type, int(r.pk_values[:4])) for r in got] == [("only_in_source", k) for k in range(1, 3000, 2)] + [("value_diff", k) for k in range(0, 3000, 2)]
    assert len(got[0].pk_values) == len(got[0].source_value) == 9000 and got[0].target_value is None
    assert [int(r.pk_values[:4]) for r in v.samples_audit(df, "r", "t", NOW, 2).orderBy("sample_seq").collect()] == [1, 3, 0, 2]


def test_a_run_leaves_a_row_before_and_after(spark, tmp_path):
    path = str(tmp_path / "runs")
    v.append_run(spark, path, "crashed", NOW)
    pairs = [TablePair(TableSpec(f"t{k}", "hash", keys=("id",)), lambda: spark.range(5), lambda k=k: spark.range(5 - k % 2)) for k in range(6)]
    run_tables(spark, pairs, "r", NOW, str(tmp_path / "a"), str(tmp_path / "b"), parallel=1, run_path=path)
    got = {r.run_id: (r.overall, r.total_tables, r.pass_count, r.fail_count, r.ended_at is None) for r in v.run_rows(spark, path).collect()}
    assert got == {"crashed": ("running", None, None, None, True), "r": ("partial", 6, 3, 3, False)}
