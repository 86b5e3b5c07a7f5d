"""Scenario gates and verdicts over whole tables of scenarios, results and samples."""

from __future__ import annotations

import json
from datetime import timedelta

from pyspark.sql import functions as F

from evenkeel.functions.literals import literal_frame
from evenkeel.plans import scenario as scn
from evenkeel.plans.config import mode_routing
from evenkeel.plans.selftest import run_scenarios
from evenkeel.sources import tables as t
from evenkeel.spec import CONFIG_SCHEMA, KEY_COLUMNS_SCHEMA, SCENARIO_SCHEMA, SKIP_COLUMNS_SCHEMA
from workload.config import ROUTED_SQL, loaded_config
from workload.inputs import SCENARIO_SQL, derive, derive_sql, load, scenarios

RESULT = {
    "run_id": "concat('run_', CAST(o_orderkey AS STRING))",
    "table_name": "concat('cust_', CAST(o_custkey AS STRING))",
    "status": "CASE o_orderkey % 7 WHEN 0 THEN 'pass' WHEN 1 THEN 'hash_mismatch' WHEN 2 THEN 'error' WHEN 3 THEN 'inconclusive' "
              "ELSE CASE o_orderkey % 4 WHEN 0 THEN 'pass' WHEN 1 THEN 'hash_mismatch' WHEN 2 THEN 'count_mismatch' ELSE 'error' END END",
    "source_count": "CASE WHEN o_orderkey % 17 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(100 + o_custkey % 9 AS BIGINT) END",
    "target_count": "CASE WHEN o_orderkey % 17 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(100 + o_orderkey % 9 AS BIGINT) END",
    "error_message": "CASE o_orderkey % 3 WHEN 0 THEN 'comparison_mode requires entries' WHEN 1 THEN 'Schema mismatch: notes, id, status' END",
}
RESULT_WHERE = "o_orderkey % 19 <> 0"
SAMPLE = {
    "run_id": "concat('run_', CAST(l_orderkey AS STRING))",
    "mismatch_type": "CASE WHEN l_linenumber = 1 THEN 'only_in_source' WHEN l_linenumber = 2 THEN 'only_in_target' WHEN l_linenumber = 3 THEN 'value_diff' "
                     "WHEN l_linenumber = 4 THEN 'only_in_source_multiset' WHEN l_linenumber = 5 THEN 'only_in_target_multiset' "
                     "WHEN l_linenumber = 6 THEN 'multiset_count_diff' WHEN l_returnflag = 'A' THEN 'hash_diff' ELSE 'only_in_target_no_pk' END",
    "column_name": "CASE WHEN l_linenumber = 3 THEN CASE l_partkey % 6 WHEN 0 THEN 'id' WHEN 1 THEN 'notes' WHEN 2 THEN 'last_updated' WHEN 3 THEN 'etl_batch_id' WHEN 4 THEN 'tenant_id' ELSE 'status' END END",
}


def scenario_applicability(spark, d):
    return scn.applicability(scenarios(spark, d), mode_routing(loaded_config(spark, d)))


def scenario_lint(spark, d):
    return scn.scenario_lint(scenarios(spark, d), loaded_config(spark, d))


def scenario_verdicts(spark, d):
    results = derive(load(spark, d, "orders").filter(RESULT_WHERE), RESULT)
    tables = derive(load(spark, d, "orders"), {"run_id": RESULT["run_id"], "table_name": RESULT["table_name"]})
    samples = derive(load(spark, d, "lineitem"), SAMPLE).join(tables, "run_id")
    return scn.scenario_verdicts(scenarios(spark, d), results, samples)


# Scenario types, their parameters, expected statuses and the modes they hold for.
_NEEDLE = '{"expected_error_substring": "requires entries in"}'
_KEYLESS = "hash_no_pk,advanced_no_pk"
CATALOG = [
    ("baseline", "noop", "{}", "pass", "basic,hash,advanced", "hash"),
    ("delete-basic", "delete_rows", '{"count": 50}', "count_mismatch", "basic", "basic"),
    ("delete", "delete_rows", '{"count": 50}', "count_mismatch", "hash,advanced", "advanced"),
    ("extra", "insert_extra_rows", '{"count": 30}', "count_mismatch", "hash,advanced", "hash"),
    ("update", "update_column", '{"column": "props", "count": 20}', "hash_mismatch", "hash,advanced", "advanced"),
    ("add-column", "add_extra_column", '{"column_name": "scenario_extra"}', "schema_drift", "hash,advanced", "hash"),
    ("drop-column", "drop_column", '{"column_name": "props"}', "schema_drift", "hash,advanced", "advanced"),
    ("null-key", "null_out_pk", '{"count": 5}', "error", "hash,advanced", "hash"),
    ("no-keys", "clear_key_cols", _NEEDLE, "error", "hash,advanced", "advanced"),
    ("keyless-pass", "noop", "{}", "pass", _KEYLESS, "hash_no_pk"),
    ("keyless-extra", "insert_extra_rows_no_pk", '{"count": 1, "mutate": true}', "count_mismatch", _KEYLESS, "advanced_no_pk"),
    ("keyless-missing", "delete_rows_no_pk", '{"count": 1}', "count_mismatch", _KEYLESS, "hash_no_pk"),
    ("keyless-copies", "insert_extra_rows_no_pk", '{"count": 1, "mutate": false}', "count_mismatch", _KEYLESS, "advanced_no_pk"),
    ("keyless-swap", "content_swap_no_pk", '{"count": 1}', "inconclusive", _KEYLESS, "hash_no_pk"),
    ("wrong-mode", "delete_rows", "{}", "count_mismatch", "basic", "hash"),
    ("not-enabled", "noop", "{}", "pass", "hash", "disabled"),
]


def scenario_run(spark, d):
    """The whole catalog against ``events``, one config per mode; verdicts as stored."""
    modes = sorted({m for *_, m in CATALOG})
    row = lambda mode: [{
        "table_name": f"events_{mode}", "comparison_mode": "hash" if mode == "disabled" else mode, "schema_drift_policy": "fail",
        "enabled": mode != "disabled", "filter_column": "ts", "filter_days": 3650}.get(f.name) for f in CONFIG_SCHEMA]
    configs = literal_frame(spark, [row(m) for m in modes], CONFIG_SCHEMA)
    keys = literal_frame(spark, [[f"events_{m}", "event_id", 1] for m in modes if not m.endswith("_no_pk")], KEY_COLUMNS_SCHEMA)
    listed = [[i, None, f"events_{m}", mutation, params, expected, valid, True, None] for i, mutation, params, expected, valid, m in CATALOG]
    now = load(spark, d, "events").agg({"ts": "max"}).first()[0] + timedelta(hours=1)  # the newest rows lie in the window
    folder = t.scratch_path(spark, "selftest")
    found = run_scenarios(
        spark, literal_frame(spark, listed, SCENARIO_SCHEMA), configs, keys, literal_frame(spark, [], SKIP_COLUMNS_SCHEMA),
        lambda _: load(spark, d, "events"), "selftest", now, folder,
    )
    results = spark.read.parquet(f"{folder}/results").select(
        F.col("table_name").alias("scenario_id"), "source_count", "target_count", "rows_only_in_source", "rows_only_in_target", "rows_with_mismatches")
    return found.select("scenario_id", "target_table", "mutation_type", "expected_status", "actual_status", "verdict", "notes").join(results, "scenario_id", "left")


QUERIES = {
    "scenario_run": scenario_run,
    "scenario_applicability": scenario_applicability,
    "scenario_lint": scenario_lint,
    "scenario_verdicts": scenario_verdicts,
}

_TOUCHED = "mutation_type IN ('update_column', 'drop_column')"


def _none_of(types: str) -> str:
    return f"n_samples > 0 AND NOT ({types})"


def _off(share: str) -> str:
    return f"source_count - target_count >= 1 AND ABS(source_count - target_count - n) > GREATEST(2.0, n * {share})"


_GOT = "'; got source=' || source_count || ' target=' || target_count"
_OFF_TEXT = "'delta ' || (source_count - target_count) || ' differs from requested ' || n"

_GATED = {"wrong-mode": "scenario does not apply to this table", "not-enabled": "scenario does not apply to this table"}
# What each mutation does to the rows: (rows that go, rows that come, rows that change) as SQL, from its parameters.
_EFFECT = {"noop": ("0", "0", "0"), "delete_rows": ("n", "0", "0"), "insert_extra_rows": ("0", "n", "0"), "update_column": ("0", "0", "n"),
           "delete_rows_no_pk": ("n", "0", "0"), "insert_extra_rows_no_pk": ("0", "n", "0"), "content_swap_no_pk": ("n", "n", "0")}


def _scenario_sql(scenario: str, mutation: str, params: str, expected: str, mode: str) -> str:
    """One scenario's verdict; its counts are those of ``events``, of which no mutation touches more rows than there are."""
    facts = f"'{scenario}' AS scenario_id, 'events_{mode}' AS target_table, '{mutation}' AS mutation_type, '{expected}' AS expected_status"
    none = ["CAST(NULL AS BIGINT)"] * 5
    if scenario in _GATED:
        counts, status, verdict, notes = none, "CAST(NULL AS VARCHAR)", "not_applicable", f"'{_GATED[scenario]}'"
    else:
        status, verdict, notes = f"'{expected}'", "pass", "CAST(NULL AS VARCHAR)"
        if expected == "schema_drift" or mutation == "clear_key_cols":
            counts = none
        elif mutation == "null_out_pk":
            counts = ["total", "total", *none[:3]]
        else:
            gone, come, changed = (e.replace("n", f"LEAST(total, {json.loads(params).get('count', 0)})") for e in _EFFECT[mutation])
            counts = ["total", f"total - {gone} + {come}", *(none[:3] if mode == "basic" else (gone, come, changed))]
    names = ("source_count", "target_count", "rows_only_in_source", "rows_only_in_target", "rows_with_mismatches")
    listed = ", ".join(f"CAST({e} AS BIGINT) AS {n}" for e, n in zip(counts, names))
    return f"SELECT {facts}, {status} AS actual_status, '{verdict}' AS verdict, {notes} AS notes, {listed} FROM n"


ORACLES = {
    "scenario_run": "WITH n AS (SELECT COUNT(*) AS total FROM events) " + " UNION ALL ".join(_scenario_sql(i, mutation, params, expected, mode) for i, mutation, params, expected, _, mode in CATALOG),
    "scenario_applicability": f"""WITH {ROUTED_SQL}, {SCENARIO_SQL},
        j AS (SELECT scn.*, COALESCE(r.effective_mode, r.comparison_mode) AS active_mode, r.schema_drift_policy, r.table_name AS configured
          FROM scn LEFT JOIN routed r ON r.table_name = scn.target_table),
        x AS (SELECT *, CASE WHEN configured IS NULL THEN 'table has no config'
          WHEN valid_comparison_modes <> '' AND NOT list_contains(string_split(replace(valid_comparison_modes, ' ', ''), ','), active_mode) THEN 'mode ' || active_mode || ' not listed'
          WHEN mutation_type IN ('add_extra_column', 'drop_column') AND schema_drift_policy <> 'fail' THEN 'drift policy is ' || schema_drift_policy END AS reason FROM j)
        SELECT scenario_id, target_table, mutation_type, active_mode, reason IS NULL AS applicable, reason FROM x""",
    "scenario_lint": f"""WITH {ROUTED_SQL}, {SCENARIO_SQL},
        x AS (SELECT scenario_id, target_table, mutation_type, "column", CASE WHEN list_contains(key_cols, "column") THEN 'key_column'
          WHEN list_contains(skip_cols, "column") THEN 'skipped_column' WHEN filter_column = "column" THEN 'filter_column' END AS finding
          FROM scn JOIN routed ON table_name = target_table WHERE {_TOUCHED})
        SELECT * FROM x WHERE finding IS NOT NULL""",
    "scenario_verdicts": f"""WITH {SCENARIO_SQL}, res AS ({derive_sql(RESULT, "orders", RESULT_WHERE)}), smp AS ({derive_sql(SAMPLE, "lineitem")}),
        j AS (SELECT scn.*, res.status AS actual, source_count, target_count, error_message FROM scn
          LEFT JOIN res ON res.run_id = scn.run_id AND res.table_name = scn.target_table),
        k AS (SELECT j.scenario_id, COUNT(smp.run_id) AS n_samples, COALESCE(BOOL_OR(mismatch_type = 'only_in_source'), FALSE) AS k_source,
            COALESCE(BOOL_OR(mismatch_type = 'only_in_target'), FALSE) AS k_target, COALESCE(BOOL_OR(mismatch_type = 'hash_diff'), FALSE) AS k_hash,
            COALESCE(BOOL_OR(mismatch_type = 'value_diff' AND column_name = j."column"), FALSE) AS k_value,
            COALESCE(BOOL_OR(mismatch_type IN ('only_in_source_multiset', 'only_in_source_no_pk')), FALSE) AS k_lone_source,
            COALESCE(BOOL_OR(mismatch_type IN ('only_in_target_multiset', 'only_in_target_no_pk')), FALSE) AS k_lone_target,
            COALESCE(BOOL_OR(mismatch_type = 'multiset_count_diff'), FALSE) AS k_copies,
            COALESCE(BOOL_OR(mismatch_type = 'only_in_target_no_pk'), FALSE) AS k_no_pk
          FROM j LEFT JOIN smp ON smp.run_id = j.run_id GROUP BY 1),
        e AS (SELECT j.*, k.* EXCLUDE (scenario_id),
          CASE WHEN mutation_type IN ('delete_rows', 'insert_extra_rows', 'delete_rows_no_pk', 'insert_extra_rows_no_pk', 'content_swap_no_pk') AND source_count IS NULL THEN 'counts missing'
            WHEN mutation_type IN ('delete_rows', 'delete_rows_no_pk') AND source_count - target_count < 1 THEN 'expected more source rows' || {_GOT}
            WHEN mutation_type IN ('insert_extra_rows', 'insert_extra_rows_no_pk') AND target_count - source_count < 1 THEN 'expected more target rows' || {_GOT}
            WHEN mutation_type = 'content_swap_no_pk' AND source_count <> target_count THEN 'expected equal counts' || {_GOT}
            WHEN mutation_type = 'update_column' AND NOT (k_hash OR k_value) THEN 'no hash_diff or value_diff sample for the column'
            WHEN mutation_type = 'clear_key_cols' AND COALESCE(error_message, '') NOT LIKE '%requires entries%' THEN 'error message lacks the expected text' END AS hard,
          CASE mutation_type
            WHEN 'delete_rows' THEN NULLIF(concat_ws('; ', CASE WHEN {_off("0.1")} THEN {_OFF_TEXT} END, CASE WHEN {_none_of("k_source")} THEN 'no only_in_source samples' END), '')
            WHEN 'insert_extra_rows' THEN CASE WHEN {_none_of("k_target")} THEN 'no only_in_target samples' END
            WHEN 'add_extra_column' THEN CASE WHEN NOT contains(COALESCE(error_message, ''), "column") THEN 'error message does not name the column' END
            WHEN 'drop_column' THEN CASE WHEN NOT contains(COALESCE(error_message, ''), "column") THEN 'error message does not name the column' END
            WHEN 'null_out_pk' THEN 'error message does not speak of a null key'
            WHEN 'delete_rows_no_pk' THEN NULLIF(concat_ws('; ', CASE WHEN {_off("0.5")} THEN {_OFF_TEXT} END, CASE WHEN {_none_of("k_lone_source OR k_copies")} THEN 'no source-side samples' END), '')
            WHEN 'insert_extra_rows_no_pk' THEN CASE WHEN mutate AND {_none_of("k_lone_target")} THEN 'no target-side samples'
              WHEN NOT mutate AND {_none_of("k_copies OR k_no_pk")} THEN 'no duplicate samples' END
            WHEN 'content_swap_no_pk' THEN CASE WHEN {_none_of("k_lone_source AND k_lone_target")} THEN 'samples of one side only' END END AS note
          FROM j JOIN k USING (scenario_id)),
        f AS (SELECT *, seeder_status = 'not_applicable' AS skipped,
          NULLIF(concat_ws('; ', CASE WHEN actual <> expected_status THEN 'status mismatch: expected=' || expected_status || ' actual=' || actual
            WHEN hard IS NOT NULL THEN 'status matched but evidence missing' END, hard, note), '') AS found FROM e)
        SELECT scenario_id, target_table, mutation_type, run_id AS engine_run_id, expected_status, CASE WHEN NOT skipped THEN actual END AS actual_status,
          CASE WHEN skipped THEN NULL WHEN actual IS NULL THEN FALSE
            ELSE hard IS NULL AND NOT COALESCE(contains(found, 'missing') OR contains(found, 'mismatch'), FALSE) END AS evidence_ok,
          CASE WHEN skipped THEN 'not_applicable' WHEN actual IS NULL THEN 'inconclusive' WHEN actual = expected_status AND hard IS NULL THEN 'pass' ELSE 'fail' END AS verdict,
          CASE WHEN skipped THEN 'scenario does not apply to this table' WHEN run_id IS NULL THEN 'run produced no id'
            WHEN actual IS NULL THEN 'no result row for this run and table' ELSE found END AS notes FROM f""",
}
