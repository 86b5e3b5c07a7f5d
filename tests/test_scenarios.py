"""The self-test: known damage must lead to its expected status and evidence."""

import json
from datetime import timedelta

import pytest
from conftest import NOW, rows
from pyspark.sql import functions as F

from evenkeel import ConfigError, TableSpec, run_tables
from evenkeel.functions.literals import literal_frame
from evenkeel.operators import drift
from evenkeel.plans import scenario as scn
from evenkeel.plans.compare import TablePair
from evenkeel.plans.config import load_config, mode_routing
from evenkeel.sources.window import window_bounds, windowed_scan
from evenkeel.spec import CONFIG_SCHEMA, KEY_COLUMNS_SCHEMA, SCENARIO_SCHEMA, SKIP_COLUMNS_SCHEMA

NEEDLE = json.dumps({"expected_error_substring": "requires entries in"})
KEYLESS = "hash_no_pk,advanced_no_pk"
# (id, mutation, parameters, expected status, modes it is valid for, modes to run it in)
SCENARIOS = [
    ("baseline", "noop", "{}", "pass", "basic,hash,advanced", ("basic", "hash", "advanced")),
    ("delete-basic", "delete_rows", '{"count": 50}', "count_mismatch", "basic", ("basic",)),
    ("delete", "delete_rows", '{"count": 50}', "count_mismatch", "hash,advanced", ("hash", "advanced")),
    ("extra", "insert_extra_rows", '{"count": 30}', "count_mismatch", "hash,advanced", ("hash", "advanced")),
    ("update", "update_column", '{"column": "props", "count": 20}', "hash_mismatch", "hash,advanced", ("hash", "advanced")),
    ("add-column", "add_extra_column", '{"column_name": "scenario_extra"}', "schema_drift", "hash,advanced", ("hash", "advanced")),
    ("drop-column", "drop_column", '{"column_name": "props"}', "schema_drift", "hash,advanced", ("hash",)),
    ("null-key", "null_out_pk", '{"count": 5}', "error", "hash,advanced", ("hash", "advanced")),
    ("no-keys", "clear_key_cols", NEEDLE, "error", "hash,advanced", ("hash", "advanced")),
    ("keyless-pass", "noop", "{}", "pass", KEYLESS, ("hash_no_pk", "advanced_no_pk")),
    ("keyless-extra", "insert_extra_rows_no_pk", '{"count": 1, "mutate": true}', "count_mismatch", KEYLESS, ("hash_no_pk", "advanced_no_pk")),
    ("keyless-missing", "delete_rows_no_pk", '{"count": 1}', "count_mismatch", KEYLESS, ("hash_no_pk", "advanced_no_pk")),
    ("keyless-copies", "insert_extra_rows_no_pk", '{"count": 1, "mutate": false}', "count_mismatch", KEYLESS, ("hash_no_pk", "advanced_no_pk")),
    ("keyless-swap", "content_swap_no_pk", '{"count": 1}', "inconclusive", KEYLESS, ("hash_no_pk", "advanced_no_pk")),
    ("wrong-mode", "delete_rows", "{}", "count_mismatch", "basic", ("hash",)),
]


def config_row(table, mode, **changes):
    row = {"table_name": table, "comparison_mode": mode, "schema_drift_policy": "fail", "enabled": True, "filter_column": "ts", **changes}
    return [row.get(f.name) for f in CONFIG_SCHEMA]


def scenario_row(name, mutation, params, expected, modes, table):
    return [name, None, table, mutation, params, expected, modes, True, None]


def test_all_scenarios(spark, sf, tmp_path):
    start, end = window_bounds(NOW - timedelta(days=10))
    events = windowed_scan(spark.read.parquet(f"{sf}/events.parquet"), "ts", start, end)
    assert events.count() > 150
    at = end - timedelta(hours=1)
    config, keys, listed, pairs, runs = [], [], [], [], []
    for name, mutation, params, expected, valid, modes in SCENARIOS:
        for mode in modes:
            table = f"{name}_{mode}".replace("-", "_")
            keyless = mode.endswith("_no_pk")
            declared = mode.removesuffix("_no_pk")
            config.append(config_row(table, declared, pk_fallback_strategy=f"no_pk_{declared}" if keyless else None))
            has_keys = not keyless
            if has_keys:
                keys.append([table, "event_id", 1])
            listed.append(scenario_row(table, mutation, params, expected, valid, table))
            damaged = scn.apply_mutation(events, mutation, json.loads(params), ["event_id"], at, table, "ts")
            spec_keys = ("event_id",) if has_keys and mutation != "clear_key_cols" else ()
            spec = TableSpec(table, declared, keys=spec_keys, pk_fallback_strategy=f"no_pk_{declared}" if keyless else None,
                             filter_column="ts", filter_days=7)
            pairs.append(TablePair(spec, lambda: events, lambda damaged=damaged: damaged))
    loaded = load_config(literal_frame(spark, config, CONFIG_SCHEMA), literal_frame(spark, keys, KEY_COLUMNS_SCHEMA), literal_frame(spark, [], SKIP_COLUMNS_SCHEMA))
    scenarios = literal_frame(spark, listed, SCENARIO_SCHEMA)
    gate = {r.scenario_id: r.applicable for r in scn.applicability(scenarios, mode_routing(loaded)).collect()}
    assert [n for n, ok in gate.items() if not ok] == ["wrong_mode_hash"]

    samples = str(tmp_path / "samples")
    runnable = [p for p in pairs if gate[p.spec.name]]
    results = run_tables(spark, runnable, "run", NOW - timedelta(days=10), str(tmp_path / "results"), samples)
    runs = scenarios.withColumns({"run_id": F.lit("run"), "seeder_status": F.when(F.col("scenario_id") == "wrong_mode_hash", "not_applicable").otherwise("applied")})
    verdicts = scn.scenario_verdicts(runs, results, spark.read.parquet(samples)).collect()
    assert {r.scenario_id: (r.verdict, r.notes) for r in verdicts if r.verdict != "pass"} == {
        "wrong_mode_hash": ("not_applicable", "scenario does not apply to this table")}
    assert {r.scenario_id: r.notes for r in verdicts if r.verdict == "pass" and r.notes} == {}


def test_gate_and_lint(spark):
    configs = literal_frame(spark, [config_row("a", "hash"), config_row("b", "hash", enabled=False), config_row("c", "hash", schema_drift_policy="intersect"),
                                    config_row("d", "hash", pk_fallback_strategy="no_pk_hash")], CONFIG_SCHEMA)
    keys = literal_frame(spark, [["a", "id", 1], ["c", "id", 1]], KEY_COLUMNS_SCHEMA)
    skips = literal_frame(spark, [["a", "note"]], SKIP_COLUMNS_SCHEMA)
    loaded = load_config(configs, keys, skips)
    made = [
        scenario_row("s1", "noop", None, "pass", "hash", "a"), scenario_row("s2", "noop", None, "pass", "basic, advanced", "a"),
        scenario_row("s3", "drop_column", '{"column_name": "id"}', "schema_drift", "", "c"), scenario_row("s4", "noop", None, "pass", None, "zz"),
        scenario_row("s5", "delete_rows_no_pk", "{}", "count_mismatch", "hash_no_pk", "d"),
        scenario_row("s6", "update_column", '{"column": "note"}', "hash_mismatch", "hash", "a"),
        scenario_row("s7", "update_column", '{"column": "ts"}', "hash_mismatch", "hash", "a"),
        scenario_row("s8", "update_column", '{"column": "fine"}', "hash_mismatch", "hash", "a"),
    ]
    scenarios = literal_frame(spark, made, SCENARIO_SCHEMA)
    got = {r.scenario_id: r.reason for r in scn.applicability(scenarios, mode_routing(loaded)).collect()}
    assert got == {"s1": None, "s2": "mode hash not listed", "s3": "drift policy is intersect", "s4": "table has no config", "s5": None,
                   "s6": None, "s7": None, "s8": None}
    assert rows(scn.scenario_lint(scenarios, loaded).select("scenario_id", "finding")) == [("s3", "key_column"), ("s6", "skipped_column"), ("s7", "filter_column")]


def test_mutations(spark):
    df = spark.sql("SELECT id AS k, CAST(id % 3 AS STRING) AS s, CAST(id AS DOUBLE) AS d, timestampadd(HOUR, CAST(id AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00') AS ts FROM range(10)")
    assert rows(drift.noop(df)) == rows(df)
    assert [r[0] for r in rows(drift.delete_rows(df, ["k"], 3, "ts"))] == list(range(7))
    assert drift.delete_rows(df, ["k"], 50).count() == 0
    extra = rows(drift.insert_extra_rows(df, ["k"], NOW, 2, "ts").filter("k >= 10"))
    assert [(r[0], r[3]) for r in extra] == [(10_000_017, NOW), (10_000_018, NOW)]
    texts = drift.insert_extra_rows(df, ["s", "k"], NOW, 1).filter("s LIKE 'scn%'")
    assert [r.s for r in texts.collect()] == ["scn_test_0"]
    changed = drift.update_column(df, ["k"], "s", F.lit("new"), NOW, 2, "ts").filter("s = 'new'")
    assert sorted((r.k, r.ts) for r in changed.collect()) == [(8, NOW), (9, NOW)]
    assert sorted(r.d for r in drift.null_out_key(df, ["k"], 2).filter("k IS NULL").collect()) == [0.0, 1.0]
    assert drift.add_extra_column(df).columns[-1] == "scenario_extra"
    assert "s" not in drift.drop_column(df, "s").columns
    few = df.select("s")
    assert sorted(r.s for r in drift.delete_rows_keyless(few, 1).collect()) == ["1"] * 3 + ["2"] * 3
    assert drift.insert_extra_rows_keyless(df, count=2).distinct().count() == 10
    marked = drift.insert_extra_rows_keyless(df, NOW, 1, True, "_x", "ts").filter("s LIKE '%_x'").first()
    assert (marked.k, marked.s, marked.ts) == (9, "0_x", NOW)
    numbers = drift.content_swap_keyless(df.select("k", "d"), filter_column="k")
    assert sorted(r.d for r in numbers.collect()) == [*map(float, range(9)), 10.0]
    with pytest.raises(ConfigError):
        drift.content_swap_keyless(df.select("ts"), filter_column="ts")
    with pytest.raises(ConfigError):
        scn.apply_mutation(df, "explode", {}, ["k"], NOW, "s")
    cleared = drift.clear_keys(spark.createDataFrame([("a", "k"), ("b", "k")], "table_name string, column_name string"), "a")
    assert rows(cleared) == [("b", "k")]
    nulls = spark.createDataFrame([(1, None), (1, None), (1, "x"), (None, None)], "a int, b string")
    assert rows(drift.delete_rows_keyless(nulls, 1)) == [(1, "x"), (1, None), (1, None)]


def test_update_fraction(spark):
    df = spark.range(20_000).selectExpr("id AS k", "'a' AS s", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts")
    hit = drift.update_fraction(df, ["k"], {"s": F.lit("b")}, NOW, 0.3, "ts").filter("s = 'b'")
    assert 0.28 < hit.count() / 20_000 < 0.32
    assert hit.filter(F.col("ts") != NOW.isoformat(" ")).count() == 0
    assert rows(hit.select("k")) == rows(drift.update_fraction(df.repartition(3), ["k"], {"s": F.lit("b")}, NOW, 0.3).filter("s = 'b'").select("k"))
