"""Config frames."""

import pytest
from conftest import rows

from evenkeel import ConfigError
from evenkeel.functions.literals import literal_frame
from evenkeel.plans import config as cfg
from evenkeel.spec import CONFIG_SCHEMA, KEY_COLUMNS_SCHEMA, SKIP_COLUMNS_SCHEMA, TableSpec

BASE = {"source_schema": "app", "target_schema": "copy", "comparison_mode": "hash", "filter_column": "changed_at",
        "schema_drift_policy": "fail", "severity": "warning", "enabled": True}


def make(spark, *changes):
    return literal_frame(spark, [[{**BASE, **c}.get(f.name) for f in CONFIG_SCHEMA] for c in changes], CONFIG_SCHEMA)


@pytest.fixture
def loaded(spark):
    configs = make(spark, {"table_name": "audit"}, {"table_name": "log"}, {"table_name": "off", "enabled": False})
    keys = literal_frame(spark, [["audit", "version", 3], ["audit", "tenant", 1], ["audit", "entity", 2], ["audit", "tenant", 1]], KEY_COLUMNS_SCHEMA)
    skips = literal_frame(spark, [["audit", c] for c in ("d", "a", "c", "b", "a")], SKIP_COLUMNS_SCHEMA)
    return cfg.load_config(configs, keys, skips)


def test_load_does_not_multiply(loaded):
    got = {r.table_name: (r.key_cols, r.skip_cols) for r in loaded.collect()}
    assert got == {"audit": (["tenant", "entity", "version"], ["a", "b", "c", "d"]), "log": ([], [])}


def test_to_specs(loaded):
    audit, log = cfg.to_specs(loaded)
    assert audit == TableSpec("audit", "hash", ("tenant", "entity", "version"), ("a", "b", "c", "d"), "fail",
                              filter_column="changed_at", filter_column_source="changed_at")
    assert (log.effective_days, log.effective_lag, log.effective_tolerance) == (7, 30, 0.001)
    zero = TableSpec("z", "hash", tolerance=0.0, filter_days=0, safety_lag_minutes=0)
    assert (zero.effective_days, zero.effective_lag, zero.effective_tolerance) == (0, 0, 0.0)


def test_effective(spark):
    got = cfg.effective_config(make(spark, {"table_name": "t", "numeric_tolerance": 0.0, "pk_fallback_strategy": "NO_PK_HASH"})).first()
    assert (got.source_table_name, got.filter_column_source, got.filter_days, got.safety_lag_minutes, got.numeric_tolerance,
            got.max_rows_advanced, got.pk_fallback_strategy) == ("t", "changed_at", 7, 30, 0.0, 500_000, "no_pk_hash")


def test_table_filter(spark):
    assert cfg.parse_table_filter(None) == []
    assert cfg.parse_table_filter('["a", "b"]') == cfg.parse_table_filter("a, b,") == cfg.parse_table_filter(["a", "b"]) == ["a", "b"]
    configs = make(spark, {"table_name": "a"}, {"table_name": "b"}, {"table_name": "c", "enabled": False})
    assert sorted(r.table_name for r in cfg.select_tables(configs, "").collect()) == ["a", "b"]
    assert [r.table_name for r in cfg.select_tables(configs, "b").collect()] == ["b"]
    with pytest.raises(ConfigError, match=r"\['c', 'd'\]"):
        cfg.select_tables(configs, "a,d,c")


def test_routing_agrees_with_the_single_table_rule(spark):
    cases = [(m, s) for m in ("basic", "hash", "hash_no_pk", "advanced", "advanced_no_pk", "odd") for s in (None, "fail", "no_pk_hash", "No_PK_Advanced")]
    configs = make(spark, *[{"table_name": f"t{i}", "comparison_mode": m, "pk_fallback_strategy": s} for i, (m, s) in enumerate(cases)])
    keys = literal_frame(spark, [[f"t{i}", "id", 1] for i in range(0, len(cases), 2)], KEY_COLUMNS_SCHEMA)
    routed = {r.table_name: r for r in cfg.mode_routing(cfg.load_config(configs, keys, literal_frame(spark, [], SKIP_COLUMNS_SCHEMA))).collect()}
    for i, (mode, strategy) in enumerate(cases):
        row = routed[f"t{i}"]
        if mode == "odd":
            assert (row.raw_status, row.error_message) == ("ERROR", "Unknown mode: odd")
            continue
        want = cfg.route(mode, i % 2 == 0, strategy)
        assert row.effective_mode == want
        assert row.error_message == (None if want else cfg.missing_keys_message(mode, f"t{i}"))


def test_seed_update_upsert_orphans(spark):
    existing = make(spark, {"table_name": "a"}, {"table_name": "b", "enabled": False})
    seeds = make(spark, {"table_name": "b"}, {"table_name": "c"})
    once = cfg.seed_config(existing, seeds)
    assert rows(once.select("table_name", "enabled")) == [("a", True), ("b", False), ("c", True)]
    assert rows(cfg.seed_config(once, seeds)) == rows(once)
    updates = literal_frame(spark, [["a", "x"], ["b", "y"]], SKIP_COLUMNS_SCHEMA).withColumnRenamed("column_name", "pk_fallback_strategy")
    changed = cfg.update_config(once, updates)
    assert rows(changed.select("table_name", "pk_fallback_strategy", "changed")) == [("a", "x", True), ("b", "y", True), ("c", None, False)]
    assert not any(r.changed for r in cfg.update_config(changed.drop("changed"), updates).collect())
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    new = spark.createDataFrame([(1, "z"), (3, "y")], "id int, v string")
    assert rows(cfg.upsert_by_id(old, new, "id")) == [(1, "z"), (2, "c"), (3, "y")]
    known = spark.createDataFrame([("a",)], "table_name string")
    assert [r.table_name for r in cfg.orphans(once, known).orderBy("table_name").collect()] == ["b", "c"]
    assert [r.table_name for r in cfg.without_orphans(once, known).collect()] == ["a"]


def test_lint(spark):
    configs = make(
        spark, {"table_name": "ok"},
        {"table_name": "9bad", "source_schema": "a b", "comparison_mode": "odd", "schema_drift_policy": "x", "severity": "y", "pk_fallback_strategy": "z",
         "filter_column": "a >= '{window_start}'", "filter_column_source": "a b"},
        {"table_name": "keyed"},
    )
    keys = literal_frame(spark, [["keyed", "id", 1], ["keyed", "a-b", 2]], KEY_COLUMNS_SCHEMA)
    skips = literal_frame(spark, [["keyed", "id"]], SKIP_COLUMNS_SCHEMA)
    found = rows(cfg.config_lint(cfg.load_config(configs, keys, skips)))
    assert found == sorted([
        ("9bad", "expression_filter_column", "a >= '{window_start}'"), ("9bad", "invalid_filter_column_source", "a b"),
        ("9bad", "invalid_source_schema", "a b"), ("9bad", "invalid_table_name", "9bad"), ("9bad", "unknown_drift_policy", "x"),
        ("9bad", "unknown_fallback", "z"), ("9bad", "unknown_mode", "odd"), ("9bad", "unknown_severity", "y"),
        ("keyed", "invalid_key_column", "a-b"), ("keyed", "key_is_skipped", "id"),
    ])
