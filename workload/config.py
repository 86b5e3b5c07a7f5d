"""Config tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.operators.evolve import add_and_backfill as evolve, backfill_check as check
from evenkeel.plans import config as cfg
from workload.inputs import (
    CONFIG, CONFIG_SQL, LOADED_SQL, SCENARIO_SQL, configs, key_columns, load, scenarios, skip_columns,
)

_NAMES = list(CONFIG)
_FLAT = ", ".join(_NAMES)
_FINAL_LISTS = "array_to_string(key_cols, ',') AS key_cols, array_to_string(skip_cols, ',') AS skip_cols"


def _flat(loaded):
    """Lists as text, as arrays do not compare across engines."""
    return loaded.withColumns({"key_cols": F.array_join("key_cols", ","), "skip_cols": F.array_join("skip_cols", ",")})


def loaded_config(spark, d):
    return cfg.load_config(configs(spark, d), key_columns(spark, d), skip_columns(spark, d))


def load_config(spark, d):
    return _flat(loaded_config(spark, d))


def effective_config(spark, d):
    return cfg.effective_config(configs(spark, d))


def config_missing_tables(spark, d):
    """Tables that orders ask for, against the enabled configs."""
    requested = load(spark, d, "orders").selectExpr("concat('cust_', CAST(o_custkey AS STRING)) AS table_name")
    return cfg.config_missing_tables(requested, configs(spark, d))


def seed_config(spark, d):
    existing = configs(spark, d).filter("enabled")
    return cfg.seed_config(existing, configs(spark, d).withColumn("severity", F.lit("info")))


def update_config(spark, d):
    updates = configs(spark, d).filter("comparison_mode = 'hash'").select(
        "table_name", F.lit(True).alias("enabled"), F.lit("no_pk_hash").alias("pk_fallback_strategy")
    )
    return cfg.update_config(configs(spark, d), updates)


def upsert_by_id(spark, d):
    rows = scenarios(spark, d).select("scenario_id", "mutation_type", "expected_status")
    incoming = scenarios(spark, d).filter("expected_status = 'error'").select(
        "scenario_id", "mutation_type", F.lit("schema_drift").alias("expected_status")
    )
    return cfg.upsert_by_id(rows, incoming, "scenario_id")


def orphan_config(spark, d):
    """Key columns of tables that have no enabled config."""
    return cfg.orphans(key_columns(spark, d), configs(spark, d).filter("enabled"))


def config_lint(spark, d):
    return cfg.config_lint(loaded_config(spark, d))


def mode_routing(spark, d):
    routed = cfg.mode_routing(loaded_config(spark, d))
    return routed.select("table_name", "comparison_mode", "effective_mode", "raw_status", "error_message")


def scenario_groups(spark, d):
    return cfg.scenario_listing(scenarios(spark, d))


def add_and_backfill(spark, d):
    """An event's ``seen_at`` exists on some rows only; the rest takes the event time."""
    events = load(spark, d, "events").select("event_id", "ts", F.expr("CASE WHEN event_id % 3 = 0 THEN ts END AS seen_at"))
    once = evolve(events, "seen_at", F.lit("2024-02-01").cast("timestamp_ntz"), "ts")
    return evolve(once, "loaded_at", F.lit("2024-02-01").cast("timestamp_ntz"), "created_at")


def backfill_check(spark, d):
    events = load(spark, d, "events").withColumn("seen_at", F.expr("CASE WHEN event_id % 3 = 0 THEN ts END"))
    return check(events, "seen_at")


QUERIES = {
    "load_config": load_config,
    "effective_config": effective_config,
    "config_missing_tables": config_missing_tables,
    "seed_config": seed_config,
    "update_config": update_config,
    "upsert_by_id": upsert_by_id,
    "orphan_config": orphan_config,
    "config_lint": config_lint,
    "mode_routing": mode_routing,
    "scenario_groups": scenario_groups,
    "add_and_backfill": add_and_backfill,
    "backfill_check": backfill_check,
}

_IDENT = "'^[A-Za-z_][A-Za-z0-9_]{0,62}$'"


def _lint(finding: str, value: str, where: str) -> str:
    return f"SELECT table_name, '{finding}' AS finding, {value} AS value FROM loaded WHERE {where}"


_LINTS = [
    *[_lint(f"invalid_{c}", c, f"{c} IS NOT NULL AND NOT regexp_matches({c}, {_IDENT})")
      for c in ("table_name", "source_schema", "source_table_name", "target_schema")],
    *[_lint(f"invalid_{c}", c, f"{c} NOT LIKE '%{{window_%' AND NOT regexp_matches({c}, {_IDENT})") for c in ("filter_column", "filter_column_source")],
    *[_lint(f"expression_{c}", c, f"{c} LIKE '%{{window_%'") for c in ("filter_column", "filter_column_source")],
    _lint("unknown_mode", "comparison_mode", "comparison_mode NOT IN ('basic', 'hash', 'hash_no_pk', 'advanced', 'advanced_no_pk')"),
    _lint("unknown_drift_policy", "schema_drift_policy", "schema_drift_policy NOT IN ('fail', 'ignore_extra', 'intersect', 'require_source_columns')"),
    _lint("unknown_severity", "severity", "severity NOT IN ('critical', 'warning', 'info')"),
    _lint("unknown_fallback", "pk_fallback_strategy", "pk_fallback_strategy NOT IN ('fail', 'no_pk_hash', 'no_pk_advanced')"),
    _lint("invalid_key_column", "'entity id'", "list_contains(key_cols, 'entity id')"),
    _lint("key_is_skipped", "'id'", "list_contains(key_cols, 'id') AND list_contains(skip_cols, 'id')"),
]


def _keyless_message(mode: str, keyless: str, strategy: str) -> str:
    return (f"'comparison_mode=''{mode}'' requires entries in validation.comparison_key_columns for table ''' || table_name || ''': add its keys, choose "
            f"''basic'' or ''{keyless}'', or set pk_fallback_strategy=''{strategy}'''")


ROUTED_SQL = f"""{LOADED_SQL},
routed AS (SELECT *, CASE
    WHEN comparison_mode NOT IN ('basic', 'hash', 'hash_no_pk', 'advanced', 'advanced_no_pk') THEN NULL
    WHEN len(key_cols) > 0 OR comparison_mode NOT IN ('hash', 'advanced') THEN comparison_mode
    WHEN comparison_mode = 'hash' AND lower(pk_fallback_strategy) = 'no_pk_hash' THEN 'hash_no_pk'
    WHEN comparison_mode = 'advanced' AND lower(pk_fallback_strategy) = 'no_pk_advanced' THEN 'advanced_no_pk' END AS effective_mode FROM loaded)"""

ORACLES = {
    "load_config": f"WITH {LOADED_SQL} SELECT {_FLAT}, {_FINAL_LISTS} FROM loaded",
    "effective_config": f"""WITH {CONFIG_SQL} SELECT * REPLACE (COALESCE(source_table_name, table_name) AS source_table_name,
        COALESCE(filter_column_source, filter_column) AS filter_column_source, COALESCE(filter_days, 7) AS filter_days,
        COALESCE(safety_lag_minutes, 30) AS safety_lag_minutes, COALESCE(numeric_tolerance, 0.001) AS numeric_tolerance,
        COALESCE(max_rows_advanced, 500000) AS max_rows_advanced, lower(COALESCE(pk_fallback_strategy, 'fail')) AS pk_fallback_strategy) FROM cfg""",
    "config_missing_tables": f"""WITH {CONFIG_SQL} SELECT DISTINCT concat('cust_', CAST(o_custkey AS STRING)) AS table_name FROM orders
        WHERE concat('cust_', CAST(o_custkey AS STRING)) NOT IN (SELECT table_name FROM cfg WHERE enabled)""",
    "seed_config": f"WITH {CONFIG_SQL} SELECT * REPLACE (CASE WHEN enabled THEN severity ELSE 'info' END AS severity) FROM cfg",
    "update_config": f"""WITH {CONFIG_SQL}, c AS (SELECT *, comparison_mode = 'hash' AND (NOT enabled OR pk_fallback_strategy IS DISTINCT FROM 'no_pk_hash') AS changed FROM cfg)
        SELECT * REPLACE (enabled OR changed AS enabled, CASE WHEN changed THEN 'no_pk_hash' ELSE pk_fallback_strategy END AS pk_fallback_strategy) FROM c""",
    "upsert_by_id": f"""WITH {SCENARIO_SQL} SELECT scenario_id, mutation_type, CASE WHEN expected_status = 'error' THEN 'schema_drift' ELSE expected_status END AS expected_status FROM scn""",
    "orphan_config": f"WITH {CONFIG_SQL} SELECT * FROM kc WHERE table_name NOT IN (SELECT table_name FROM cfg WHERE enabled)",
    "config_lint": f"WITH {LOADED_SQL} {' UNION ALL '.join(_LINTS)}",
    "mode_routing": f"""WITH {ROUTED_SQL} SELECT table_name, comparison_mode, effective_mode,
        CASE WHEN comparison_mode = 'fingerprint' THEN 'ERROR' WHEN effective_mode IS NULL THEN 'DATA_QUALITY_ERROR' END AS raw_status,
        CASE WHEN comparison_mode = 'fingerprint' THEN 'Unknown mode: fingerprint' WHEN effective_mode IS NOT NULL THEN NULL
          WHEN comparison_mode = 'hash' THEN {_keyless_message("hash", "hash_no_pk", "no_pk_hash")}
          ELSE {_keyless_message("advanced", "advanced_no_pk", "no_pk_advanced")} END AS error_message FROM routed""",
    "scenario_groups": f"WITH {SCENARIO_SQL} SELECT target_table, scenario_id, COUNT(*) OVER (PARTITION BY target_table) AS n_in_group FROM scn WHERE enabled ORDER BY 1, 2",
    "add_and_backfill": "SELECT event_id, ts, ts AS seen_at, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at FROM events",
    "backfill_check": "SELECT COUNT(*) AS total_rows, COUNT(CASE WHEN event_id % 3 = 0 THEN ts END) AS filled_rows FROM events",
}
