"""Config tables as frames: load, defaults, routing, seeding, updates, lint."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.errors import ConfigError
from evenkeel.functions.literals import literal_frame
from evenkeel.operators.keys import require_keys
from evenkeel.spec import (
    DEFAULT_FILTER_DAYS, DEFAULT_LAG_MINUTES, DEFAULT_MAX_ROWS_ADVANCED, DEFAULT_TOLERANCE,
    DRIFT_POLICIES, FALLBACK_BY_MODE, FALLBACK_STRATEGIES, IDENTIFIER_PATTERN, KEYED_MODES,
    MISSING_KEYS_TEXT, MODES, SEVERITIES, TableSpec,
)


def load_config(configs: DataFrame, key_columns: DataFrame, skip_columns: DataFrame, disabled: bool = False) -> DataFrame:
    """Enabled configs (with ``disabled`` all, as the scenario gate needs them) with ``key_cols`` (by ordinal) and ``skip_cols`` (by name).

    Keys and skips are gathered on their own before they are joined, so they cannot multiply each
    other. Each is reduced to one row per column first: a list is never longer than the table is
    wide, however often a column is repeated in the config.
    """
    keys = (
        key_columns.groupBy("table_name", "column_name").agg(F.min("ordinal").alias("ordinal"))
        .groupBy("table_name").agg(F.array_sort(F.collect_list(F.struct("ordinal", "column_name"))).alias("key_cols"))
        .withColumn("key_cols", F.transform("key_cols", lambda k: k["column_name"]))
    )
    skips = (
        skip_columns.select("table_name", "column_name").distinct()
        .groupBy("table_name").agg(F.array_sort(F.collect_list("column_name")).alias("skip_cols"))
    )
    none = F.array().cast("array<string>")
    return (
        (configs if disabled else configs.filter("enabled"))
        .join(keys, "table_name", "left")
        .join(skips, "table_name", "left")
        .withColumn("key_cols", F.coalesce("key_cols", none))
        .withColumn("skip_cols", F.coalesce("skip_cols", none))
    )


def effective_config(configs: DataFrame) -> DataFrame:
    """Config rows with defaults in place of nulls; an explicit 0 is kept."""
    return configs.withColumns({
        "source_table_name": F.coalesce("source_table_name", "table_name"),
        "filter_column_source": F.coalesce("filter_column_source", "filter_column"),
        "filter_days": F.coalesce("filter_days", F.lit(DEFAULT_FILTER_DAYS)),
        "safety_lag_minutes": F.coalesce("safety_lag_minutes", F.lit(DEFAULT_LAG_MINUTES)),
        "numeric_tolerance": F.coalesce("numeric_tolerance", F.lit(DEFAULT_TOLERANCE)),
        "max_rows_advanced": F.coalesce("max_rows_advanced", F.lit(DEFAULT_MAX_ROWS_ADVANCED)),
        "pk_fallback_strategy": F.lower(F.coalesce("pk_fallback_strategy", F.lit("fail"))),
    })


def missing_keys_message(mode: str, table: str) -> str:
    strategy, keyless = FALLBACK_BY_MODE[mode]
    return (
        f"comparison_mode='{mode}' {MISSING_KEYS_TEXT} for table '{table}': add its keys, choose "
        f"'basic' or '{keyless}', or set pk_fallback_strategy='{strategy}'"
    )


def route(mode: str, has_keys: bool, strategy: str | None) -> str | None:
    """The mode that runs; ``None`` if the table has no keys and no fallback that fits its mode."""
    if mode not in MODES:
        raise ConfigError(f"Unknown mode: {mode}")
    if has_keys or mode not in KEYED_MODES:
        return mode
    wanted, keyless = FALLBACK_BY_MODE[mode]
    return keyless if (strategy or "").lower() == wanted else None


def mode_routing(loaded: DataFrame) -> DataFrame:
    """``effective_mode``, or ``raw_status`` and ``error_message`` for rows that cannot run, for a
    whole config table (the output of ``load_config``)."""
    mode, table = F.col("comparison_mode"), F.col("table_name")
    keyless = (F.size("key_cols") == 0) & mode.isin(*KEYED_MODES)
    strategy = F.lower(F.coalesce("pk_fallback_strategy", F.lit("fail")))
    fallback = F.lit(None).cast("string")
    message = F.lit(None).cast("string")
    for keyed, (wanted, target) in FALLBACK_BY_MODE.items():
        fallback = F.when((mode == keyed) & (strategy == wanted), target).otherwise(fallback)
        parts = missing_keys_message(keyed, "\0").split("\0")
        message = F.when(mode == keyed, F.concat(F.lit(parts[0]), table, F.lit(parts[1]))).otherwise(message)
    known = mode.isin(*MODES)
    effective = F.when(~known, F.lit(None)).when(keyless, fallback).otherwise(mode)
    return loaded.withColumn("effective_mode", effective).withColumns({
        "raw_status": F.when(~known, "ERROR").when(F.col("effective_mode").isNull(), "DATA_QUALITY_ERROR"),
        "error_message": F.when(~known, F.concat(F.lit("Unknown mode: "), mode)).when(F.col("effective_mode").isNull(), message),
    })


def parse_table_filter(requested) -> list[str]:
    """Table names from a list, a JSON list or comma-separated text."""
    if requested is None:
        return []
    if isinstance(requested, str):
        try:
            parsed = json.loads(requested)
        except ValueError:
            parsed = None
        requested = parsed if isinstance(parsed, list) else requested.split(",")
    return [name.strip() for name in requested if name.strip()]


def config_missing_tables(requested: DataFrame, configs: DataFrame) -> DataFrame:
    """Requested table names that no enabled config has."""
    enabled = configs.filter("enabled").select("table_name").distinct()
    return requested.select("table_name").distinct().join(enabled, "table_name", "left_anti")


def select_tables(configs: DataFrame, requested) -> DataFrame:
    """Enabled configs of the requested tables; a missing one raises instead of being skipped."""
    names = parse_table_filter(requested)
    if not names:
        return configs.filter("enabled")
    wanted = literal_frame(configs.sparkSession, [(n,) for n in names], T.StructType([T.StructField("table_name", T.StringType())]))
    missing = [r[0] for r in config_missing_tables(wanted, configs).orderBy("table_name").collect()]
    if missing:
        raise ConfigError(f"requested tables have no enabled config: {missing}; nothing was run")
    return configs.filter("enabled").join(wanted.distinct(), "table_name", "left_semi")


def seed_config(existing: DataFrame, seeds: DataFrame, key: str = "table_name") -> DataFrame:
    """Existing rows plus the seeds whose table is not configured yet; safe to repeat."""
    known = existing.select(key).distinct()
    return existing.unionByName(seeds.join(known, key, "left_anti"), allowMissingColumns=True)


def update_config(configs: DataFrame, updates: DataFrame) -> DataFrame:
    """Set the columns that ``updates`` (one row per table) has, on the rows where they differ.

    A null on either side counts as different; rows that already agree are left as they are and
    are marked by ``changed = false``.
    """
    require_keys(updates, ["table_name"])
    fields = [c for c in updates.columns if c != "table_name"]
    new = updates.select("table_name", *[F.col(c).alias(f"new__{c}") for c in fields], F.lit(True).alias("new__here"))
    joined = configs.join(new, "table_name", "left")
    unequal = F.lit(False)
    for c in fields:
        unequal = unequal | ~F.col(c).eqNullSafe(F.col(f"new__{c}"))
    changed = F.coalesce(F.col("new__here"), F.lit(False)) & unequal
    return joined.select(
        *[(F.when(changed, F.col(f"new__{c}")).otherwise(F.col(c)) if c in fields else F.col(c)).alias(c) for c in configs.columns],
        changed.alias("changed"),
    )


def upsert_by_id(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Replace all rows of each incoming id by the incoming rows."""
    return existing.join(incoming.select(key).distinct(), key, "left_anti").unionByName(incoming)


def orphans(rows: DataFrame, tables: DataFrame, column: str = "table_name") -> DataFrame:
    """Config or scenario rows whose table does not exist."""
    return rows.join(tables.select(F.col("table_name").alias(column)).distinct(), column, "left_anti")


def without_orphans(rows: DataFrame, tables: DataFrame, column: str = "table_name") -> DataFrame:
    return rows.join(tables.select(F.col("table_name").alias(column)).distinct(), column, "left_semi")


def _finding(condition: Column, name: str, value: Column) -> Column:
    return F.when(condition, F.struct(F.lit(name).alias("finding"), value.cast("string").alias("value")))


def config_lint(loaded: DataFrame) -> DataFrame:
    """One row per problem of a config row (the output of ``load_config``)."""

    def bad_name(column: str) -> Column:
        return F.col(column).isNotNull() & ~F.col(column).rlike(IDENTIFIER_PATTERN)

    def not_one_of(column: str, allowed) -> Column:
        return F.col(column).isNotNull() & ~F.col(column).isin(*allowed)

    def is_template(column: str) -> Column:
        return F.coalesce(F.contains(F.col(column), F.lit("{window_")), F.lit(False))

    skipped_keys = F.array_intersect("key_cols", "skip_cols")
    bad_keys = F.filter("key_cols", lambda c: ~c.rlike(IDENTIFIER_PATTERN))
    bad_skips = F.filter("skip_cols", lambda c: ~c.rlike(IDENTIFIER_PATTERN))
    findings = [
        *[_finding(bad_name(c), f"invalid_{c}", F.col(c))
          for c in ("table_name", "source_schema", "source_table_name", "target_schema")],
        *[_finding(bad_name(c) & ~is_template(c), f"invalid_{c}", F.col(c)) for c in ("filter_column", "filter_column_source")],
        *[_finding(is_template(c), f"expression_{c}", F.col(c)) for c in ("filter_column", "filter_column_source")],
        _finding(F.col("comparison_mode").isNull() | not_one_of("comparison_mode", MODES), "unknown_mode", F.col("comparison_mode")),
        _finding(not_one_of("schema_drift_policy", DRIFT_POLICIES), "unknown_drift_policy", F.col("schema_drift_policy")),
        _finding(not_one_of("severity", SEVERITIES), "unknown_severity", F.col("severity")),
        _finding(not_one_of("pk_fallback_strategy", FALLBACK_STRATEGIES), "unknown_fallback", F.col("pk_fallback_strategy")),
        _finding(F.size(bad_keys) > 0, "invalid_key_column", F.array_join(bad_keys, ",")),
        _finding(F.size(bad_skips) > 0, "invalid_skip_column", F.array_join(bad_skips, ",")),
        _finding(F.size(skipped_keys) > 0, "key_is_skipped", F.array_join(F.array_sort(skipped_keys), ",")),
    ]
    return loaded.select("table_name", F.explode(F.array_compact(F.array(*findings))).alias("f")).select(
        "table_name", "f.finding", "f.value"
    )


def scenario_listing(scenarios: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Enabled scenarios, optionally only the given ids, in table order with the size of their table's
    group. Groups are told apart by the table column and are never gathered into one row."""
    picked = scenarios.filter("enabled")
    if only is not None:
        picked = picked.join(only.select("scenario_id").distinct(), "scenario_id", "left_semi")
    sizes = picked.groupBy("target_table").agg(F.count(F.lit(1)).alias("n_in_group"))
    return picked.select("target_table", "scenario_id").join(sizes, "target_table").orderBy("target_table", "scenario_id")


def to_specs(loaded: DataFrame) -> list[TableSpec]:
    """Specs for the driver loop over tables; one row per configured table is the only thing read."""
    return [
        TableSpec(
            name=r["table_name"], mode=r["comparison_mode"], keys=tuple(r["key_cols"]), skip=tuple(r["skip_cols"]),
            drift_policy=r["schema_drift_policy"], tolerance=r["numeric_tolerance"],
            pk_fallback_strategy=r["pk_fallback_strategy"],
            filter_column=r["filter_column"], filter_column_source=r["filter_column_source"] or r["filter_column"],
            filter_days=r["filter_days"], safety_lag_minutes=r["safety_lag_minutes"],
        )
        for r in loaded.orderBy("table_name").toLocalIterator()
    ]
