"""Enumerations, defaults, table schemas and the per-table comparison spec."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Modes, policies, statuses, types, defaults and limits shared with existing configs.
MODES = ("basic", "hash", "hash_no_pk", "advanced", "advanced_no_pk")
DRIFT_POLICIES = ("fail", "ignore_extra", "intersect", "require_source_columns")
SEVERITIES = ("critical", "warning", "info")
FALLBACK_STRATEGIES = ("fail", "no_pk_hash", "no_pk_advanced")
RAW_STATUSES = ("PASS", "FAIL", "INCONCLUSIVE", "ERROR", "DATA_QUALITY_ERROR")
FAILING_STATUSES = (
    "inconclusive", "count_mismatch", "hash_mismatch", "column_mismatch", "schema_drift", "error",
)
KEYED_MODES = ("hash", "advanced")
FALLBACK_BY_MODE = {"hash": ("no_pk_hash", "hash_no_pk"), "advanced": ("no_pk_advanced", "advanced_no_pk")}
MUTATIONS = (
    "noop", "delete_rows", "insert_extra_rows", "update_column", "add_extra_column", "drop_column",
    "null_out_pk", "clear_key_cols", "delete_rows_no_pk", "insert_extra_rows_no_pk", "content_swap_no_pk",
)
IDENTIFIER_PATTERN = r"^[A-Za-z_][A-Za-z0-9_]{0,62}$"
MISSING_KEYS_TEXT = "requires entries in validation.comparison_key_columns"
PRESENT = "EXISTS"
DEFAULT_FILTER_DAYS = 7
DEFAULT_LAG_MINUTES = 30
DEFAULT_TOLERANCE = 0.001
DEFAULT_MAX_ROWS_ADVANCED = 500_000
HASH_DECIMALS = 8
NEW_KEY_OFFSET = 10_000_000
NEW_KEY_PREFIX = "scn_test_"
FETCH_SIZE = 10_000
WRITE_BATCH_SIZE = 100_000
JDBC_PARTITIONS = 4

CONFIG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("source_schema", T.StringType()),
    T.StructField("source_table_name", T.StringType()),
    T.StructField("target_schema", T.StringType()),
    T.StructField("comparison_mode", T.StringType()),
    T.StructField("filter_column", T.StringType()),
    T.StructField("filter_column_source", T.StringType()),
    T.StructField("filter_days", T.IntegerType()),
    T.StructField("safety_lag_minutes", T.IntegerType()),
    T.StructField("schema_drift_policy", T.StringType()),
    T.StructField("numeric_tolerance", T.DoubleType()),
    T.StructField("max_rows_advanced", T.IntegerType()),
    T.StructField("severity", T.StringType()),
    T.StructField("enabled", T.BooleanType()),
    T.StructField("pk_fallback_strategy", T.StringType()),
])

KEY_COLUMNS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("ordinal", T.IntegerType()),
])

SKIP_COLUMNS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
])

# What one comparison measures, before run metadata is added.
OUTCOME_SCHEMA = T.StructType([
    T.StructField("comparison_mode", T.StringType()),
    T.StructField("source_count", T.LongType()),
    T.StructField("target_count", T.LongType()),
    T.StructField("count_match", T.BooleanType()),
    T.StructField("rows_only_in_source", T.LongType()),
    T.StructField("rows_only_in_target", T.LongType()),
    T.StructField("rows_with_mismatches", T.LongType()),
    T.StructField("raw_status", T.StringType()),
    T.StructField("error_message", T.StringType()),
])

RESULT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("comparison_mode", T.StringType()),
    T.StructField("window_start", T.TimestampNTZType()),
    T.StructField("window_end", T.TimestampNTZType()),
    T.StructField("safety_lag_minutes", T.IntegerType()),
    T.StructField("source_count", T.LongType()),
    T.StructField("target_count", T.LongType()),
    T.StructField("count_match", T.BooleanType()),
    T.StructField("rows_only_in_source", T.LongType()),
    T.StructField("rows_only_in_target", T.LongType()),
    T.StructField("rows_with_mismatches", T.LongType()),
    T.StructField("mismatch_count", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("executed_at", T.TimestampNTZType()),
    T.StructField("duration_seconds", T.DoubleType()),
])

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("ended_at", T.TimestampNTZType()),
    T.StructField("overall", T.StringType()),
    T.StructField("total_tables", T.LongType()),
    T.StructField("pass_count", T.LongType()),
    T.StructField("fail_count", T.LongType()),
])

SAMPLE_SCHEMA = T.StructType([
    T.StructField("mismatch_type", T.StringType()),
    T.StructField("pk_values", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("source_value", T.StringType()),
    T.StructField("target_value", T.StringType()),
])

SCENARIO_SCHEMA = T.StructType([
    T.StructField("scenario_id", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("target_table", T.StringType()),
    T.StructField("mutation_type", T.StringType()),
    T.StructField("mutation_params", T.StringType()),
    T.StructField("expected_status", T.StringType()),
    T.StructField("valid_comparison_modes", T.StringType()),
    T.StructField("enabled", T.BooleanType()),
    T.StructField("created_at", T.TimestampNTZType()),
])


@dataclass(frozen=True)
class TableSpec:
    """How one pair of tables is compared. Only ``None`` stands for a default; 0 is a real value. All
    evidence is kept unless ``sample_cap`` asks for so many rows of a class. ``by_segments`` makes the hash modes look
    for segments that differ before they move rows; ``unique_keys`` says that a constraint keeps the keys of both sides
    unique and without nulls, which then is not checked where the sides are equal. ``json_columns`` are compared as JSON
    values and not as text; ``collations`` has (column, collation) pairs of columns, keys among them, in which trailing
    blanks or case do not count."""

    name: str
    mode: str
    keys: tuple[str, ...] = ()
    skip: tuple[str, ...] = ()
    drift_policy: str = "fail"
    tolerance: float | None = None
    pk_fallback_strategy: str | None = None
    timestamp_unit: str | None = None
    sample_cap: int | None = None
    by_segments: bool = False
    unique_keys: bool = False
    json_columns: tuple[str, ...] = ()
    collations: tuple[tuple[str, str], ...] = ()
    filter_column: str | None = None
    filter_column_source: str | None = None
    filter_days: int | None = None
    safety_lag_minutes: int | None = None

    @property
    def effective_tolerance(self) -> float:
        return DEFAULT_TOLERANCE if self.tolerance is None else float(self.tolerance)

    @property
    def effective_days(self) -> int:
        return DEFAULT_FILTER_DAYS if self.filter_days is None else self.filter_days

    @property
    def effective_lag(self) -> int:
        return DEFAULT_LAG_MINUTES if self.safety_lag_minutes is None else self.safety_lag_minutes
