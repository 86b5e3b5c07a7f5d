"""Key checks and key-only differences.

Everything here groups by the key before it looks at it. Copies of one key collapse into a count
inside each map task, so a key that holds a large share of the rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.errors import ConfigError
from evenkeel.functions.sqltext import any_null, names
from evenkeel.operators.columns import align


def require_keys(df: DataFrame, keys, what: str = "keys") -> None:
    missing = [k for k in keys if k not in df.columns]
    if not keys or missing:
        raise ConfigError(f"{what} {missing or list(keys)} not found in columns {df.columns}")


def key_quality(df: DataFrame, keys) -> DataFrame:
    """One row: all rows, rows with a null in the key, distinct keys, surplus copies."""
    require_keys(df, keys)
    return (
        df.groupBy(*names(keys))
        .agg(F.expr("count(1) AS __n"))
        .agg(
            F.expr("CAST(coalesce(sum(__n), 0) AS BIGINT) AS total_rows"),
            F.expr(f"CAST(coalesce(sum(if({any_null(keys)}, __n, 0)), 0) AS BIGINT) AS null_key_rows"),
            F.expr("count(1) AS distinct_keys"),
        )
        .selectExpr("*", "total_rows - distinct_keys AS duplicate_rows")
    )


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    require_keys(df, keys)
    return df.groupBy(*names(keys)).agg(F.expr("count(1) AS n_rows")).filter("n_rows > 1")


def key_counts(source: DataFrame, target: DataFrame, keys) -> DataFrame:
    """Per key: number of rows on each side. One shuffle of keys, no join."""
    require_keys(source, keys)
    require_keys(target, keys)
    s, t = align(source, target, keys)
    return (
        s.selectExpr("*", "1 AS __s", "0 AS __t")
        .unionByName(t.selectExpr("*", "0 AS __s", "1 AS __t"))
        .groupBy(*names(keys))
        .agg(F.expr("sum(__s) AS n_source"), F.expr("sum(__t) AS n_target"))
    )


def keys_only_in_source(source: DataFrame, target: DataFrame, keys) -> DataFrame:
    """Keys without a partner in the target, with their number of rows. A null never has a partner."""
    lone = key_counts(source, target, keys).filter(f"n_source > 0 AND (n_target = 0 OR {any_null(keys)})")
    return lone.selectExpr(*names(keys), "n_source AS n_rows")


def keys_only_in_target(source: DataFrame, target: DataFrame, keys) -> DataFrame:
    """Keys without a partner in the source, with their number of rows. A null never has a partner."""
    lone = key_counts(source, target, keys).filter(f"n_target > 0 AND (n_source = 0 OR {any_null(keys)})")
    return lone.selectExpr(*names(keys), "n_target AS n_rows")
