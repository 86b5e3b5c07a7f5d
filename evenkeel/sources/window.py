"""Half-open time windows ``[start, end)``, pushed down to the scan."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.errors import ConfigError
from evenkeel.functions import sqltext
from evenkeel.functions.names import safe_name
from evenkeel.functions.types import type_of
from evenkeel.spec import DEFAULT_FILTER_DAYS, DEFAULT_LAG_MINUTES

_PLACEHOLDERS = ("{window_start}", "{window_end}")


def use_utc(spark: SparkSession) -> None:
    """Put the session into UTC: windows and timestamp texts must not depend on where a job runs."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def window_bounds(now: datetime, days: int = DEFAULT_FILTER_DAYS, lag_minutes: int = DEFAULT_LAG_MINUTES) -> tuple[datetime, datetime]:
    """``end`` lies the safety lag before ``now``, ``start`` the given days before ``end`` (all UTC)."""
    end = now - timedelta(minutes=lag_minutes)
    return end - timedelta(days=days), end


def with_window_bounds(configs: DataFrame, now: str) -> DataFrame:
    """The same for a frame of effective settings; ``now`` is SQL for a ``timestamp_ntz`` in UTC."""
    return configs.selectExpr("*", f"timestampadd(MINUTE, -safety_lag_minutes, {now}) AS window_end").selectExpr(
        "*", "timestampadd(DAY, -filter_days, window_end) AS window_start"
    )


def iso_utc(ts: datetime) -> str:
    """A naive UTC time with microseconds and an explicit offset, the same instant in every session."""
    return ts.replace(tzinfo=timezone.utc).isoformat(timespec="microseconds")


def is_expression(filter_column: str) -> bool:
    return any(p in filter_column for p in _PLACEHOLDERS)


def fill_template(template: str, start: datetime, end: datetime) -> str:
    return template.replace(_PLACEHOLDERS[0], iso_utc(start)).replace(_PLACEHOLDERS[1], iso_utc(end))


def time_literal(ts: datetime, dtype: T.DataType) -> str:
    """SQL for an instant in the column's own type: a cast on the column would block the pushdown."""
    return sqltext.moment(ts) if isinstance(dtype, T.TimestampNTZType) else f"TIMESTAMP '{iso_utc(ts)}'"


def windowed_scan(df: DataFrame, column: str, start: datetime, end: datetime) -> DataFrame:
    """Rows with ``start <= column < end``; rows without a time are left out."""
    dtype = type_of(df, safe_name(column, "filter column"))
    name = sqltext.name(column)
    return df.filter(f"{name} >= {time_literal(start, dtype)} AND {name} < {time_literal(end, dtype)}")


def expr_window_scan(df: DataFrame, template: str, start: datetime, end: datetime, trusted: bool = False) -> DataFrame:
    """Rows that satisfy a SQL predicate with ``{window_start}`` and ``{window_end}`` in it.

    The template is code, so it must be marked as trusted. Columns may be written as ``"col"``; AND
    binds tighter than OR, as in any SQL.
    """
    if not trusted:
        raise ConfigError(f"filter expression is not marked as trusted: {template!r}")
    filled = fill_template(template, start, end)
    # string literals are matched first, so that a quoted word inside one stays as it is
    return df.filter(re.sub(r"""('(?:[^']|'')*')|"(\w+)\"""", lambda m: m[1] or f"`{m[2]}`", filled))


def scan(df: DataFrame, filter_column: str | None, start: datetime, end: datetime, trusted: bool = False) -> DataFrame:
    """The window as a config row states it: none, a column, or an expression."""
    if filter_column is None:
        return df
    if is_expression(filter_column):
        return expr_window_scan(df, filter_column, start, end, trusted)
    return windowed_scan(df, filter_column, start, end)


def windowed_count(df: DataFrame, filter_column: str | None, start: datetime, end: datetime, trusted: bool = False) -> DataFrame:
    return scan(df, filter_column, start, end, trusted).agg(F.expr("count(1) AS n"))
