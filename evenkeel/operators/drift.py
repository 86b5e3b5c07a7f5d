"""Known damage: functions that turn a table into a copy with one kind of difference.

Each takes a frame and returns a frame. Rows are picked in a fixed order (newest first by the filter
column, then by key or by content), so a run can be repeated and checked. A pick is a top-n that tasks
prune on their own; the planner knows its size from the limit and joins it accordingly.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.errors import ConfigError
from evenkeel.functions.canonical import canonical_columns, row_digest
from evenkeel.functions.names import safe_name
from evenkeel.functions.types import TIMESTAMP, holds_map, is_numeric, type_of
from evenkeel.operators.keys import require_keys
from evenkeel.sources.window import time_literal
from evenkeel.spec import NEW_KEY_OFFSET, NEW_KEY_PREFIX

def _content_order(df: DataFrame) -> list[Column]:
    return [F.expr(e) for e in canonical_columns(df, sorted(df.columns), timestamp_unit="microsecond").values()]


def pick_newest(df: DataFrame, n: int, filter_column: str | None, keys=()) -> DataFrame:
    """The newest ``n`` rows inside the window; give it a frame that is already windowed."""
    newest = [F.col(f"`{filter_column}`").desc()] if filter_column else []
    if keys:
        return df.orderBy(*newest, *[F.col(f"`{k}`") for k in keys]).limit(n)
    if filter_column:
        # The time of the nth row decides who can be picked, so content is made to text for those alone.
        time = F.col(f"`{filter_column}`")
        last = df.select(time).orderBy(time.desc()).limit(n).agg(F.struct(F.min(time).alias("at"), F.bool_or(time.isNull()).alias("all_rows"))).scalar()
        df = df.filter(last["all_rows"] | (time >= last["at"]))
    return df.orderBy(*newest, *_content_order(df)).limit(n)


def bump_into_window(df: DataFrame, filter_column: str | None, at: datetime) -> DataFrame:
    """Set the filter column to a time inside the window, if it holds times."""
    if not filter_column or not isinstance(type_of(df, filter_column), TIMESTAMP):
        return df
    return df.withColumn(filter_column, F.expr(time_literal(at, type_of(df, filter_column))))


def noop(df: DataFrame) -> DataFrame:
    return df


def _victims(df: DataFrame, keys, n: int, filter_column: str | None) -> DataFrame:
    require_keys(df, keys)
    return pick_newest(df, n, filter_column, keys).select(*[F.col(f"`{k}`").alias(f"v__{k}") for k in keys])


def _on_keys(keys) -> list[Column]:
    return [F.col(f"`{k}`") == F.col(f"`v__{k}`") for k in keys]


def delete_rows(df: DataFrame, keys, count: int = 50, filter_column: str | None = None) -> DataFrame:
    """Remove the newest rows, by key."""
    return df.join(_victims(df, keys, count, filter_column), _on_keys(keys), "left_anti")


def insert_extra_rows(df: DataFrame, keys, at: datetime, count: int = 30, filter_column: str | None = None) -> DataFrame:
    """Add clones of the newest rows under keys that do not exist yet."""
    first = keys[0]
    clones = pick_newest(df, count, filter_column, keys)
    if is_numeric(type_of(df, first)):
        largest = df.agg(F.coalesce(F.max(F.col(f"`{first}`")), F.lit(0))).scalar()
        clones = clones.withColumn(first, (F.col(f"`{first}`") + largest + NEW_KEY_OFFSET).cast(type_of(df, first)))
    else:
        clones = clones.withColumn(first, F.concat(F.lit(NEW_KEY_PREFIX), F.col(f"`{first}`").cast("string")))
    return df.unionByName(bump_into_window(clones, filter_column, at))


def update_column(
    df: DataFrame, keys, column: str, value: Column, at: datetime, count: int = 20, filter_column: str | None = None
) -> DataFrame:
    """Overwrite a column on the newest rows and keep those rows inside the window."""
    _changeable(df, column, (*keys, filter_column))
    hit = _victims(df, keys, count, filter_column).withColumn("v__hit", F.lit(True))
    joined = df.join(hit, _on_keys(keys), "left_outer")
    changed = F.coalesce(F.col("v__hit"), F.lit(False))
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if f.name == column:
            col = F.when(changed, value.cast(f.dataType)).otherwise(col)
        elif f.name == filter_column and isinstance(f.dataType, TIMESTAMP):
            col = F.when(changed, F.expr(time_literal(at, f.dataType))).otherwise(col)
        out.append(col.alias(f.name))
    return joined.select(*out)


def add_extra_column(df: DataFrame, column_name: str = "scenario_extra") -> DataFrame:
    return df.withColumn(safe_name(column_name, "column"), F.lit(None).cast("string"))


def _changeable(df: DataFrame, column: str, needed) -> None:
    """A mutation that changes nothing would look like a check that finds nothing."""
    if column not in df.columns:
        raise ConfigError(f"no column {column!r} to change")
    if column in needed:
        raise ConfigError(f"column {column!r} is a key or the filter column and must stay")


def drop_column(df: DataFrame, column_name: str, needed=()) -> DataFrame:
    """Without a column; ``needed`` ones are refused."""
    _changeable(df, column_name, needed)
    return df.drop(column_name)


def null_out_key(df: DataFrame, keys, count: int = 5) -> DataFrame:
    """Set the first key to null on the rows of the first keys."""
    require_keys(df, keys)
    order = [F.col(f"`{k}`") for k in keys]
    some = df.filter(F.col(f"`{keys[0]}`").isNotNull()).select(*order).distinct().orderBy(*order).limit(count)
    hit = some.select(*[F.col(f"`{k}`").alias(f"v__{k}") for k in keys], F.lit(True).alias("v__hit"))
    joined = df.join(hit, _on_keys(keys), "left_outer")
    first = keys[0]
    return joined.select(*[
        (F.when(F.col("v__hit").isNull(), F.col(f"`{c}`")) if c == first else F.col(f"`{c}`")).alias(c) for c in df.columns
    ])


def clear_keys(key_columns: DataFrame, table: str) -> DataFrame:
    """The key config without the keys of a table. The frame passed in stays as it is, so there is
    nothing to back up or restore."""
    return key_columns.filter(F.col("table_name") != table)


def _without_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Drop every row that equals one of the few ``rows`` in all columns, nulls included. Maps have no equality, so
    rows that hold one are matched by the digest of their exact content."""
    if not any(holds_map(f.dataType) for f in df.schema.fields):
        victims = rows.select(*[F.col(f"`{c}`").alias(f"v__{c}") for c in df.columns])
        same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`v__{c}`")) for c in df.columns]
        return df.join(victims, same, "left_anti")
    exact = {"decimals": None, "timestamp_unit": "microsecond"}
    victims = rows.selectExpr(f"{row_digest(rows, rows.columns, **exact)} AS v__row")
    marked = df.selectExpr("*", f"{row_digest(df, df.columns, **exact)} AS __row")
    return marked.join(victims, F.expr("__row = v__row"), "left_anti").drop("__row")


def delete_rows_keyless(df: DataFrame, count: int = 1, filter_column: str | None = None) -> DataFrame:
    """Remove the newest rows by content. Exact copies of a picked row go with it."""
    return _without_rows(df, pick_newest(df, count, filter_column))


def _mutate(rows: DataFrame, suffix: str, filter_column: str | None) -> DataFrame:
    """Make each row different from any other: mark its first text column, else add 1 to its first number."""
    for f in rows.schema.fields:
        if isinstance(f.dataType, T.StringType) and f.name != filter_column:
            return rows.withColumn(f.name, F.concat(F.coalesce(F.col(f"`{f.name}`"), F.lit("")), F.lit(suffix)))
    for f in rows.schema.fields:
        if is_numeric(f.dataType) and f.name != filter_column:
            return rows.withColumn(f.name, (F.col(f"`{f.name}`") + 1).cast(f.dataType))
    raise ConfigError("no text or numeric column to change besides the filter column")


def insert_extra_rows_keyless(
    df: DataFrame, at: datetime | None = None, count: int = 1, mutate: bool = False, suffix: str = "_scn",
    filter_column: str | None = None,
) -> DataFrame:
    """Add copies of the newest rows: verbatim, or changed so that they are new. With ``at`` the copies
    get that time in the filter column; without, a verbatim copy is an exact duplicate."""
    copies = pick_newest(df, count, filter_column)
    if at is not None:
        copies = bump_into_window(copies, filter_column, at)
    return df.unionByName(_mutate(copies, suffix, filter_column) if mutate else copies)


def content_swap_keyless(df: DataFrame, suffix: str = "_swap", filter_column: str | None = None) -> DataFrame:
    """Replace the newest row by a changed one; the number of rows stays the same when it is unique."""
    victim = pick_newest(df, 1, filter_column)
    return _without_rows(df, victim).unionByName(_mutate(victim, suffix, filter_column))


def share_of(keys, fraction: float) -> Column:
    """True for about ``fraction`` of the keys; the same keys in every run and every engine with MD5."""
    text = F.concat_ws("|", *[F.col(f"`{k}`").cast("string") for k in keys])
    position = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return position < F.lit(int(fraction * 2**32))


def update_fraction(
    df: DataFrame, keys, assignments: dict[str, Column], at: datetime, fraction: float = 0.3, filter_column: str | None = None
) -> DataFrame:
    """Apply ``assignments`` to a fixed share of the rows and move those rows to time ``at``."""
    require_keys(df, keys)
    hit = share_of(keys, fraction)
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if f.name in assignments:
            col = F.when(hit, assignments[f.name].cast(f.dataType)).otherwise(col)
        elif f.name == filter_column and isinstance(f.dataType, TIMESTAMP):
            col = F.when(hit, F.expr(time_literal(at, f.dataType))).otherwise(col)
        out.append(col.alias(f.name))
    return df.select(*out)
