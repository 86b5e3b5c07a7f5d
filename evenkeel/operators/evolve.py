"""Schema evolution: add a column once, fill it, check that it is filled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_and_backfill(df: DataFrame, column: str, default: Column, fill_from: str | None = None) -> DataFrame:
    """Add ``column`` unless it exists, and give rows without a value that of ``fill_from`` if the
    table has it, else ``default``. Rows that have a value keep it, so a second run changes nothing."""
    source = [F.col(f"`{fill_from}`")] if fill_from in df.columns else []
    own = [F.col(f"`{column}`")] if column in df.columns else []
    # a table with a column to fill from is filled from that column alone
    return df.withColumn(column, F.coalesce(*own, *(source or [default])))


def backfill_check(df: DataFrame, column: str) -> DataFrame:
    """All rows and rows that have a value."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.count(F.col(f"`{column}`")).alias("filled_rows"))
