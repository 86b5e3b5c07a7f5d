"""Copies of a time window that can be repeated.

A window is copied by whole periods (hours, days or months): the copy is partitioned by the period of its time column, and
each period that the window touches is read whole and replaced whole. So a copy that is run again, after a crash or because
rows have changed, leaves the same rows as one that ran once, and never two of a row; other periods are not looked at.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from evenkeel.errors import ConfigError
from evenkeel.functions.sqltext import moment, name
from evenkeel.sources.files import Folder, partition_folder
from evenkeel.sources.window import use_utc, windowed_scan

#: How a period is written in the name of its folder.
PERIODS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd", "month": "yyyy-MM"}
PERIOD = "_period"


def whole_periods(start: datetime, end: datetime, period: str) -> tuple[datetime, datetime]:
    """The smallest run of whole periods around a window."""
    if period not in PERIODS:
        raise ConfigError(f"unknown period {period!r}; known: {', '.join(PERIODS)}")

    def floor(at: datetime) -> datetime:
        at = at.replace(minute=0, second=0, microsecond=0)
        return at if period == "hour" else at.replace(hour=0) if period == "day" else at.replace(hour=0, day=1)

    first, last = floor(start), floor(end)
    if last < end:
        if period == "month":
            last = last.replace(year=last.year + last.month // 12, month=last.month % 12 + 1)
        else:
            last = datetime.fromordinal(last.toordinal() + 1) if period == "day" or last.hour == 23 else last.replace(hour=last.hour + 1)
    return first, last


def _labels(spark: SparkSession, first: datetime, last: datetime, period: str) -> set[str]:
    step = f"INTERVAL 1 {period.upper()}"
    spans = spark.range(1).selectExpr(f"explode(sequence({moment(first)}, {moment(last)} - {step}, {step})) AS at")
    return {r[0] for r in spans.selectExpr(f"date_format(at, '{PERIODS[period]}')").collect()}  # the periods of a window


def copy_window(df: DataFrame, path: str, column: str, start: datetime, end: datetime, period: str = "day") -> int:
    """Copy the periods around ``[start, end)`` to the table at a path, in place of what it has of them; returns the rows
    written. Rows without a time are in no period."""
    spark = df.sparkSession
    use_utc(spark)
    first, last = whole_periods(start, end, period)
    if first >= last:
        return 0
    folder = Folder(spark, path)
    folder.fs.mkdirs(folder.at())
    before = set(folder.data_files())
    label = f"date_format({name(column)}, '{PERIODS[period]}') AS {PERIOD}"
    rows = windowed_scan(df, column, first, last).selectExpr("*", label)
    seen = Observation(f"copy-{uuid.uuid4().hex}")
    (
        rows.hint("rebalance", PERIOD).observe(seen, F.count(F.lit(1)).alias("n_rows"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(folder.root)
    )
    # periods that have no rows any more are not written, so what they had is still there
    for gone in _labels(spark, first, last, period):
        inside = f"{partition_folder(PERIOD, gone)}/"
        old = [f for f in before if f.startswith(inside)]
        if old and all(folder.exists(f) for f in old):
            folder.delete(inside.rstrip("/"))
    spark.catalog.refreshByPath(folder.root)
    return int(seen.get["n_rows"])


def read_copy(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The rows of a copy by windows, without its period."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path).drop(PERIOD)
