"""Tables as files: the shared folder, discovery, bulk copy and its summary."""

from __future__ import annotations

import tempfile
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.errors import ConfigError, ParityFailure
from evenkeel.functions.literals import literal_frame
from evenkeel.functions.names import safe_name
from evenkeel.operators.merge import check_merge_source, upsert_merge

COPY_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("error", T.StringType()),
])


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors can reach, as the session names it in ``spark.checkpoint.dir``.

    Where the setting is absent, a session on one machine gets a new local folder; on a cluster that is
    an error, because each executor would write to its own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ConfigError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


_SCOPE = threading.local()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, or in that of the scope that this thread is in."""
    return f"{getattr(_SCOPE, 'folder', None) or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Paths that this thread asks for inside are in a folder of their own, which is deleted at the end. What is computed
    from them must be written elsewhere before that."""
    before, folder = getattr(_SCOPE, "folder", None), scratch_path(spark, "scope")
    _SCOPE.folder = folder
    try:
        yield
    finally:
        _SCOPE.folder = before
        delete_path(spark, folder)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that Spark uses for it; one that is not there is no error."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def snapshot(df: DataFrame, label: str = "snapshot") -> DataFrame:
    """The frame as a table in the shared folder: fixed content with no lineage behind it, which a
    lost executor cannot change."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discover_tables(spark: SparkSession, folder: str) -> list[str]:
    """Names of the parquet tables in a folder, through the file system that Spark uses for it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    names = [s.getPath().getName() for s in path.getFileSystem(conf).listStatus(path)]
    return sorted(n.removesuffix(".parquet") for n in names if n.endswith(".parquet"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name, number of columns and number of rows."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), F.lit(len(df.columns)).alias("n_columns"), "n_rows"
        )
        for name, df in tables.items()
    ]
    out = counted[0]
    for one in counted[1:]:
        out = out.unionByName(one)
    return out


def catalog_tables(spark: SparkSession, schema: str) -> DataFrame:
    """Names of the tables of a catalog schema."""
    return spark.sql(f"SHOW TABLES IN {safe_name(schema, 'schema')}").filter("NOT isTemporary").select(F.col("tableName").alias("table_name"))


def _counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Rows that ``write`` wrote, counted by the write itself. The observation sits directly under the
    writer, in the result stage, where Spark counts each partition once even if its task is run again."""
    seen = Observation(f"copy-{uuid.uuid4().hex}")
    write(df.observe(seen, F.count(F.lit(1)).alias("n_rows")))
    return int(seen.get["n_rows"])


def _check_mode(mode: str) -> None:
    if mode not in ("overwrite", "append"):
        raise ConfigError(f"unknown write mode {mode!r}; known: overwrite, append")


def copy_table(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write a frame to parquet files and return the number of rows written."""
    _check_mode(mode)
    return _counted(df, lambda out: out.write.mode(mode).parquet(path))


def copy_to_catalog(df: DataFrame, table: str, mode: str = "overwrite", file_format: str = "parquet") -> int:
    """The same for a catalog table; overwriting replaces its schema too."""
    _check_mode(mode)
    name = ".".join(safe_name(part, "table name") for part in table.split("."))
    return _counted(df, lambda out: out.write.format(file_format).mode(mode).option("overwriteSchema", "true").saveAsTable(name))


@dataclass(frozen=True)
class CopyJob:
    """A table to copy. ``read`` is called at copy time, so a bad source fails that table alone. With a ``window`` (time
    column, start, end) the copy replaces the days of that window and can be repeated (``copies.copy_window``)."""

    table: str
    read: Callable[[], DataFrame]
    path: str
    mode: str = "overwrite"
    window: tuple[str, datetime, datetime] | None = None


def copy_tables(spark: SparkSession, jobs, parallel: int = 4) -> DataFrame:
    """Copy the tables, ``parallel`` at a time; a failure is recorded and does not stop the others."""
    from evenkeel.sources.copies import copy_window

    def copied(job: CopyJob) -> tuple:
        began = time.monotonic()
        try:
            safe_name(job.table, "table name")
            n = copy_window(job.read(), job.path, *job.window) if job.window else copy_table(job.read(), job.path, job.mode)
            status, error = "success", None
        except Exception as failure:  # noqa: BLE001 - isolation is the point
            n, status, error = 0, "failed", str(failure)
        return job.table, status, n, time.monotonic() - began, error

    with ThreadPoolExecutor(max(1, parallel)) as pool:
        return literal_frame(spark, list(pool.map(copied, jobs)), COPY_SCHEMA)


def copy_summary(results: DataFrame) -> DataFrame:
    """Tables, rows and seconds per status."""
    return results.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_tables"), F.sum("n_rows").alias("n_rows"), F.sum("seconds").alias("seconds")
    )


def fail_if_any(results: DataFrame, failing, name: str = "table_name", context: str = "run", show: int = 10) -> None:
    """Raise ``ParityFailure`` if a row is in a failing status; call it after the results are stored."""
    failed = results.filter(F.col("status").isin(*failing))
    n = failed.count()
    if n:
        names = [str(r[0]) for r in failed.orderBy(name).select(name).limit(show).collect()]
        more = f" and {n - len(names)} more" if n > len(names) else ""
        raise ParityFailure(f"{context}: failed for {', '.join(names)}{more}")


def merge_into(path: str, source: DataFrame, keys, delete_unmatched: bool = False) -> DataFrame:
    """Merge a frame into the parquet table at a path and return the table; a table that is not there is created.

    The merged table is written beside the old one, in its partitions, and takes its place by two renames, so readers see
    the old or the new rows and a failed merge changes nothing. After a crash between the renames the old table is at
    ``<path>.old-*``. One merge at a time may run on a table. ``merges.merge_touched`` rewrites only the files it must.
    """
    from evenkeel.sources.files import Folder, partition_columns

    spark = source.sparkSession
    check_merge_source(source, keys)
    jvm = spark._jvm
    table = jvm.org.apache.hadoop.fs.Path(path)
    fs, mark = table.getFileSystem(spark._jsc.hadoopConfiguration()), uuid.uuid4().hex
    staged, old = (jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.{kind}-{mark}") for kind in ("new", "old"))
    there = fs.exists(table)
    parts = partition_columns(Folder(spark, path).data_files()) if there else []
    merged = upsert_merge(spark.read.parquet(path), source, keys, delete_unmatched=delete_unmatched) if there else source
    (merged.hint("rebalance", *parts).write.partitionBy(*parts) if parts else merged.write).parquet(staged.toString())
    for before, after in ([(table, old)] if there else []) + [(staged, table)]:
        if not fs.rename(before, after):
            raise ConfigError(f"cannot rename {before} to {after}")
    if there:
        fs.delete(old, True)
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path)
