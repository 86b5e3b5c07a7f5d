"""Merges into stored tables that rewrite only the files they touch.

The files that hold a matched key are found by reading keys and file names alone. Their rows are merged with the source
and written anew into a hidden folder of the table, in its partitions; all other files stay as they are. A journal, written
when the new files are complete, names the files that come and go. Then the old files go and the new ones take their
place. A crash before the journal changes nothing, and what it left is removed by the next merge; after a crash behind it
the next merge, or ``finish``, does the rest. Readers may miss rows of the touched files while these are exchanged, but see
none twice. One merge at a time may run on a table.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.errors import ConfigError
from evenkeel.functions.literals import literal_frame
from evenkeel.functions.names import safe_name
from evenkeel.functions.sqltext import name
from evenkeel.functions.types import INTEGRAL, TIMESTAMP
from evenkeel.operators.merge import check_merge_source, upsert_merge
from evenkeel.sources.files import Folder, partition_columns, read_files

_WORK, _JOURNAL = "_merges", "journal.json"
FILES_SCHEMA = T.StructType([T.StructField("file", T.StringType()), T.StructField("action", T.StringType())])
_BOUNDED = INTEGRAL + TIMESTAMP + (T.DateType, T.StringType, T.DecimalType)


@dataclass(frozen=True)
class Merged:
    """What a merge did to the files of a table: relative names."""

    kept: tuple[str, ...]
    rewritten: tuple[str, ...]
    removed: tuple[str, ...]
    added: tuple[str, ...]

    def files(self, spark: SparkSession) -> DataFrame:
        """One row per file: kept, rewritten (read and replaced), removed (without a trace) or added (new content)."""
        rows = [(f, action) for action in ("kept", "rewritten", "removed", "added") for f in getattr(self, action)]
        return spark.createDataFrame(rows, FILES_SCHEMA) if len(rows) > 100 else literal_frame(spark, rows, FILES_SCHEMA)


def finish(spark: SparkSession, path: str) -> None:
    """Complete a merge whose journal is written, and remove what an unfinished one left."""
    folder = Folder(spark, path)
    for merge in folder.names(_WORK):
        work = f"{_WORK}/{merge}"
        if folder.exists(f"{work}/{_JOURNAL}"):
            _exchange(folder, work, json.loads(folder.read_text(f"{work}/{_JOURNAL}")))
        folder.delete(work)
    if folder.exists(_WORK):
        folder.delete(_WORK)


def _exchange(folder: Folder, work: str, journal: dict) -> None:
    for f in journal["gone"]:
        folder.delete(f)
    for f in journal["new"]:
        folder.move(f"{work}/data/{f}", f)


def _between(source: DataFrame, keys, target: DataFrame) -> str:
    """The range of the source's keys as a filter for the scan of the target."""
    bounded = [k for k in keys if isinstance(source.schema[k].dataType, _BOUNDED) and source.schema[k].dataType == target.schema[k].dataType]
    if not bounded:
        return "true"
    ends = source.agg(*[F.expr(f"to_json(named_struct('a', min({name(k)}), 'b', max({name(k)})))") for k in bounded]).first()
    tests = []
    for k, text in zip(bounded, ends):
        kind = f"a {source.schema[k].dataType.simpleString()}, b {source.schema[k].dataType.simpleString()}"
        value = "from_json('{}', '{}')".format(text.replace("\\", "\\\\").replace("'", "\\'"), kind)
        tests.append(f"{name(k)} >= {value}.a AND {name(k)} <= {value}.b")
    return " AND ".join(tests)


def merge_touched(
    path: str, source: DataFrame, keys, delete_unmatched: bool = False, partition_by=(), schema: T.StructType | None = None
) -> Merged:
    """Merge a frame into the parquet table at a path, by ``upsert_merge``, and say which files that took.

    Matched rows take the values of the source, new rows are added, unmatched rows stay or, on demand, go. A table that is
    not there is created, partitioned by ``partition_by``; one that is keeps its partition columns, and a row whose
    partition value changes moves. ``schema`` is that of the table, where file names do not tell the type of a partition
    column.
    """
    spark = source.sparkSession
    check_merge_source(source, keys)
    finish(spark, path)
    folder = Folder(spark, path)
    files = folder.data_files()
    work = f"{_WORK}/{uuid.uuid4().hex}"
    if not files:
        merged, touched, parts = source, [], list(partition_by)
    else:
        parts = partition_columns(files)
        if partition_by and list(partition_by) != parts:
            raise ConfigError(f"{path} is partitioned by {parts}, not by {list(partition_by)}")
        target = spark.read.schema(schema).parquet(folder.root) if schema else spark.read.parquet(folder.root)
        schema = target.schema
        on = [F.col(f"t.{name(k)}") == F.col(f"s.{name(k)}") for k in keys]
        held = target.filter(_between(source, keys, target)).select(*[F.col(name(k)) for k in keys], F.col("_metadata.file_path").alias("__file"))
        found = held.alias("t").join(source.select(*[name(k) for k in keys]).alias("s"), on, "left_semi").select("__file").distinct()
        touched = sorted(folder.relative(r[0]) for r in found.collect())  # names of files, of which the driver has all
        merged = upsert_merge(read_files(spark, folder, touched, schema), source, keys, delete_unmatched)
    absent = [c for c in parts if c not in merged.columns]
    if absent:
        raise ConfigError(f"partition columns {absent} not found in columns {merged.columns}")
    # files of a fair size, however many tasks the merge took
    merged.hint("rebalance", *parts).write.partitionBy(*parts).parquet(f"{folder.root}/{work}/data")
    new = Folder(spark, f"{folder.root}/{work}/data").data_files()
    others = sorted(set(files) - set(touched))
    removed = others if delete_unmatched else []
    journal = {"gone": touched + removed, "new": new}
    folder.write_text(f"{work}/{_JOURNAL}", json.dumps(journal))
    _exchange(folder, work, journal)
    folder.delete(_WORK)
    spark.catalog.refreshByPath(folder.root)
    return Merged(tuple(sorted(set(others) - set(removed))), tuple(touched), tuple(removed), tuple(new))


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r.col_name in ("Location", "Provider", "Type")}


def merge_into_table(spark: SparkSession, table: str, source: DataFrame, keys, delete_unmatched: bool = False) -> Merged:
    """The same for a parquet table of the catalog, partitioned or not."""
    qualified = ".".join(safe_name(part, "table name") for part in table.split("."))
    facts = _described(spark, qualified)
    if facts.get("Provider", "").lower() != "parquet" or "Location" not in facts:
        raise ConfigError(f"{table} is no parquet table: {facts}")
    parts = [c.name for c in spark.catalog.listColumns(qualified) if c.isPartition]
    done = merge_touched(facts["Location"], source, keys, delete_unmatched, parts, spark.table(qualified).schema)
    if parts:
        spark.sql(f"MSCK REPAIR TABLE {qualified} SYNC PARTITIONS")
    spark.catalog.refreshTable(qualified)
    return done
