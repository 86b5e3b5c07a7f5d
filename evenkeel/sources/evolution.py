"""Stored tables whose schema grows: old files are read as they are, and nothing is rewritten.

The schema of a table, and where the values of later columns come from, are a small file in a hidden folder of the table,
one for each version. An evolution adds a version: columns that are new, and types that are wider. Rows are appended under
the newest version. A read takes the newest schema for all files - the parquet reader widens types, and columns that a
file lacks are null - and fills those columns row by row, from another column or with a default.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.errors import ConfigError, SchemaDrift
from evenkeel.functions.sqltext import name
from evenkeel.operators.evolve import add_and_backfill
from evenkeel.sources.files import Folder

_VERSIONS = "_schema"
_WIDER = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.DoubleType), T.ShortType: (T.IntegerType, T.LongType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType), T.FloatType: (T.DoubleType,), T.DateType: (T.TimestampNTZType,),
}


@dataclass(frozen=True)
class Fill:
    """Where the values of a later column come from: another column, or a constant as SQL."""

    column: str
    fill_from: str | None = None
    default: str = "NULL"


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether files of the old type can be read as the new one."""
    if old == new:
        return True
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return isinstance(new, _WIDER.get(type(old), ()))


def _newest(folder: Folder) -> tuple[int, T.StructType, list[Fill]]:
    versions = [int(n.removesuffix(".json")) for n in folder.names(_VERSIONS) if n.endswith(".json")]
    if not versions:
        raise ConfigError(f"{folder.root} has no stored schema; create it with store_schema")
    stored = json.loads(folder.read_text(f"{_VERSIONS}/{max(versions)}.json"))
    return max(versions), T.StructType.fromJson(stored["schema"]), [Fill(**f) for f in stored["fills"]]


def _write(folder: Folder, version: int, schema: T.StructType, fills: list[Fill]) -> None:
    if folder.exists(f"{_VERSIONS}/{version}.json"):
        raise ConfigError(f"version {version} of the schema of {folder.root} was written by someone else")
    folder.write_text(f"{_VERSIONS}/{version}.json", json.dumps({"schema": schema.jsonValue(), "fills": [vars(f) for f in fills]}))


def store_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Make a folder, empty or with files of this schema, a table that can evolve."""
    folder = Folder(spark, path)
    if folder.names(_VERSIONS):
        raise ConfigError(f"{folder.root} has a stored schema already")
    _write(folder, 1, schema, [])


def evolve_stored(spark: SparkSession, path: str, add=(), widen=None) -> None:
    """Add a version: ``add`` has (name, type, Fill) of new columns, ``widen`` maps columns to wider types. What is there
    already is left, so a second run changes nothing."""
    folder = Folder(spark, path)
    version, schema, fills = _newest(folder)
    fields, known = [], set(schema.names)
    for f in schema.fields:
        new = (widen or {}).get(f.name, f.dataType)
        if not widens(f.dataType, new) and not widens(new, f.dataType):
            raise ConfigError(f"column {f.name} cannot turn from {f.dataType.simpleString()} to {new.simpleString()}")
        fields.append(T.StructField(f.name, new if widens(f.dataType, new) else f.dataType))
    for column, dtype, fill in add:
        if column not in known:
            if fill.fill_from is not None and fill.fill_from not in known:
                raise ConfigError(f"column {fill.fill_from} to fill {column} from is not in {schema.names}")
            fields.append(T.StructField(column, dtype))
            fills = [*fills, fill]
            known.add(column)
    evolved = T.StructType(fields)
    if evolved != schema:
        _write(folder, version + 1, evolved, fills)


def append_stored(df: DataFrame, path: str) -> None:
    """Append rows under the newest schema; columns that the frame lacks are left to be filled, others are refused."""
    _, schema, _ = _newest(Folder(df.sparkSession, path))
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise SchemaDrift((), set(unknown))
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in df.columns]
    wrong = [f.name for f in schema.fields if f.name in df.columns and not widens(df.schema[f.name].dataType, f.dataType)]
    if wrong:
        raise ConfigError(f"columns {wrong} are wider than those of {path}; widen these first")
    own = [F.col(name(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields if f.name in df.columns]
    df.select(*own, *absent).select(*[name(c) for c in schema.names]).write.mode("append").parquet(path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """Old and new files as one table, with the backfill."""
    _, schema, fills = _newest(Folder(spark, path))
    df = spark.read.schema(schema).parquet(path)
    for fill in fills:
        dtype = schema[fill.column].dataType
        df = add_and_backfill(df, fill.column, F.expr(fill.default).cast(dtype), fill.fill_from)
        df = df.withColumn(fill.column, F.col(name(fill.column)).cast(dtype))
    return df
