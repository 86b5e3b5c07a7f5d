"""Small frames from driver values."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _literal(value, dtype: T.DataType) -> Column:
    if isinstance(value, datetime) and isinstance(dtype, T.TimestampNTZType):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast(dtype)


def literal_frame(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A frame of a few driver rows as literals in the plan: one task, no Python serialization."""
    one = spark.range(0, 1, 1, 1)
    structs = [
        F.struct(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(row, schema.fields, strict=True)]) for row in rows
    ]
    if not structs:
        return one.select(*[_literal(None, f.dataType).alias(f.name) for f in schema.fields]).filter(F.lit(False))
    return one.select(F.inline(F.array(*structs)))
