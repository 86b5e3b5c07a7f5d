"""Merge-upsert: bring a target up to a source by key, as one DataFrame plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.errors import ConfigError
from evenkeel.operators.keys import duplicate_keys, require_keys


def check_merge_source(source: DataFrame, keys) -> None:
    """Reject a source in which one key stands for two rows: which of them wins would be chance."""
    require_keys(source, keys, "merge keys")
    if duplicate_keys(source, keys).limit(1).count():
        raise ConfigError(f"source has duplicate merge keys on {list(keys)}; a merge needs unique keys")


def upsert_merge(target: DataFrame, source: DataFrame, keys, delete_unmatched: bool = False) -> DataFrame:
    """Rows of the target after the merge.

    Matched rows take the values of the source, new rows are added, unmatched rows stay or go. Null
    keys match nothing. The source must have unique keys (``check_merge_source``); the target need
    not. A left join plus an anti join says the same as a full outer join, but lets adaptive
    execution split a hot key of the target over many tasks, which a full outer join does not.
    """
    require_keys(source, keys, "merge keys")
    require_keys(target, keys, "merge keys")
    absent = [c for c in source.columns if c not in target.columns]
    if absent:
        raise ConfigError(f"source columns {absent} not found in target columns {target.columns}")
    taken = set(source.columns)
    s = source.select(*[F.col(f"`{c}`").alias(f"s__{c}") for c in source.columns], F.lit(True).alias("s__here"))
    on = [F.col(f"`{k}`") == F.col(f"`s__{k}`") for k in keys]
    joined = target.join(s, on, "inner" if delete_unmatched else "left_outer")
    kept = joined.select(*[
        (F.when(F.col("s__here"), F.col(f"`s__{c}`")).otherwise(F.col(f"`{c}`")) if c in taken else F.col(f"`{c}`")).alias(c)
        for c in target.columns
    ])
    known = target.select(*[F.col(f"`{k}`") for k in keys]).distinct()
    added = s.join(known, on, "left_anti").select(*[
        (F.col(f"`s__{c}`") if c in taken else F.lit(None).cast(target.schema[c].dataType)).alias(c) for c in target.columns
    ])
    return kept.unionByName(added)


def empty_like(source: DataFrame) -> DataFrame:
    """A target with the columns of the source and no rows, for a merge into nothing."""
    return source.filter(F.lit(False))
