"""One source against many copies of it: all of them meet in one shuffle.

Each side has a bit. Rows of one key and digest are one row of a key, a digest and the bits of the sides that have it; a
second, small grouping by key then tells all copies apart from the source by bits alone: what has the source's digest is a
match, what has the key under another digest has changed. The source is read and hashed once however many copies there
are. Keys that some side has twice, and keys with nulls, are counted by side in a pass of their own, which is left out
where there are none. Keyless diffs count each digest by side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.errors import ConfigError
from evenkeel.functions.canonical import quick_digest, quick_words, row_digest
from evenkeel.functions.sqltext import any_null, name, names
from evenkeel.functions.types import type_of
from evenkeel.operators import keyed, multiset
from evenkeel.operators.columns import align
from evenkeel.operators.keys import require_keys
from evenkeel.sources.tables import snapshot

#: Copies that fit into the bits of a long beside the source, and copies that a keyless diff counts at a time.
MOST_KEYED, MOST_KEYLESS = 62, 8


def alike(source: DataFrame, target: DataFrame, columns) -> bool:
    """Whether a copy meets the source under the types in which the source meets itself (times without a zone become times
    with one), so that one digest of a source row serves for it."""
    own, a, b = align(source, source, columns)[0], *align(source, target, columns)
    return all(type_of(own, c) == type_of(a, c) == type_of(b, c) for c in columns)


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def keyed_many(source: DataFrame, targets: dict[str, DataFrame], keys, columns, **form) -> dict[str, DataFrame]:
    """The findings of ``keyed.hash_pairs`` in condensed form for each target, kept in the shared folder."""
    if len(targets) > MOST_KEYED:
        raise ConfigError(f"at most {MOST_KEYED} copies are compared at a time")
    keys, values = list(keys), [c for c in columns if c not in set(keys)]
    for df in (source, *targets.values()):
        require_keys(df, keys)
    by = names(keys)

    def narrow(df: DataFrame, side: int) -> DataFrame:
        df = align(source, df, keys + values)[1]
        w = quick_words(df, values, **form)
        return df.selectExpr(*by, f"{w[0]} AS __w0", f"{w[1]} AS __w1", f"{1 << side}L AS __side")

    rows = _union(narrow(df, k) for k, df in enumerate((source, *targets.values())))
    sides = rows.groupBy(*by, "__w0", "__w1").agg(F.expr("bit_or(__side) AS __has"), F.expr("count(1) AS __n"))
    per_key = sides.groupBy(*by).agg(
        F.expr("bit_or(__has) AS __has"), F.expr("bit_or(if(__has & 1L = 1L, __has, 0L)) AS __same"), F.expr("sum(__n) AS __n"))
    every = (1 << len(targets) + 1) - 2  # the bits of the copies
    told = per_key.selectExpr(
        *by, f"{any_null(keys)} OR __n > bit_count(__has) AS __messy", "__has & 1L = 1L AS __source", "__has", "__same"
    ).selectExpr(
        *by, "__messy", "__source", f"if(__source, ~__has, __has) & {every}L AS __lone",
        f"if(__source, __has & ~__same, 0L) & {every}L AS __changed", f"if(__source, __same, 0L) & {every}L AS __equal",
    )
    # keys that match everywhere are one row with their number
    kept = [F.when(F.expr("__messy OR __lone <> 0 OR __changed <> 0"), F.col(k)).alias(c) for k, c in zip(by, keys)]
    told = snapshot(told.groupBy("__messy", "__source", "__lone", "__changed", "__equal", *kept).agg(F.expr("count(1) AS __keys")), "many")
    counts = told.agg(*[F.expr(f"sum(if(NOT __messy AND __equal & {1 << k}L <> 0, __keys, 0))") for k in range(1, len(targets) + 1)]).first()
    counts = [n or 0 for n in counts]
    found = told.filter("NOT __messy").selectExpr("*", f"explode(sequence(1, {len(targets)})) AS __copy").selectExpr(
        *by, "__copy", "__source", "shiftright(__lone, __copy) & 1 = 1 AS __alone", "shiftright(__changed, __copy) & 1 = 1 AS __other",
    ).filter("__alone OR __other").selectExpr(
        *by, "__copy", "CAST(__source AS BIGINT) AS n_source", "CAST(NOT __source OR __other AS BIGINT) AS n_target",
        "CASE WHEN __other THEN 'hash_diff' WHEN __source THEN 'only_in_source' ELSE 'only_in_target' END AS diff_class",
    )
    messy = told.filter("__messy").select(*by)
    if not messy.isEmpty():
        same = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"m.{k}")) for k in by])
        held = rows.alias("r").join(messy.alias("m"), same, "left_semi").groupBy(*by, "__side").agg(
            F.expr("count(1) AS n"), F.expr("bit_xor(__w0) AS x0"), F.expr("bit_xor(__w1) AS x1"))
        copies = f"if(__side = 1, sequence(1, {len(targets)}), array(CAST(log2(__side) AS INT)))"
        met = held.selectExpr(*by, f"explode({copies}) AS __copy", "if(__side = 1, n, 0) AS s", "if(__side = 1, 0, n) AS t", "x0", "x1")
        met = met.groupBy(*by, "__copy").agg(
            F.expr("sum(s) AS n_source"), F.expr("sum(t) AS n_target"), F.expr("bit_xor(x0) AS __x0"), F.expr("bit_xor(x1) AS __x1"))
        met = snapshot(met.selectExpr(*by, "__copy", "n_source", "n_target", keyed._classify("__x0 <> 0 OR __x1 <> 0", "hash_diff", keys)), "many")
        for r in met.filter("diff_class = 'match'").groupBy("__copy").count().collect():  # one row per copy
            counts[r["__copy"] - 1] += r["count"]
        found = found.unionByName(met.filter("diff_class <> 'match'"))
    found = snapshot(found, "many-findings")
    nothing = [f"CAST(NULL AS {type_of(found, k).simpleString()}) AS {name(k)}" for k in keys]

    def one(k: int) -> DataFrame:
        n = counts[k - 1]
        match = source.sparkSession.range(1).selectExpr(*nothing, f"{n}L AS n_source", f"{n}L AS n_target", "'match' AS diff_class")
        return found.filter(F.col("__copy") == k).drop("__copy").unionByName(match)

    return {target: one(k) for k, target in enumerate(targets, 1)}


def keyless_many(source: DataFrame, targets: dict[str, DataFrame], columns, quick: bool = False, **form) -> dict[str, DataFrame]:
    """The diverging buckets of ``multiset.row_buckets`` in condensed form for each target, kept in the shared folder. With
    ``quick`` their digests are ``quick_digest`` and not SHA-256."""
    out, every = {}, list(targets)
    by, digest = (("__w0", "__w1"), quick_digest(("__w0", "__w1"))) if quick else (("__digest",), "__digest")

    def hashed(df: DataFrame) -> list[str]:
        found = quick_words(df, columns, **form) if quick else [f"unhex({row_digest(df, columns, **form)})"]
        return [f"{e} AS {c}" for e, c in zip(found, by)]

    for first in range(0, len(every), MOST_KEYLESS):
        some = every[first : first + MOST_KEYLESS]
        frames = [multiset.aligned(source, source, columns, form)[0], *[multiset.aligned(source, targets[t], columns, form)[1] for t in some]]
        rows = _union(df.selectExpr(*hashed(df), f"{k} AS __side") for k, df in enumerate(frames))
        sums = [F.expr(f"count_if(__side = {k}) AS n{k}") for k in range(len(frames))]
        counted = rows.groupBy(*by).agg(*sums)
        uneven = " OR ".join(f"n0 <> n{k}" for k in range(1, len(frames)))
        # even rows go on as one row of totals
        folded = counted.groupBy(F.when(F.expr(uneven), F.expr(digest)).alias("__digest")).agg(*[F.expr(f"sum(n{k}) AS n{k}") for k in range(len(frames))])
        folded = snapshot(folded, "many")
        for k, target in enumerate(some, 1):
            # what is uneven for another copy may be even for this one
            own = folded.selectExpr(f"if(n0 = n{k}, NULL, __digest) AS __digest", "n0 AS n_source", f"n{k} AS n_target")
            out[target] = own.filter("__digest IS NOT NULL").unionByName(
                own.filter("__digest IS NULL").agg(F.expr("coalesce(sum(n_source), 0) AS n_source"), F.expr("coalesce(sum(n_target), 0) AS n_target"))
                .selectExpr("CAST(NULL AS BINARY) AS __digest", "n_source", "n_target"))
    return out
