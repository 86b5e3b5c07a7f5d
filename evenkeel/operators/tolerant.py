"""Keyless diff under a tolerance: rows of both sides are matched one to one, each pair within the tolerance in every column.

Rounding rows before they are compared calls 0.0004999 and 0.0005001 different at a tolerance of 0.001. Here the number of
rows without a partner is that of a largest matching:

1. Numbers of the leading tolerant column are dealt into cells of a grid far wider than the tolerance, and rows whose other
   columns agree are summed up by cell on both sides: their numbers, a sum of digests, and the ends of their numbers. A
   cell is settled if both sides have the same rows there, or as many, all of them so close that any two match, and none
   within reach of the next cell. One shuffle of fixed-size sums does this; equal tables end here.
2. Only rows of cells that are open, and of those beside them that a row is within reach of, are looked at again, by exact
   digest; further cells are added until no chain of close rows with a differing one leaves them.
3. These rows are cut into ranges by the other columns and the leading number, so that no task sorts them all, and fall
   into chains: runs of rows whose other columns agree and whose leading numbers lie close together.
4. Each chain is matched in order of its numbers, copies by their count and not one by one. With one tolerant column that
   is a stream which holds the rows within the tolerance of the current one; taking the earliest partner first is a largest
   matching there. In a chain in which several columns vary, augmenting paths find one.

Nulls, NaN and infinities match only themselves; columns without a tolerance must agree in their canonical text.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.canonical import comparable, quick_digest, quick_words, row_digest
from evenkeel.functions.sqltext import name
from evenkeel.functions.types import FLOATING, INTEGRAL, type_of
from evenkeel.operators import multiset
from evenkeel.operators.columns import align
from evenkeel.operators.sieve import sieved
from evenkeel.sources.tables import scratch_path, scratch_scope, snapshot

#: Width of a cell in tolerances.
CELL = 256
#: Bytes of a cell in a broadcast table.
_CELL_BYTES = 64


def aligned(source: DataFrame, target: DataFrame, columns) -> tuple[DataFrame, DataFrame]:
    """Both sides under one type for each column, in which numbers can be subtracted."""
    return align(source, target, sorted(columns), exact=False)


def tolerant_columns(df: DataFrame, columns, tolerance: float) -> list[str]:
    """The columns to which the tolerance applies, as in ``predicates.differs``."""
    kinds = FLOATING + (T.DecimalType,) + (INTEGRAL if tolerance >= 1 else ())
    return [c for c in sorted(columns) if tolerance > 0 and isinstance(type_of(df, c), kinds)]


def _finite(e: str, dtype: T.DataType) -> str:
    return f"({e} IS NOT NULL AND NOT isnan({e}) AND abs({e}) < double('Infinity'))" if isinstance(dtype, FLOATING) else f"({e} IS NOT NULL)"


def _place(lead: str, tolerance: float) -> str:
    """The cell of a number: a double, as a bigint would overflow. 0, which is common, is in the middle of one."""
    return f"rint({lead} / {CELL * tolerance!r}D)"


def _reaches(lead: str, cell: str, tolerance: float) -> tuple[str, str]:
    """Whether a chain may go on from a number into the cell below, and into that above; never less than in ``_chains``."""
    far = f"({2 * tolerance!r}D + abs({lead}) * 1e-15D)"
    return f"{_place(f'({lead} - {far})', tolerance)} < {cell}", f"{_place(f'({lead} + {far})', tolerance)} > {cell}"


@dataclass(frozen=True)
class _Form:
    """SQL of a row: what must agree, and the tolerant columns as numbers, 0 where there is none."""

    columns: list[str]
    loose: list[str]
    parts: list[str]
    numbers: list[str]
    texts: list[str]
    tolerance: float
    form: dict
    quick: bool = False

    def placed(self, df: DataFrame) -> DataFrame:
        """The rows with __other (a digest of what must agree), __lead (the leading number) and __cell."""
        df = df.selectExpr("*", f"xxhash64({', '.join(['0', *self.parts])}) AS __other", f"CAST({self.numbers[0]} AS DOUBLE) AS __lead")
        return df.selectExpr("*", f"{_place('__lead', self.tolerance)} AS __cell")

    def exact(self, df: DataFrame, s: int, t: int) -> DataFrame:
        """Placed rows with an exact digest and the tolerant columns as text, for one side."""
        form = {**self.form, "decimals": None, "round_decimals": False}
        digest = quick_digest(quick_words(df, self.columns, **form)) if self.quick else f"unhex({row_digest(df, self.columns, **form)})"
        return df.selectExpr(f"{digest} AS __digest", "__other AS other", "__lead AS lead", f"array({', '.join(self.texts)}) AS numbers", f"{s} AS __s", f"{t} AS __t")

    def within(self, hi: str, lo: str, dtype: T.DataType) -> str:
        """Whether two numbers match; wide decimals, whose difference may lose places, only if they are equal."""
        if isinstance(dtype, T.DecimalType):
            return f"{hi} - {lo} <= {Decimal(repr(self.tolerance)):f}BD" if dtype.precision <= 20 else f"{hi} = {lo}"
        return f"{hi} - {lo} <= {self.tolerance!r}D"


def _form_of(df: DataFrame, columns, loose, tolerance: float, form, quick: bool) -> _Form:
    parts, numbers, texts = [], [], []
    for c in columns:
        e, dtype = name(c), type_of(df, c)
        if c not in loose:
            parts += [f"{e} IS NULL", comparable(e, dtype, **form)]
            continue
        finite, floating = _finite(e, dtype), isinstance(dtype, FLOATING)
        parts += [finite, f"if({finite}, NULL, CAST({e} AS STRING))"]
        wide = f"CAST({e} AS DOUBLE)" if floating else e
        texts.append(f"if({finite}, CAST({wide} AS STRING), '0')")
        kind = "DOUBLE" if floating else dtype.simpleString() if isinstance(dtype, T.DecimalType) else "DECIMAL(20,0)"
        numbers.append(f"if({finite}, CAST({e} AS {kind}), CAST(0 AS {kind}))")
    return _Form(list(columns), list(loose), parts, numbers, texts, tolerance, dict(form), quick)


def _open_cells(source: DataFrame, target: DataFrame, how: _Form) -> DataFrame:
    """The open cells (__other, __cell, below and above: whether they reach the next ones) with their rows of either side,
    and rows without a cell that stand for all others."""

    def side(df: DataFrame, s: int, t: int) -> DataFrame:
        sign = "" if s else "-"
        df = how.placed(df).selectExpr(
            "__other", "__cell", *[f"{e} AS __v{k}" for k, e in enumerate(how.numbers)],
            f"xxhash64({', '.join(['1', *how.numbers])}) AS __w",  # rows of a cell agree in all else
        )
        return df.selectExpr(
            "__other", "__cell", *values, f"{s}L AS __s", f"{t}L AS __t",
            f"{sign}(__w & 4294967295L) AS __d0", f"{sign}shiftrightunsigned(__w, 32) AS __d1",
        )

    values = [f"__v{k}" for k in range(len(how.loose))]
    rows = side(source, 1, 0).unionByName(side(target, 0, 1))
    sums = rows.groupBy("__other", "__cell").agg(*[F.expr(e) for e in (
        "sum(__s) AS n_source", "sum(__t) AS n_target", "sum(__d0) AS d0", "sum(__d1) AS d1",
        *[f"{end}({v}) AS {end}{v}" for v in values for end in ("min", "max")])])
    below, above = (_reaches(f"CAST({end}__v0 AS DOUBLE)", "__cell", how.tolerance)[k] for k, end in enumerate(("min", "max")))
    close = " AND ".join(how.within(f"max{v}", f"min{v}", type_of(rows, v)) for v in values)
    told = sums.selectExpr("*", f"{below} AS below", f"{above} AS above").selectExpr(
        "*", f"n_source = n_target AND ((d0 = 0 AND d1 = 0) OR {close} AND NOT below AND NOT above) AS settled")
    kept = [F.expr(f"if(settled, NULL, {c}) AS {c}") for c in ("__other", "__cell", "below", "above")]
    return told.groupBy(*kept).agg(F.expr("sum(n_source) AS n_source"), F.expr("sum(n_target) AS n_target"))


def _counted(rows: DataFrame) -> DataFrame:
    kept = [F.expr(f"any_value({c}) AS {c}") for c in ("other", "lead", "numbers")]
    return rows.groupBy("__digest").agg(F.expr("sum(__s) AS n_source"), F.expr("sum(__t) AS n_target"), *kept)


def _inside(df: DataFrame, cells: DataFrame, n: int, few_rows: bool) -> DataFrame:
    """Placed rows of one side in ``n`` cells, which are broadcast while they are few; a filter of them ends most other rows
    before the shuffle beyond that, unless most rows are asked for."""
    if n * _CELL_BYTES <= multiset._BROADCAST_BYTES:
        cells = F.broadcast(cells)
    elif few_rows:
        df = sieved(df, "xxhash64(__other, __cell)", cells, "xxhash64(__other, __cell)", n)
    return df.join(cells, ["__other", "__cell"], "left_semi")


def _chains(rows: DataFrame, tolerance: float) -> DataFrame:
    """Number the chains of rows: a new one begins where ``other`` changes or the leading number jumps. Ranges of rows are
    numbered apart, and continue where the range before them ended; there are as many ranges as partitions."""
    ranged = snapshot(rows.repartitionByRange("other", "lead").withColumn("__range", F.spark_partition_id()), "ranges")
    ends = ranged.groupBy("__range").agg(F.expr("max(struct(other, lead)) AS end"))
    before = ends.selectExpr("__range", "lag(end) OVER (ORDER BY __range) AS before")
    jump = f"lead - prior.lead > {2 * tolerance!r}D + abs(lead) * 4.5e-16D"
    placed = ranged.join(F.broadcast(before), "__range").selectExpr(
        "*", "coalesce(lag(struct(other, lead)) OVER (PARTITION BY __range ORDER BY other, lead, __digest), before) AS prior"
    ).selectExpr("*", f"if(prior IS NULL OR prior.other <> other OR {jump}, 1, 0) AS begins")
    begun = placed.groupBy("__range").agg(F.expr("sum(begins) AS n")).selectExpr(
        "__range", "sum(n) OVER (ORDER BY __range) - n AS earlier"
    )
    inside = "sum(begins) OVER (PARTITION BY __range ORDER BY other, lead, __digest ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return placed.selectExpr("*", f"{inside} AS begun").join(F.broadcast(begun), "__range").selectExpr(*rows.columns, "earlier + begun AS chain")


def in_order(rows, tolerance) -> Iterator[tuple[object, int, int]]:
    """Match rows (number, n_source, n_target, id) in order of their numbers; yields (id, source, target) left over."""
    waiting: deque = deque()  # rows of one side within the tolerance that have no partner yet: [number, n, id]
    side = 0
    for number, n_source, n_target, mark in rows:
        while waiting and number - waiting[0][0] > tolerance:
            _, n, old = waiting.popleft()
            yield (old, n, 0) if side == 0 else (old, 0, n)
        counts = [n_source, n_target]
        while waiting and counts[1 - side]:
            n = min(waiting[0][1], counts[1 - side])
            counts[1 - side] -= n
            waiting[0][1] -= n
            if not waiting[0][1]:
                waiting.popleft()
        both = min(counts)
        counts = [c - both for c in counts]
        for k in (0, 1):
            if counts[k]:
                if not waiting:
                    side = k
                waiting.append([number, counts[k], mark])
    for _, n, old in waiting:
        yield (old, n, 0) if side == 0 else (old, 0, n)


def by_paths(rows: list, limits: list) -> Iterator[tuple[object, int, int]]:
    """The same for rows (numbers, n_source, n_target, id) in which several numbers vary, each with a limit of its own, by
    augmenting paths; the rows are in order of their first numbers."""
    left = [[n for _, n, _, _ in rows], [n for _, _, n, _ in rows]]
    near: list[list[int]] = []
    low = 0
    for i, (a, n, _, _) in enumerate(rows):
        while a[0] - rows[low][0][0] > limits[0]:
            low += 1
        own = []
        for j in range(low, len(rows)):
            b = rows[j][0]
            if b[0] - a[0] > limits[0]:
                break
            if n and rows[j][2] and all(abs(x - y) <= limit for x, y, limit in zip(a, b, limits)):
                own.append(j)
        near.append(own)
    paired: list[dict[int, int]] = [{} for _ in rows]  # by target: how many of which source it has
    for i in range(len(rows)):
        while left[0][i]:
            came, queue, end = {i: None}, deque([i]), None
            reached: dict[int, int] = {}
            while queue and end is None:
                s = queue.popleft()
                for t in near[s]:
                    if t in reached:
                        continue
                    reached[t] = s
                    if left[1][t]:
                        end = t
                        break
                    for other in paired[t]:
                        if other not in came:
                            came[other] = t
                            queue.append(other)
            if end is None:
                break
            path, t = [], end
            while True:
                s = reached[t]
                path.append((s, t))
                if came[s] is None:
                    break
                t = came[s]
            n = min([left[0][i], left[1][end], *[paired[came[s]][s] for s, _ in path if came[s] is not None]])
            for s, t in path:
                paired[t][s] = paired[t].get(s, 0) + n
                if came[s] is not None:
                    paired[came[s]][s] -= n
                    if not paired[came[s]][s]:
                        del paired[came[s]][s]
            left[0][i] -= n
            left[1][end] -= n
    for (_, _, _, mark), s, t in zip(rows, *left):
        if s or t:
            yield mark, s, t


def _matched(kinds: list[str], tolerance: float):
    """Match rows (chain, numbers, n_source, n_target, __digest), chains one after another and each in order of its first
    number. One number is matched as a stream; a chain in which several vary is held whole."""
    readers = [float if k == "float" else Decimal for k in kinds]
    limits = [tolerance if k == "float" else Decimal(repr(tolerance)) for k in kinds]

    def match(batches) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*[batch.column(k).to_pylist() for k in range(5)]))
        found = (left for _, chain in groupby(rows, key=lambda r: r[0]) for left in settled(chain))
        while some := list(islice(found, 10_000)):
            parts = [pa.array([r[k] for r in some], kind) for k, kind in enumerate((pa.binary(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(parts, ["__digest", "n_source", "n_target"])

    def settled(chain):
        read = ((tuple(f(x) for f, x in zip(readers, text)), s, t, mark) for _, text, s, t, mark in chain)
        if len(kinds) == 1:
            yield from in_order(((n[0], *more) for n, *more in read), limits[0])
            return
        held = list(read)
        varying = [k for k in range(len(kinds)) if len({r[0][k] for r in held}) > 1]
        if len(varying) > 1:
            yield from by_paths([(tuple(r[0][k] for k in varying), *r[1:]) for r in sorted(held, key=lambda r: r[0][varying[0]])], [limits[k] for k in varying])
        else:
            k = varying[0] if varying else 0
            yield from in_order(sorted(((r[0][k], *r[1:]) for r in held), key=lambda r: r[0]), limits[k])

    return match


def tolerant_buckets(source: DataFrame, target: DataFrame, columns, tolerance: float, quick: bool = False, **form) -> DataFrame:
    """Rows without a partner within the tolerance as buckets (__digest, n_source, n_target) of exact digests (``quick_digest``
    or else SHA-256), and one row without a digest that stands for all matched rows. Kept in the shared folder; what is
    written on the way is deleted. The sides must have the types of ``aligned``."""
    columns, spark = sorted(columns), source.sparkSession
    loose = tolerant_columns(source, columns, tolerance)
    if not loose:
        return snapshot(multiset.condensed(multiset.row_buckets(source, target, columns, **{**form, "decimals": None})), "buckets")
    path = scratch_path(spark, "buckets")
    with scratch_scope(spark):
        found = _unmatched(source, target, _form_of(source, columns, loose, tolerance, form, quick))
        found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def _unmatched(source: DataFrame, target: DataFrame, how: _Form) -> DataFrame:
    spark, counts = source.sparkSession, ("n_source", "n_target")
    opened = snapshot(_open_cells(source, target, how), "opened")
    every = opened.agg(*[F.expr(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}") for c in counts]).first()
    opened = opened.filter("__cell IS NOT NULL")

    def totals(lost) -> DataFrame:
        return spark.range(1).selectExpr("CAST(NULL AS BINARY) AS __digest", *[f"{n - k}L AS {c}" for n, k, c in zip(every, lost, counts)])

    if opened.isEmpty():
        return totals((0, 0))
    spread = "__other", "explode(array_distinct(array(__cell, if(below, __cell - 1, __cell), if(above, __cell + 1, __cell)))) AS __cell"
    cells = snapshot(opened.selectExpr(*spread).distinct(), "cells")
    while True:
        n = cells.count()
        sides = [how.exact(_inside(how.placed(df), cells, n, 4 * n <= sum(every)), s, t) for df, s, t in ((source, 1, 0), (target, 0, 1))]
        chained = snapshot(_chains(_counted(sides[0].unionByName(sides[1])), how.tolerance), "chains")
        uneven = chained.groupBy("chain").agg(F.expr("max(if(n_source <> n_target, 1, 0)) AS uneven")).filter("uneven = 1")
        live = chained.join(uneven.select("chain"), "chain", "left_semi")
        below, above = _reaches("lead", "__cell", how.tolerance)
        ends = live.selectExpr("other AS __other", "lead", f"{_place('lead', how.tolerance)} AS __cell").selectExpr("*", f"{below} AS below", f"{above} AS above")
        wider = ends.filter("below OR above").selectExpr(*spread).distinct()
        more = snapshot(wider.join(cells, ["__other", "__cell"], "left_anti"), "cells")
        if more.isEmpty():
            break
        cells = cells.unionByName(more)
    kinds = ["float" if isinstance(type_of(source, c), FLOATING) else "decimal" for c in how.loose]
    ordered = live.select("chain", "numbers", "n_source", "n_target", "__digest", "lead")
    if kinds[0] == "decimal":  # doubles may put close decimals out of order
        ordered = ordered.withColumn("lead", F.expr(f"CAST(numbers[0] AS {type_of(source, how.loose[0]).simpleString()})"))
    ordered = ordered.repartition("chain").sortWithinPartitions("chain", "lead").drop("lead")
    left = snapshot(ordered.mapInArrow(_matched(kinds, how.tolerance), "__digest binary, n_source long, n_target long"), "unmatched")
    lost = left.agg(*[F.expr(f"coalesce(sum({c}), 0)") for c in counts]).first()
    return left.groupBy("__digest").agg(*[F.sum(c).alias(c) for c in counts]).unionByName(totals(lost))
