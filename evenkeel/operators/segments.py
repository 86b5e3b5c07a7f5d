"""Diff by segments: sums of row digests find where two tables can differ, and only rows there are moved.

The rows of both sides are summed up per segment: a range of the first key column if that is an integer, else a range of
a hash. A sum is the number of rows and four 32-bit parts of two 64-bit digests of the whole row, keys included. Sums
need no order and are combined in the map tasks, so what is shuffled for equal tables is one row per segment and task,
however many rows there are and however hot a key is. Segments whose sums agree hold the same rows on both sides; those
that disagree are opened into smaller ones, level by level, until they are small or too many, and only their rows go
through the row-by-row diff. For integer keys the opened ranges are pushed down to the scan.

Equal segments can still hold a key twice. For one integer key whose values are dense that is told by a bitmap per
32,768 values, built in the map tasks; for other keys the keys of one side are counted. ``unique`` leaves this out, for
keys that a constraint protects on either side.

What is kept on the driver are numbers of segments, at most ``MAX_SEGMENTS``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.canonical import comparable, digest_of
from evenkeel.functions.sqltext import any_null, name, names
from evenkeel.functions.types import INTEGRAL, type_of
from evenkeel.operators import keyed, multiset
from evenkeel.operators.columns import align
from evenkeel.operators.keys import require_keys
from evenkeel.sources.tables import snapshot

#: Segments of the first level (a power of two), and segments of any level at most.
FIRST_BITS, MAX_SEGMENTS = 12, 1 << 16
#: Rows up to which a segment is not opened further, on average.
LEAF_ROWS = 4096
#: Ranges that are pushed down to a scan; more of them are pushed down as the one range around all.
PUSHED_RANGES = 32
#: A bitmap is used if keys span at most so many values each.
SPARSEST = 64
_PARTS = 4
_SIGN = "shiftleft(1L, 63)"


@dataclass
class _Sides:
    """Both sides under one type each, and where a row lies: ``place`` is an unsigned number, by which segments are cut."""

    source: DataFrame
    target: DataFrame
    keys: list[str]
    columns: list[str]
    form: dict
    place: str
    bits: int = 64  # low bits that a place has
    key: str | None = None  # the integer column that ``place`` is made of, and the value that is place 0
    offset: int = 0

    def each(self):
        return ((self.source, "1", "0", ""), (self.target, "0", "1", "-"))

    def segment(self, shift: int) -> str:
        return f"shiftrightunsigned({self.place}, {shift})"


def _sums(sides: _Sides, shift: int, parents: DataFrame | None, parent_shift: int, pushed: str) -> DataFrame:
    """Per segment: rows of either side and source minus target of each part of the digests."""
    both = None
    for df, s, t, sign in sides.each():
        if parents is not None:
            df = _within(df.filter(pushed), parents, sides.segment(parent_shift))
        digests = [f"{digest_of(df, sides.keys, sides.columns, seed, sides.form)} AS __w{seed}" for seed in (0, 1)]
        df = df.selectExpr(f"{sides.segment(shift)} AS segment", *digests).selectExpr(
            "segment", f"{s} AS __s", f"{t} AS __t",
            *[f"{sign}{half} AS __d{k}" for k, half in enumerate(f"{part}" for w in ("__w0", "__w1") for part in (f"({w} & 4294967295L)", f"shiftrightunsigned({w}, 32)"))],
        )
        both = df if both is None else both.unionByName(df)
    parts = [F.expr(f"sum(__d{k}) AS d{k}") for k in range(_PARTS)]
    return both.groupBy("segment").agg(F.expr("sum(__s) AS n_source"), F.expr("sum(__t) AS n_target"), *parts)


_AGREES = " AND ".join(["n_source = n_target", *[f"d{k} = 0" for k in range(_PARTS)]])


def _within(df: DataFrame, segments: DataFrame, segment: str, how: str = "left_semi") -> DataFrame:
    """Rows inside (or, with an anti join, outside) of some segments; there are at most ``MAX_SEGMENTS``."""
    return df.join(F.broadcast(segments.select(F.col("segment").alias("__segment"))), F.expr(segment).eqNullSafe(F.col("__segment")), how)


def _ranges(sides: _Sides, segments: list[int], shift: int) -> str:
    """A filter on the key column that holds for all rows of the segments, for the scan."""
    if sides.key is None or None in segments or not segments:
        return "true"
    runs: list[list[int]] = []
    for n in sorted(x & (1 << 64) - 1 for x in segments):
        if runs and n == runs[-1][1] + 1:
            runs[-1][1] = n
        else:
            runs.append([n, n])
    if len(runs) > PUSHED_RANGES:
        runs = [[runs[0][0], runs[-1][1]]]
    ends = [(sides.offset + (a << shift), min(sides.offset + (b + 1 << shift), 1 << 63) - 1) for a, b in runs]
    return " OR ".join(f"({name(sides.key)} >= {_long(a)} AND {name(sides.key)} <= {_long(b)})" for a, b in ends)


def _long(n: int) -> str:
    return _SIGN if n == -(1 << 63) else f"({n}L)"


@dataclass
class Segments:
    """What the sums say: the segments that disagree (at ``shift``), the rows in all others, and how it came about."""

    sides: _Sides
    dirty: DataFrame
    shift: int
    clean_rows: int
    pushed: str
    #: (segments, segments that disagree, rows in those) of each level.
    levels: list[tuple[int, int, int]] = field(default_factory=list)

    def opened(self) -> tuple[DataFrame, DataFrame]:
        """The rows of both sides in segments that disagree."""
        segment = self.sides.segment(self.shift)
        return tuple(_within(df.filter(self.pushed), self.dirty, segment) for df in (self.sides.source, self.sides.target))


def compare_segments(sides: _Sides) -> Segments:
    """Open segments until those that disagree are small, or as many as are allowed."""
    shift = max(0, sides.bits - FIRST_BITS)
    sums, parent_shift, parents, pushed, clean, levels = None, 64, None, "true", 0, []
    while True:
        sums = snapshot(_sums(sides, shift, parents, parent_shift, pushed), "segments")
        told = sums.agg(*[F.expr(e) for e in (
            "count(1) AS n", f"count_if(NOT ({_AGREES})) AS dirty", f"coalesce(sum(if({_AGREES}, n_source, 0)), 0) AS clean",
            f"coalesce(sum(if({_AGREES}, 0, greatest(n_source, n_target))), 0) AS rows")]).first()
        levels.append((told.n, told.dirty, told.rows))
        clean += told.clean
        parents, parent_shift = sums.filter(f"NOT ({_AGREES})").select("segment"), shift
        room = (MAX_SEGMENTS // max(1, told.dirty)).bit_length() - 1
        last = told.dirty == 0 or told.rows <= LEAF_ROWS * told.dirty or shift == 0 or room < 2
        if told.dirty <= MAX_SEGMENTS and (not last or sides.key):
            pushed = _ranges(sides, [r.segment for r in parents.collect()], shift)  # MAX_SEGMENTS numbers at most
        if last:
            return Segments(sides, parents, shift, clean, pushed, levels)
        shift = max(0, shift - min(room, FIRST_BITS))


def _keyed_sides(source: DataFrame, target: DataFrame, keys, columns, form) -> _Sides:
    require_keys(source, keys)
    require_keys(target, keys)
    keys, values = list(keys), [c for c in columns if c not in set(keys)]
    s, t = align(source, target, keys + values)
    if not isinstance(type_of(s, keys[0]), INTEGRAL):
        return _Sides(s, t, keys, values, form, digest_of(s, keys, [], 2, form))
    key = f"CAST({name(keys[0])} AS BIGINT)"
    ends = s.selectExpr(f"{key} AS k").unionByName(t.selectExpr(f"{key} AS k")).agg(F.min("k"), F.max("k")).first()
    low, high = (v or 0 for v in ends)
    if high - low < 1 << 63:
        return _Sides(s, t, keys, values, form, f"({key} - {_long(low)})", max(1, (high - low).bit_length()), keys[0], low)
    return _Sides(s, t, keys, values, form, f"({key} ^ {_SIGN})", 64, keys[0], -(1 << 63))


def _repeated(found: Segments, keys) -> DataFrame:
    """Keys that the clean segments hold more than once or that have a null: (keys, n_source, n_target, diff_class).
    The sides are equal there, so one of them is counted."""
    sides = found.sides
    rows = _within(sides.source, found.dirty, sides.segment(found.shift), "left_anti").select(*names(keys))
    if sides.key is not None and len(keys) == 1:
        chunk = f"shiftrightunsigned({sides.place}, 15)"
        chunks = rows.filter(f"{name(keys[0])} IS NOT NULL").selectExpr(f"{chunk} AS segment", f"{sides.place} & 32767L AS bit").groupBy("segment")
        if (1 << sides.bits) <= SPARSEST * max(1, found.clean_rows):
            full = chunks.agg(F.expr("count(1) AS n"), F.expr("bitmap_count(bitmap_construct_agg(bit)) AS distinct_keys"))
            full = snapshot(full.filter("n > distinct_keys").select("segment"), "repeats")
            rows = rows.join(full.select(F.col("segment").alias("__segment")), F.expr(chunk).eqNullSafe(F.col("__segment")), "left_semi").unionByName(
                rows.filter(f"{name(keys[0])} IS NULL")
            )
    counted = rows.groupBy(*names(keys)).agg(F.expr("count(1) AS n_source")).filter(f"n_source > 1 OR {any_null(keys)}")
    return counted.selectExpr(*names(keys), "n_source", "n_source AS n_target", f"if({any_null(keys)}, 'null_key', 'duplicate_key') AS diff_class")


def keyed_segments(source: DataFrame, target: DataFrame, keys, columns, unique: bool = False, **form) -> DataFrame:
    """The findings of ``keyed.hash_pairs`` in condensed form (kept in the shared folder), by segments."""
    found = compare_segments(_keyed_sides(source, target, list(keys), columns, form))
    apart = keyed.condensed(keyed.hash_pairs(*found.opened(), keys, columns, **form), keys)
    if not unique:
        repeated = snapshot(_repeated(found, list(keys)), "repeated")
        apart = apart.unionByName(repeated)
        found.clean_rows -= repeated.agg(F.expr("coalesce(sum(n_source), 0)")).first()[0]
    nothing = [f"CAST(NULL AS {type_of(apart, k).simpleString()}) AS {name(k)}" for k in keys]
    clean = source.sparkSession.range(1).selectExpr(*nothing, f"{found.clean_rows}L AS n_source", f"{found.clean_rows}L AS n_target", "'match' AS diff_class")
    return snapshot(apart.unionByName(clean), "findings")


def keyless_segments(source: DataFrame, target: DataFrame, columns, **form) -> DataFrame:
    """The diverging buckets of ``multiset.row_buckets`` in condensed form (kept in the shared folder), by segments."""
    s, t = multiset.aligned(source, target, columns, form)
    columns = sorted(columns)
    found = compare_segments(_Sides(s, t, [], columns, form, digest_of(s, [], columns, 2, form)))
    apart = multiset.condensed(multiset.row_buckets(*found.opened(), columns, **form))
    clean = source.sparkSession.range(1).selectExpr("CAST(NULL AS BINARY) AS __digest", f"{found.clean_rows}L AS n_source", f"{found.clean_rows}L AS n_target")
    return snapshot(apart.unionByName(clean), "buckets")


def segment_sums(source: DataFrame, target: DataFrame, keys, columns, **form) -> DataFrame:
    """The first level as a report: segment (the first key of its range, for integer keys), n_source, n_target, agrees."""
    sides = _keyed_sides(source, target, list(keys), columns, form)
    shift = max(0, sides.bits - FIRST_BITS)
    first = f"shiftleft(segment, {shift})" + (f" + {_long(sides.offset)}" if sides.offset != -(1 << 63) else f" ^ {_SIGN}")
    return _sums(sides, shift, None, 64, "true").selectExpr(f"{first} AS segment", "n_source", "n_target", f"{_AGREES} AS agrees")
