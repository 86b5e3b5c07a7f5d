"""Links between texts whose sets of word shingles are alike, by an R-tree of count vectors.

A set's shingles are hashed into ``DIMENSIONS`` groups; the counts of the groups are a point. Two sets share at
most the sum of the smaller counts, coordinate by coordinate, and a box of points bounds that for all its points.
Pairs that pass the bound are verified on the sets themselves.

Boxes alone cannot keep unrelated texts apart in many dimensions, so the trees are built over what can link at
all. Two sets with a similarity of t or more differ in so few shingles that, dealt over one group more than that,
they agree in at least one group; which groups depends on a band of sizes, and a set takes part in its own band
and, near the edge, in the one below. Large sets are dealt over some groups more, so that linked ones agree in several:
then groups that got hardly any shingles, in which unrelated texts agree by chance and chain up, need not be met, unless
a set has so many of them that they could be all that it agrees in. Texts that agree in a group hang on the smallest id there, in the map task
first and then over all tasks, so no task meets a whole group however many rows share it. Below a similarity of
``GROUPED`` a group would hold so few shingles that every shared passage connects its texts. There the shingles of a
set are put in one order for all sets, the rarest first, and a set hangs on so many of its first ones that two linked
sets must share one; a passage of many texts comes last. How rare a shingle is, is read from a table of counts of fixed
size, in which shingles share cells: that can only change the order, not what is found. Texts that have one of these
shingles in common are held against each other on their counts, in as many groups as their size asks for, and only those
whose smaller counts add up to what a link needs go on together, so that texts which merely share a passage do not chain
up; where more than ``POSTINGS`` texts share one they all go on together. What is connected that way gets a tree: in one task up to ``BLOCK_SHINGLES``, else in blocks of sets of like size, whose pairs are looked at only where sizes allow
a link and they are not connected already. No pair is lost, and copies are compared once.

Defined results: a null or empty text has no shingles and links with nothing, texts of fewer words than a shingle are
one shingle, rows that share an id are one node, a null id links with nothing and has a null component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.components import components
from evenkeel.llm.words import SPACED, Words, chain, give_back, mix, pieces, run_starts, text_bytes
from evenkeel.sources.tables import snapshot

SHINGLE, PERCENT = 3, 90
DIMENSIONS, LEAF, FAN = 64, 32, 32
#: Ratio of the sizes at the ends of a band.
BAND = 0.75
#: Percent of groups that sets are dealt over beyond those that linked ones need; and shingles of a group that is met in need only.
SPARE, WEAK = 15, 2
#: Percent from which sets meet by groups, and below which by their rarest shingles; cells of the table of counts.
GROUPED, CELLS, SLICES = 90, 1 << 22, 64
#: Shingles whose trees are built in one task.
BLOCK_SHINGLES = 2_000_000
#: Blocks of sets of like size in a part, at most.
STEP_BLOCKS = 1 << 20
#: Keys that meet in one task, and keys that a map task combines before it sends them.
BUCKET_KEYS, COMBINED_KEYS = 100_000, 1_000_000
#: Texts under one shingle that are held against each other; and those of one map task that are sent on one by one.
POSTINGS, TASK_POSTINGS = 20_000, 64
#: Shingles in a group of the counts by which texts under one shingle are told apart, on average; groups at most.
GROUP_SHINGLES, MOST_GROUPS = 8, 4096
_ODD = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' different shingles, sorted within a text, and the bounds of the texts in them."""
    prints, n = words.fingerprints(), len(words.bounds) - 1
    inside = run_starts(words.bounds, length, len(prints))
    text = words.text_of()
    values, owner = chain(prints, length)[inside], text[: len(inside)][inside]
    counts = np.diff(words.bounds)
    short = np.flatnonzero((counts > 0) & (counts < length))
    if len(short):
        extra = [mix(np.array([chain(prints[words.bounds[i] : words.bounds[i + 1]], int(counts[i]))[0] + np.uint64(counts[i])]))[0] for i in short]
        values, owner = np.concatenate([values, np.array(extra, np.uint64)]), np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[fresh], owner[fresh]
    return values, np.searchsorted(owner, np.arange(n + 1))


class Bands:
    """Bands of set sizes, and in how many groups the sets of a band are dealt."""

    def __init__(self, percent: int):
        self.percent = percent

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.floor(np.log(np.maximum(n, 1)) / -np.log(BAND) + 1e-9).astype(np.int64)

    def groups(self, band: np.ndarray) -> np.ndarray:
        """One more than the shingles in which two linked sets can differ, if the smaller is in the band."""
        smaller = np.ceil(BAND ** -(band + 1.0) + 1e-6)  # no set of the band is larger
        larger = np.floor(smaller * 100 / self.percent)
        return np.floor((smaller + larger) * (100 - self.percent) / (100 + self.percent) + 1e-6).astype(np.int64) + 1

    def lower(self, n: np.ndarray) -> np.ndarray:
        """The band of the smallest set that can link with one of n."""
        return self.of(np.ceil(n * self.percent / 100 - 1e-9))


def group_keys(values: np.ndarray, bounds: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(key, text) for every text and each of its groups that must be met: the key stands for the band, the group and the
    shingles in it."""
    sizes = np.diff(bounds)
    keys, texts = [], []
    own, low = bands.of(sizes), bands.lower(sizes)
    for shift in range(int((own - low).max(initial=0)) + 1):
        chosen = np.flatnonzero((sizes > 0) & (own - shift >= low))
        if not len(chosen):
            continue
        band = own[chosen] - shift
        least = bands.groups(band)
        groups = least + least * SPARE // 100
        first = np.cumsum(groups) - groups
        lengths = sizes[chosen]
        before = np.cumsum(lengths) - lengths
        at = np.repeat(bounds[chosen] - before, lengths) + np.arange(int(lengths.sum()))
        spread = mix(values[at] * _ODD)
        cell = np.repeat(first, lengths) + ((spread >> np.uint64(32)) % np.repeat(groups, lengths).astype(np.uint64)).astype(np.int64)
        total = int(groups.sum())
        content = np.zeros(total, np.uint64)
        np.add.at(content, cell, mix(spread + np.uint64(1)))
        number = np.arange(total) - np.repeat(first, groups)
        seed = np.repeat(band, groups).astype(np.uint64) * np.uint64(1_000_003) + number.astype(np.uint64)
        # Linked sets agree in more than ``groups - least`` groups, so with no more weak ones than that, they do in another.
        weak = np.bincount(cell, minlength=total) <= WEAK
        met = ~weak | np.repeat(np.add.reduceat(weak.astype(np.int64), first) > groups - least, groups)
        keys.append(mix(content ^ mix(seed + np.uint64(7)))[met])
        texts.append(np.repeat(chosen, groups)[met])
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(keys), np.concatenate(texts)


def rarest_keys(values: np.ndarray, bounds: np.ndarray, percent: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, text) for the rarest shingles of every text: all but those that a linked set must share, and one more."""
    sizes = np.diff(bounds)
    texts = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((values, counts[_cells(values)], texts))
    place = np.arange(len(values)) - np.repeat(bounds[:-1], sizes)
    first = place < np.repeat(sizes - -(-sizes * percent // 100) + 1, sizes)
    return values[order][first], texts[first]


def _cells(values: np.ndarray) -> np.ndarray:
    return (values % np.uint64(CELLS)).astype(np.int64)


def _hubs(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, the smallest id of each, and the different pairs (id, smallest id of one of its keys)."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    hub = ids[fresh][np.cumsum(fresh) - 1]
    other = hub != ids
    pairs = np.unique(np.stack([ids[other], hub[other]], 1), axis=0) if other.any() else np.empty((0, 2), np.int64)
    return keys[fresh], ids[fresh], pairs


def _planes(ids: np.ndarray) -> bytes:
    """Numbers byte by byte of the same rank, so that what they have in common takes no room when compressed."""
    return ids.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(np.int64).ravel()


def _pieces_of(batch: pa.RecordBatch, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, shingles and bounds of the texts (column 1) of a batch."""
    data, offsets = text_bytes(batch.column(1))
    for a, b in pieces(offsets):
        yield a, b, *shingle_sets(Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SPACED, fold=True), length)
    give_back()


def _signatures(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, the size of its set and 128 bits that stand for it."""

    def read(batches):
        for batch in batches:
            for a, b, values, bounds in _pieces_of(batch, length):
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values ^ s), dtype=np.uint64)]) for s in (np.uint64(3), _ODD)]
                low, high = ((s[bounds[1:]] - s[bounds[:-1]]).view(np.int64) for s in sums)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(np.diff(bounds)), pa.array(low), pa.array(high)], ["doc_id", "n", "low", "high"])

    return docs.mapInArrow(read, "doc_id long, n long, low long, high long")


def _shingle_counts(docs: DataFrame, length: int) -> np.ndarray:
    """For each cell the texts that hold its shingles, up to 65,535; summed in the map task first."""

    def read(batches):
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for _, _, values, _ in _pieces_of(batch, length):
                total += np.bincount(_cells(values), minlength=CELLS)
        parts = np.minimum(total, 65_535).astype(np.uint16).reshape(SLICES, -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SLICES)), pa.array([x.tobytes() for x in parts], pa.binary())], ["slice", "counts"])

    def add(key, table):
        total = np.zeros(CELLS // SLICES, np.int64)
        for x in table["counts"].to_pylist():
            total += np.frombuffer(x, np.uint16)
        return pa.table({"slice": pa.array([key[0].as_py()]), "counts": pa.array([np.minimum(total, 65_535).astype(np.uint16).tobytes()], pa.binary())})

    kind = "slice long, counts binary"
    counts = np.zeros((SLICES, CELLS // SLICES), np.uint16)
    for r in docs.mapInArrow(read, kind).groupBy("slice").applyInArrow(add, kind).collect():
        counts[r["slice"]] = np.frombuffer(r["counts"], np.uint16)
    return counts.ravel()


def _keys(docs: DataFrame, length: int, percent: int, buckets: int) -> DataFrame:
    """Group keys and their smallest ids by bucket (0 and up), and the pairs that the task has found itself (-1)."""
    bands = Bands(percent)

    def rows(bucket, ids, keys) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(ids, pa.binary()), pa.array(keys, pa.binary())], ["bucket", "ids", "keys"])

    def flush(held) -> Iterator[pa.RecordBatch]:
        keys, ids, pairs = _hubs(np.concatenate([k for k, _ in held]), np.concatenate([i for _, i in held]))
        if len(pairs):
            yield rows([-1], [_planes(pairs[:, 0])], [_planes(pairs[:, 1])])
        cuts = np.searchsorted(keys, (np.arange(1, buckets, dtype=np.float64) * (2.0**64 / buckets)).astype(np.uint64))
        cuts = [0, *cuts.tolist(), len(keys)]
        full = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
        yield rows(full, [_planes(ids[cuts[b] : cuts[b + 1]]) for b in full], [keys[cuts[b] : cuts[b + 1]].tobytes() for b in full])

    def read(batches):
        held, n_held = [], 0
        for batch in batches:
            known, numbers = np.asarray(batch.column(0).is_valid()), np.asarray(batch.column(0).fill_null(0))
            for a, b, values, bounds in _pieces_of(batch, length):
                keys, texts = group_keys(values, bounds, bands)
                use = known[a:b][texts]
                held.append((keys[use], numbers[a:b][texts[use]]))
                n_held += len(held[-1][0])
                if n_held >= COMBINED_KEYS:
                    yield from flush(held)
                    held, n_held = [], 0
        if n_held:
            yield from flush(held)

    return docs.mapInArrow(read, "bucket long, ids binary, keys binary")


def _bucket_pairs(key, table):
    """Pairs (u, v) of ids that share a key over the map tasks; those of a task as they are."""
    ids = np.concatenate([_from_planes(x) for x in table["ids"].to_pylist()])
    if key[0].as_py() < 0:
        return pa.table({"u": ids, "v": np.concatenate([_from_planes(x) for x in table["keys"].to_pylist()])})
    keys = np.concatenate([np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()])
    pairs = _hubs(keys, ids)[2]
    return pa.table({"u": pairs[:, 0], "v": pairs[:, 1]})


def _profile(values: np.ndarray) -> np.ndarray:
    """Counts of a set's shingles in groups, a power of two of them; half as many groups are the sums of both halves."""
    groups = DIMENSIONS
    while groups < MOST_GROUPS and len(values) > groups * GROUP_SHINGLES:
        groups *= 2
    return np.bincount((mix(values) % np.uint64(groups)).astype(np.int64), minlength=groups).astype(np.uint32)


def _profiles(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, n and the counts of each set."""

    def read(batches):
        for batch in batches:
            for a, b, values, bounds in _pieces_of(batch, length):
                counts = [_profile(values[bounds[i] : bounds[i + 1]]) for i in range(b - a)]
                packed = [(c.astype(np.uint8) if c.max() < 256 else c).tobytes() for c in counts]
                wide = [bool(c.max() >= 256) for c in counts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array(np.diff(bounds)), pa.array(packed, pa.binary()), pa.array(wide)], ["doc_id", "n", "counts", "wide"]
                )

    return docs.mapInArrow(read, "doc_id long, n long, counts binary, wide boolean")


def _postings(docs: DataFrame, length: int, percent: int, buckets: int) -> DataFrame:
    """Texts by their rarest shingles, by bucket (0 and up): ids and keys as arrays; and hub pairs (-1) of texts of which
    a task found very many under one shingle."""
    counts = docs.sparkSession.sparkContext.broadcast(_shingle_counts(docs, length))

    def rows(bucket, ids, keys) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(ids, pa.binary()), pa.array(keys, pa.binary())], ["bucket", "ids", "keys"])

    def flush(held) -> Iterator[pa.RecordBatch]:
        keys, ids = np.concatenate([k for k, _ in held]), np.concatenate([i for _, i in held])
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        many = np.repeat(np.diff(np.append(first, len(keys))) > TASK_POSTINGS, np.diff(np.append(first, len(keys))))
        if many.any():
            hub_keys, hubs, pairs = _hubs(keys[many], ids[many])
            if len(pairs):
                yield rows([-1], [_planes(pairs[:, 0])], [_planes(pairs[:, 1])])
            keys, ids = np.concatenate([keys[~many], hub_keys]), np.concatenate([ids[~many], hubs])
            order = np.lexsort((ids, keys))
            keys, ids = keys[order], ids[order]
        cuts = np.searchsorted(keys, (np.arange(1, buckets, dtype=np.float64) * (2.0**64 / buckets)).astype(np.uint64))
        cuts = [0, *cuts.tolist(), len(keys)]
        full = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
        yield rows(full, [_planes(ids[cuts[b] : cuts[b + 1]]) for b in full], [keys[cuts[b] : cuts[b + 1]].tobytes() for b in full])

    def read(batches):
        held, n_held = [], 0
        for batch in batches:
            known, numbers = np.asarray(batch.column(0).is_valid()), np.asarray(batch.column(0).fill_null(0))
            for a, b, values, bounds in _pieces_of(batch, length):
                keys, texts = rarest_keys(values, bounds, percent, counts.value)
                use = known[a:b][texts]
                held.append((keys[use], numbers[a:b][texts[use]]))
                n_held += len(held[-1][0])
                if n_held >= COMBINED_KEYS:
                    yield from flush(held)
                    held, n_held = [], 0
        if n_held:
            yield from flush(held)

    return docs.mapInArrow(read, "bucket long, ids binary, keys binary")


def _shared(key, table):
    """(key, doc_id) of the shingles that several texts have; hub pairs (null, u, v) where they are too many."""
    ids = np.concatenate([_from_planes(x) for x in table["ids"].to_pylist()])
    if key[0].as_py() < 0:
        hubs = np.concatenate([_from_planes(x) for x in table["keys"].to_pylist()])
        return pa.table({"key": pa.nulls(len(ids), pa.int64()), "doc_id": pa.array(ids), "hub": pa.array(hubs)})
    keys = np.concatenate([np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()])
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
    keys, ids = keys[fresh], ids[fresh]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    size = np.repeat(np.diff(np.append(first, len(keys))), np.diff(np.append(first, len(keys))))
    some, many = (size > 1) & (size <= POSTINGS), size > POSTINGS
    pairs = _hubs(keys[many], ids[many])[2]
    return pa.table({
        "key": pa.concat_arrays([pa.array(keys[some].view(np.int64)), pa.nulls(len(pairs), pa.int64())]),
        "doc_id": np.concatenate([ids[some], pairs[:, 0]]),
        "hub": pa.concat_arrays([pa.nulls(int(some.sum()), pa.int64()), pa.array(pairs[:, 1])]),
    })


def _may_link(percent: int):
    """Pairs (u, v) that connect what can link among the texts under each shingle of a task."""

    def met(key, table):
        give_back()
        table = table.sort_by([("key", "ascending"), ("n", "ascending"), ("doc_id", "ascending")])
        keys, ids, sizes = (np.asarray(table[c].combine_chunks()) for c in ("key", "doc_id", "n"))
        _, first, label = np.unique(ids, return_index=True, return_inverse=True)
        packed, wide = table["counts"].combine_chunks(), table["wide"].combine_chunks()
        counts = [np.frombuffer(packed[int(i)].as_buffer(), np.uint32 if wide[int(i)].as_py() else np.uint8).astype(np.uint32) for i in first]
        forest = Forest(np.arange(len(first)))
        folded: dict[tuple[int, int], np.ndarray] = {}

        def profile(text: int, groups: int) -> np.ndarray:
            found = folded.get((text, groups))
            if found is None:
                found = folded[text, groups] = counts[text].reshape(-1, groups).sum(0)
            return found

        cuts = np.append(np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])), len(keys))
        for low, high in zip(cuts[:-1], cuts[1:]):
            own, n = label[low:high], sizes[low:high]
            last = np.searchsorted(n, np.floor(n * 100 / percent + 1e-9), "right")
            for i in range(len(own) - 1):
                others = np.arange(i + 1, last[i])
                others = others[forest.label[own[others]] != forest.label[own[i]]]
                groups = len(counts[own[i]])
                for k in range(0, len(others), 4096):
                    part = others[k : k + 4096]
                    bound = np.minimum(np.stack([profile(t, groups) for t in own[part].tolist()]), counts[own[i]]).sum(1)
                    for j in part[bound >= _needed(n[i], n[part], percent)].tolist():
                        if forest.label[own[i]] != forest.label[own[j]]:
                            forest.join(own[i], own[j])
        names = ids[first]
        u, v = zip(*forest.joins) if forest.joins else ((), ())
        return pa.table({"u": pa.array(names[list(u)], pa.int64()), "v": pa.array(names[list(v)], pa.int64())})

    return met


def _rare_pairs(docs: DataFrame, length: int, percent: int, buckets: int) -> DataFrame:
    """Pairs (u, v) that connect all texts that can link: they share a rare shingle and their counts allow it."""
    posted = _postings(docs, length, percent, buckets).withColumn("salt", F.when(F.col("bucket") < 0, F.xxhash64("ids")).otherwise(0))
    shared = snapshot(posted.groupBy("bucket", "salt").applyInArrow(_shared, "key long, doc_id long, hub long"), "postings")
    asked = shared.filter("key IS NOT NULL").select("doc_id").distinct()
    profiles = snapshot(_profiles(docs, length).join(asked, "doc_id", "left_semi").dropDuplicates(["doc_id", "n", "counts"]), "profiles")
    groups = max(1, shared.count() // POSTINGS)
    listed = shared.filter("key IS NOT NULL").select("key", "doc_id").join(profiles, "doc_id").withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups)))
    near = listed.groupBy("group").applyInArrow(_may_link(percent), "u long, v long")
    return near.union(shared.filter("key IS NULL").select(F.col("doc_id").alias("u"), F.col("hub").alias("v")))


class Forest:
    """Which of a task's rows are connected."""

    def __init__(self, labels: np.ndarray):
        _, first, self.label = np.unique(labels, return_index=True, return_inverse=True)
        self.joins: list[tuple[int, int]] = []

    def join(self, i: int, j: int) -> None:
        a, b = self.label[i], self.label[j]
        self.label[self.label == max(a, b)] = min(a, b)
        self.joins.append((i, j))


def _needed(m: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that sets of m and n must share to link."""
    return np.ceil((m + n) * percent / (100 + percent) - 1e-9)


class Points:
    """Sets as count vectors, packed into boxes of LEAF neighbours by size and counts."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.n = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), self.n)
        dimension = (mix(np.concatenate(sets)) % np.uint64(DIMENSIONS)).astype(np.int64)
        self.counts = np.bincount(owner * DIMENSIONS + dimension, minlength=len(sets) * DIMENSIONS).reshape(-1, DIMENSIONS).astype(np.int32)
        tile = np.argsort(np.argsort(self.n, kind="stable")) // (LEAF * FAN)
        self.order = np.lexsort((self.counts[:, 1], self.counts[:, 0], tile))
        cuts = np.arange(0, len(sets), LEAF)
        self.leaves = [self.order[c : c + LEAF] for c in cuts]
        ordered, sizes = self.counts[self.order], self.n[self.order]
        self.top = np.maximum.reduceat(ordered, cuts)
        self.least, self.most = np.minimum.reduceat(sizes, cuts), np.maximum.reduceat(sizes, cuts)
        high = np.arange(0, len(cuts), FAN)
        self.high_top = np.maximum.reduceat(self.top, high)
        self.high_least, self.high_most = np.minimum.reduceat(self.least, high), np.maximum.reduceat(self.most, high)


def _may(top_a, least_a, most_a, top_b, least_b, most_b, percent) -> np.ndarray:
    """For one box against several: whether they can hold a link."""
    bound = np.minimum(top_a, top_b).sum(1)
    sized = (100 * most_a >= percent * least_b) & (100 * most_b >= percent * least_a)
    return sized & (bound >= _needed(least_a, least_b, percent))


def _link_all(a: Points, b: Points, shift: int, forest: Forest, percent: int) -> None:
    """Connect the rows of two trees (or of one with itself) that link. Row j of b is row ``shift + j`` of the forest."""

    def verified(i: int, j: int) -> bool:
        x, y = a.sets[i], b.sets[j]
        if len(x) > len(y):
            x, y = y, x
        shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
        return 100 * shared >= percent * (len(x) + len(y) - shared)

    def survivors(rows: np.ndarray, columns: np.ndarray) -> None:
        apart = forest.label[rows][:, None] != forest.label[shift + columns][None, :]
        if not apart.any():
            return
        i, j = np.nonzero(apart)
        i, j = rows[i], columns[j]
        for k in range(0, len(i), 8192):
            p, q = i[k : k + 8192], j[k : k + 8192]
            good = np.minimum(a.counts[p], b.counts[q]).sum(1) >= _needed(a.n[p], b.n[q], percent)
            for x, y in zip(p[good].tolist(), q[good].tolist()):
                if forest.label[x] != forest.label[shift + y] and verified(x, y):
                    forest.join(x, shift + y)

    survivors(np.arange(1), np.arange(len(b.sets)))  # what hangs on the first row is settled at once
    same = a is b
    for g in range(len(a.high_top)):
        others = np.arange(g if same else 0, len(b.high_top))
        near = others[_may(a.high_top[g], a.high_least[g], a.high_most[g], b.high_top[others], b.high_least[others], b.high_most[others], percent)]
        for h in near:
            for p in range(g * FAN, min(len(a.leaves), (g + 1) * FAN)):
                leaf = np.arange(max(h * FAN, p) if same else h * FAN, min(len(b.leaves), (h + 1) * FAN))
                leaf = leaf[_may(a.top[p], a.least[p], a.most[p], b.top[leaf], b.least[leaf], b.most[leaf], percent)]
                for q in leaf:
                    survivors(a.leaves[p], b.leaves[q])


def _task(percent: int):
    """Links of one task: rows of the block, and rows of the probe where there are any."""

    def linked(key, table):
        give_back()
        table = table.sort_by("doc_id")
        sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        ids, labels = (np.asarray(table[c].combine_chunks()) for c in ("doc_id", "label"))
        probe = np.asarray(table["probe"].combine_chunks().cast(pa.int8())).astype(bool)
        order = np.concatenate([np.flatnonzero(~probe), np.flatnonzero(probe)])
        forest, n = Forest(labels[order]), int((~probe).sum())
        if n:
            block = Points([sets[i] for i in order[:n]])
            if n < len(order):
                _link_all(block, Points([sets[i] for i in order[n:]]), n, forest, percent)
            else:
                _link_all(block, block, 0, forest, percent)
        u, v = zip(*forest.joins) if forest.joins else ((), ())
        ids = ids[order]
        return pa.table({"u": pa.array(ids[list(u)], pa.int64()), "v": pa.array(ids[list(v)], pa.int64())})

    return linked


def _sets(docs: DataFrame, length: int) -> DataFrame:
    """Sets of the documents of (doc_id, text, part, block)."""

    def read(batches):
        for batch in batches:
            for a, b, values, bounds in _pieces_of(batch, length):
                packed = [values[bounds[i] : bounds[i + 1]].tobytes() for i in range(b - a)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(2)[a:b], batch.column(3)[a:b], batch.column(4)[a:b], pa.array(packed, pa.binary())],
                    ["doc_id", "part", "block", "blocks", "shingles"],
                )

    return docs.mapInArrow(read, "doc_id long, part long, block long, blocks long, shingles binary")


def _size_step(n, percent: int):
    """A number for sizes: those of linked sets have the same or adjacent ones."""
    return F.floor(F.log(n) / -float(np.log(min(percent, 99) / 100)) + 1e-9)


def _step_of(block):
    return F.floor(F.col(block) / STEP_BLOCKS)


def _far_links(sets: DataFrame, near: DataFrame, percent: int, block_shingles: int) -> DataFrame:
    """Links between the blocks of parts that are too large for a task.

    First the root of the largest tree in a part is held against every block; then all that is still apart from
    the part's largest component, in blocks of its own, against every block. Blocks hold sets of one size step, and only
    those of the same or adjacent steps meet. Nothing else can be a new link. What is broadcast is a row per block or part.
    """
    task, pair = _task(percent), "u long, v long"
    blocks = F.broadcast(snapshot(sets.select("part", "block").distinct(), "block-list"))

    def to_blocks(rows: DataFrame) -> DataFrame:
        """A row for each block that it can have links with."""
        rows = rows.withColumn("own", _step_of("block")).drop("block")
        return rows.join(blocks, "part").filter(F.abs(_step_of("block") - F.col("own")) <= 1).drop("own").withColumn("probe", F.lit(True))

    def labelled(links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The sets with their component so far, and the largest component of each part."""
        rows = sets.join(components(links), F.col("doc_id") == F.col("node"), "left")
        rows = snapshot(rows.withColumn("label", F.coalesce("label", "doc_id")).drop("node"), "blocks")
        counted = rows.groupBy("part", "label").agg(F.count(F.lit(1)).alias("n"))
        return rows, F.broadcast(snapshot(counted.groupBy("part").agg(F.max(F.struct("n", "label"))["label"].alias("main")), "main"))

    rows, main = labelled(near)
    hubs = to_blocks(rows.join(main, "part").filter("doc_id = main").drop("main"))
    first = rows.withColumn("probe", F.lit(False)).unionByName(hubs).groupBy("part", "block").applyInArrow(task, pair)
    first = snapshot(first, "hub-links")

    rows, main = labelled(near.union(first))
    apart = rows.join(main, "part").filter("label <> main").drop("main").withColumn("step", _step_of("block"))
    probes = snapshot(apart.groupBy("part", "step").agg(F.ceil(F.sum(F.length("shingles") / 8) / block_shingles).alias("probes")), "probes")
    each = probes.select("part", F.explode(F.expr(f"sequence(step * {STEP_BLOCKS}, step * {STEP_BLOCKS} + probes - 1)")).alias("other"))
    left = rows.join(F.broadcast(each), "part").filter(F.abs(_step_of("block") - _step_of("other")) <= 1).withColumn("probe", F.lit(False))
    right = apart.join(F.broadcast(probes), ["part", "step"])
    right = to_blocks(right.withColumn("other", F.col("step") * STEP_BLOCKS + F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("probes"))).drop("probes", "step"))
    second = left.unionByName(right).groupBy("part", "block", "other").applyInArrow(task, pair)
    return first.union(second)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = SHINGLE, percent: int = PERCENT,
                    block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest id that links reach)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(256, int(size / 6 * 4 * (100 - percent) / 200 / BUCKET_KEYS))
    own = snapshot(_signatures(docs, length), "signatures")
    # One set of each kind of equal sets goes on; hot kinds are counted in the map task.
    kinds = own.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "low", "high").agg(F.min("doc_id").alias("first"))
    kinds = snapshot(kinds, "kinds")  # a join of two plain exchanges, which adaptive execution can split
    own = snapshot(own.join(kinds, ["n", "low", "high"], "left").select("doc_id", "n", "first"), "set-kinds")

    if percent >= GROUPED:
        # Pairs of a task need no bucket; their rows are salted, as there are many with the number -1.
        keys = _keys(docs, length, percent, buckets).withColumn("salt", F.when(F.col("bucket") < 0, F.xxhash64("ids")).otherwise(0))
        pairs = keys.groupBy("bucket", "salt").applyInArrow(_bucket_pairs, "u long, v long")
    else:
        pairs = _rare_pairs(docs, length, percent, buckets)
    may = components(snapshot(pairs.distinct(), "may-link"))

    firsts = own.filter("doc_id = first").select("doc_id", "n").distinct()
    parts = may.join(firsts, F.col("node") == F.col("doc_id")).select("doc_id", "n", F.col("label").alias("part"))
    parts = snapshot(parts, "parts")
    weights = parts.groupBy("part").agg(F.count(F.lit(1)).alias("members"), F.ceil(F.sum("n") / block_shingles).alias("blocks")).filter("members > 1")
    chosen = snapshot(parts.join(weights, "part").withColumn("step", F.when(F.col("blocks") > 1, _size_step(F.col("n"), percent)).otherwise(F.lit(0).cast("long"))), "members")
    # A row for each step of the parts that are too large for a task.
    steps = chosen.filter("blocks > 1").groupBy("part", "step").agg(F.ceil(F.sum("n") / block_shingles).alias("own"))
    number = F.col("step") * STEP_BLOCKS + F.pmod(F.xxhash64("doc_id"), F.coalesce("own", F.lit(1).cast("long")))
    chosen = chosen.join(F.broadcast(steps), ["part", "step"], "left").select("doc_id", "part", number.alias("block"), "blocks")
    sets = snapshot(_sets(docs.join(chosen.hint("merge"), "doc_id").select("doc_id", "text", "part", "block", "blocks"), length).dropDuplicates(["doc_id", "shingles"]), "sets")
    task = _task(percent)
    tasked = sets.withColumn("label", F.col("doc_id")).withColumn("probe", F.lit(False))
    links = snapshot(tasked.groupBy("part", "block").applyInArrow(task, "u long, v long"), "links")
    split = sets.filter("blocks > 1")
    if not split.isEmpty():
        links = links.union(_far_links(split, links, percent, block_shingles))
    copies = own.filter("first <> doc_id").select(F.col("doc_id").alias("u"), F.col("first").alias("v"))
    found = components(links.union(copies))
    return own.join(found, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "doc_id").alias("component_id")
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents whose id is the smallest of their component, and those without an id, with all their columns."""
    found = near_duplicates(docs, id_col, text_col, **options)
    gone = found.filter("component_id <> doc_id").select(F.col("doc_id").alias("gone")).distinct()
    whole = docs.select(F.struct("*").alias("whole"), F.col(id_col).cast("long").alias("id"))
    return whole.join(gone, F.col("id") == F.col("gone"), "left_anti").select("whole.*")


def op7_count_vector_tree(spark, d: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{d}/documents.parquet"))


QUERIES = {"op7_count_vector_tree": op7_count_vector_tree}
_SETS = r"""t AS (SELECT doc_id, COALESCE(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) AS i FROM t)),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id)"""
ORACLES = {
    "op7_count_vector_tree": f"""
WITH RECURSIVE {_SETS},
o AS (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM o JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 90 * (na.n + nb.n - k)),
r AS (SELECT doc_id, doc_id AS c FROM t UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT t.doc_id, COALESCE(n.n, 0) AS n_shingles, MIN(r.c) AS component_id FROM t LEFT JOIN n USING (doc_id) JOIN r ON r.doc_id = t.doc_id GROUP BY ALL"""
}
