"""SimHash near-dedup by a self-join of binary tries.

A text's fingerprint is the majority of the hashes of its shingles, bit by bit. Equal fingerprints are one row, and
different ones link when they differ in at most ``budget`` bits.

The join walks a binary trie of the fingerprints against itself. Its state is a pair of nodes of one depth and the
number of bits in which the paths to them differ; a step replaces a pair by the pairs of their children, adds one where
these went apart, and drops a pair whose differences exceed the budget. The keys of a pair of leaves, of which each
holds a few, are compared one by one. A node is a range of the sorted fingerprints, so all pairs of a depth are handled as arrays; a list of pairs that
gets long is walked in parts, which bounds the memory.

Tries are dealt over tasks so that no link is lost. The 64 bits are cut into ``budget + 1`` blocks; two fingerprints
that link agree in one of them at least, so for each block there is a set of tries, one for each value of the block,
with the other bits below it. A trie with more than ``TRIE_LEAVES`` fingerprints is cut once more: into its nodes some
levels further down, of which each pair within the budget is a task of its own. A task returns no more links than
connect what it found to be connected, so a dense group gives as many rows as it has members, and not their squares.

Defined results: a text of fewer words than a shingle is one shingle, null and empty texts have fingerprint zero and
link like any other; repeated rows are rows of their own; a null id is never the smallest of its component unless there
is no other; an empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.components import components
from evenkeel.llm.slices import SPACED, folded, word_lists
from evenkeel.sources.tables import snapshot

# Words of a shingle, differing bits of a link, and the seed of the hash.
SHINGLE, BUDGET, SEED = 4, 4, 42
#: Fingerprints of a trie that one task walks; a larger one is cut further down.
TRIE_LEAVES = 1 << 17
#: Fingerprints that are put into tries at a time, and pairs of nodes that are walked at a time.
CHUNK, FRONTIER = 1 << 18, 1 << 20
#: Keys of a trie's leaf.
LEAF = 8
#: Levels at which a very large trie is cut, at most.
CUT_LEVELS = 14
_ONE = np.uint64(1)


def fingerprint(text: bytes, length: int = SHINGLE) -> int:
    """The fingerprint of a lower-cased text: a bit is set if it is in over half the hashes of its shingles."""
    ones, total, held = np.zeros(64, np.int64), 0, []

    def add(shingles) -> int:
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones[:] += bits.sum(axis=0, dtype=np.int64)
        return len(hashes)

    for words in word_lists(text, SPACED):
        held = held[1 - length :] + words if length > 1 else words
        total += add(map(b" ".join, zip(*[islice(held, k, None) for k in range(length)])))
    if not total and held:
        total = add([b" ".join(held)])
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big") if total else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id and fingerprint (64 bits as a signed number)."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, length) for t in folded(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fingerprint"])

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInArrow(read, "doc_id long, fingerprint long")


class Trie:
    """The binary trie of sorted distinct keys: a node of a depth is a range of keys that agree in so many first bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self._turns: dict[int, np.ndarray] = {}

    def turns(self, depth: int) -> np.ndarray:
        """For the first key of each node of a depth: where the node's keys go from bit 0 to bit 1."""
        if depth not in self._turns:
            shift = np.uint64(63 - depth)
            head = self.keys >> shift
            first = np.flatnonzero(np.diff(head)) + 1
            ends = np.append(first, len(head))[np.searchsorted(first, np.arange(len(head)), "right")]
            ones = (head & _ONE).astype(bool)
            self._turns[depth] = np.where(ones, np.arange(len(head)), ends).astype(np.int32)
        return self._turns[depth]


def _products(a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of keys of pairs of leaves, some leaves at a time."""
    for k in range(0, len(a), FRONTIER // LEAF**2):
        part = slice(k, k + FRONTIER // LEAF**2)
        wide, tall = a_end[part] - a[part], b_end[part] - b[part]
        size = wide * tall
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        tall = np.repeat(tall, size)
        yield np.repeat(a[part], size) + place // tall, np.repeat(b[part], size) + place % tall


def close_pairs(trie: Trie, pairs: tuple, depth: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Walk pairs of trie nodes down to the pairs of keys within the budget; gives arrays of places in the keys.

    ``pairs`` are five arrays: the ranges [low, high) of keys of either node and the bits in which their paths differ.
    A node paired with itself stands for the pairs within it. Nodes of up to ``LEAF`` keys are leaves.
    """
    keys, stack = trie.keys, [(depth, pairs)]
    while stack:
        depth, pairs = stack.pop()
        if len(pairs[0]) > FRONTIER:
            half = len(pairs[0]) // 2
            stack += [(depth, tuple(p[half:] for p in pairs)), (depth, tuple(p[:half] for p in pairs))]
            continue
        a, a_end, b, b_end, apart = pairs
        leaves = (a_end - a <= LEAF) & (b_end - b <= LEAF)
        for u, v in _products(a[leaves], a_end[leaves], b[leaves], b_end[leaves]):
            near = (u != v) & (np.bitwise_count(keys[u] ^ keys[v]) <= budget)
            if near.any():
                yield u[near], v[near]
        if leaves.all():
            continue
        a, a_end, b, b_end, apart = (p[~leaves] for p in pairs)
        turn = trie.turns(depth)
        own, a_mid, b_mid = a == b, turn[a], turn[b]
        zero, one = (a, a_mid, b, b_mid, apart), (a_mid, a_end, b_mid, b_end, apart)
        cross, back = (a, a_mid, b_mid, b_end, apart + 1), (a_mid, a_end, b, b_mid, apart + 1)
        kept = []
        for child in (zero, one, cross, back):
            alive = (child[1] > child[0]) & (child[3] > child[2]) & (child[4] <= budget)
            if child is back:  # a node against itself has met these children already
                alive &= ~own
            kept.append([p[alive] for p in child])
        stack.append((depth + 1, tuple(np.concatenate(p) for p in zip(*kept))))


def joined(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest members of the components after more links; ``label`` has those before."""
    while True:
        low, high = np.minimum(label[u], label[v]), np.maximum(label[u], label[v])
        apart = low != high
        if not apart.any():
            return label
        u, v = u[apart], v[apart]
        np.minimum.at(label, high[apart], low[apart])
        while (up := label[label]).tobytes() != label.tobytes():
            label = up


def _turned(prints: np.ndarray, by: int) -> np.ndarray:
    return (prints << np.uint64(by)) | (prints >> np.uint64(64 - by)) if by else prints


def _blocks(budget: int) -> list[tuple[int, int]]:
    """First bit and width of each block."""
    cuts = [round(64 * k / (budget + 1)) for k in range(budget + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _tries(budget: int):
    """Walk the tries of a task: rows (block, value, levels, node, other, fingerprint), a trie's rows one after another."""
    blocks = _blocks(budget)

    def links(block: int, prints: np.ndarray, levels: int, node: int, other: int) -> list[np.ndarray]:
        first, width = blocks[block]
        keys = np.unique(_turned(prints, first))
        if levels:  # one pair of nodes of a large trie
            depth, at = width + levels, (keys << np.uint64(width)) >> np.uint64(64 - levels)
            cut = int(np.searchsorted(at, other)) if node != other else len(keys)
            ends = [0, cut, cut, len(keys), (node ^ other).bit_count()] if node != other else [0, cut, 0, cut, 0]
            if ends[0] == ends[1] or ends[2] == ends[3]:
                return []
            pairs = tuple(np.array([e], np.int64) for e in ends)
        else:  # many whole tries side by side
            depth = width
            low = np.flatnonzero(np.concatenate([[True], np.diff(keys >> np.uint64(64 - width)) != 0]))
            high = np.append(low[1:], len(keys))
            pairs = (low, high, low, high, np.zeros(len(low), np.int64))
        label = np.arange(len(keys))
        for u, v in close_pairs(Trie(keys), pairs, depth, budget):
            label = joined(label, u, v)
        moved = np.flatnonzero(label != np.arange(len(keys)))
        back = _turned(keys, (64 - first) % 64)
        return [back[moved], back[label[moved]]] if len(moved) else []

    def walk(batches) -> Iterator[pa.RecordBatch]:
        held = None
        for rows in batches:
            part = [np.asarray(c) for c in rows.columns]
            held = part if held is None else [np.concatenate(p) for p in zip(held, part)]
            if len(held[0]) >= CHUNK:
                # the last trie may go on in the next batch
                same = np.logical_and.reduce([c == c[-1] for c in held[:5]])
                whole = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
                yield from answer([c[:whole] for c in held])
                held = [c[whole:] for c in held]
        if held is not None:
            yield from answer(held)

    def answer(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        block, _, levels, node, other, prints = rows
        prints = prints.view(np.uint64)
        for k in range(budget + 1):
            found = [links(k, prints[(block == k) & (levels == 0)], 0, 0, 0)] if ((block == k) & (levels == 0)).any() else []
            cut = np.flatnonzero((block == k) & (levels > 0))
            edges = np.flatnonzero(np.any([np.diff(c[cut]) != 0 for c in rows[1:5]], axis=0)) + 1 if len(cut) else []
            for own in np.split(cut, edges) if len(cut) else []:
                i = own[0]
                found.append(links(k, prints[own], int(levels[i]), int(node[i]), int(other[i])))
            for pair in found:
                if pair:
                    yield pa.RecordBatch.from_arrays([pa.array(p.view(np.int64)) for p in pair], ["u", "v"])

    return walk


def trie_links(prints: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Links (u, v) of distinct fingerprints that connect all that differ in at most ``budget`` bits."""
    blocks = F.explode(F.array(*[F.struct(F.lit(k).alias("block"), F.lit(a).alias("first"), F.lit(w).alias("width")) for k, (a, w) in enumerate(_blocks(budget))]))
    placed = prints.select("fingerprint", blocks.alias("b")).select("fingerprint", "b.*")
    placed = placed.selectExpr(
        "fingerprint", "block", "width",
        "if(first = 0, fingerprint, shiftleft(fingerprint, first) | shiftrightunsigned(fingerprint, 64 - first)) AS turned",
    ).selectExpr("*", "shiftrightunsigned(turned, 64 - width) AS value")
    # at most as many as there are fingerprints in all blocks over TRIE_LEAVES
    large = placed.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > TRIE_LEAVES)
    levels = F.least(F.lit(CUT_LEVELS), F.ceil(F.log2(F.col("n") / TRIE_LEAVES)).cast("int") + 1)
    placed = placed.join(large.select("block", "value", levels.alias("levels")), ["block", "value"], "left").selectExpr(
        "fingerprint", "block", "value", "width", "turned", "coalesce(levels, 0) AS levels"
    )
    node = "if(levels = 0, 0L, shiftrightunsigned(shiftleft(turned, width), 64 - levels))"
    within = f"filter(sequence(0L, shiftleft(1L, levels) - 1), m -> bit_count(m) <= {budget})"
    dealt = placed.selectExpr("*", f"{node} AS own").selectExpr("*", f"explode(if(levels = 0, array(0L), {within})) AS apart").selectExpr(
        "block", "value", "levels", "least(own, own ^ apart) AS node", "greatest(own, own ^ apart) AS other", "fingerprint"
    )
    by = ["block", "value", "levels", "node", "other"]
    return dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(_tries(budget), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits) and component_id, the smallest id that links reach."""
    rows = snapshot(fingerprints(docs, id_col, text_col, length), "fingerprints")
    prints = snapshot(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "prints")
    links = snapshot(trie_links(prints, budget), "links")
    labels = components(links).withColumnRenamed("node", "fingerprint")
    named = prints.join(labels, "fingerprint", "left").withColumn("label", F.coalesce("label", "fingerprint"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    answer = named.join(least, "label").select("fingerprint", "component_id")
    return rows.join(answer, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def op11_trie_join(spark, d: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{d}/documents.parquet"))


QUERIES = {"op11_trie_join": op11_trie_join}
#: XXH64 has no SQL form in DuckDB; tests hold the query against brute force.
ORACLES: dict[str, str] = {}
