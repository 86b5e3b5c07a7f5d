"""Best-fit packing of documents into bins of a fixed number of words, with conflicts.

Pieces go largest first into the fullest bin that has room and does not conflict: no two pieces of one source and none
of one duplicate cluster share a bin. Bins are ordered by what they have left and carry a bitmap of their sources and
one of their clusters; the search starts at the smallest room that fits and goes on to the next larger until a
compatible bin is found, else a new one is opened.

The pieces are dealt over shards of about ``SHARD_PIECES`` by a hash of their row's number, so a source, cluster or id of
any size, and the pieces of a very long document, are spread over all of them; shards are packed each for itself. Then the
pieces of all bins that are less than ``FULL`` full are dealt anew over fewer shards and packed again, until they are one
shard or a round fills hardly any bin. So a table of any size ends with one shard of what is left, as a small one begins.
A document of more words than a bin is cut into full bins and a rest. Only ids, lengths and the two hashes are moved.

Defined results: a null or empty text has no words and no piece, a null source or cluster conflicts with nothing,
documents that share an id (or have none) are pieces of the same name, pieces of one length go by id (a null one last) and
number, of equal rooms the bin that got its last piece first is taken, and an empty table gives no bins.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.sources.tables import snapshot

CAPACITY = 2048
SHARD_PIECES = 5_000
#: Share of its capacity from which a bin is left as it is, and share of the loose pieces that a round must settle.
FULL, SETTLED = 0.95, 0.1
_PIECES = "shard long, bin long, position long, doc_id long, piece long, first_word long, n_words long, source string, cluster long"


class Bins:
    """Open bins by the room they have left."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms: list[int] = []  # rooms for which there is a bin, ascending
        self.at: dict[int, list[int]] = {}
        self.common: dict[int, int] = {}  # sources that every bin with this room holds, or fewer
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def place(self, size: int, source: int, cluster: int) -> int:
        """The bin for a piece; source and cluster are bits, or 0."""
        for k in range(bisect_left(self.rooms, size), len(self.rooms)):
            room = self.rooms[k]
            if source & self.common[room]:
                continue
            for i, b in enumerate(self.at[room]):
                if not (source & self.sources[b] or cluster & self.clusters[b]):
                    self._leave(k, i)
                    return self._put(b, room - size, source, cluster)
        self.sources.append(0)
        self.clusters.append(0)
        return self._put(len(self.sources) - 1, self.capacity - size, source, cluster)

    def _leave(self, k: int, i: int) -> None:
        room = self.rooms[k]
        self.at[room].pop(i)
        if not self.at[room]:
            del self.at[room], self.common[room], self.rooms[k]

    def _put(self, b: int, room: int, source: int, cluster: int) -> int:
        self.sources[b] |= source
        self.clusters[b] |= cluster
        if room:
            if room not in self.at:
                insort(self.rooms, room)
                self.at[room], self.common[room] = [], self.sources[b]
            self.at[room].append(b)
            self.common[room] &= self.sources[b]
        return b


def _bits(values: list) -> list[int]:
    """A bit for each value that occurs more than once; 0 for null and for what cannot conflict."""
    seen: dict = {}
    for v in values:
        seen[v] = seen.get(v, 0) + 1
    number = {v: 1 << i for i, v in enumerate(v for v, n in seen.items() if v is not None and n > 1)}
    return [number.get(v, 0) for v in values]


def _pack(capacity: int):
    def pack(key, table):
        rows = sorted(table.to_pylist(), key=lambda r: (-r["n_words"], r["doc_id"] is None, r["doc_id"] or 0, r["piece"]))
        bins, filled = Bins(capacity), []
        for r, source, cluster in zip(rows, _bits([r["source"] for r in rows]), _bits([r["cluster"] for r in rows])):
            b = bins.place(r["n_words"], source, cluster)
            if b == len(filled):
                filled.append(0)
            r["bin"], r["position"] = b, filled[b]
            filled[b] += 1
        names = [c.split()[0] for c in _PIECES.split(", ")]
        types = [pa.string() if n == "source" else pa.int64() for n in names]
        return pa.table([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names=names)

    return pack


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space: one for each character of a word that begins a run."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def pack(docs: DataFrame, n_words: Column, id_col: str = "doc_id", source: Column | None = None, cluster: Column | None = None,
         capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: shard, bin (unique in its shard), position in it, doc_id, piece, first_word, n_words, source
    and cluster."""
    none = F.lit(None)
    sized = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), n_words.alias("words"),
        (source if source is not None else none).cast("string").alias("source"),
        (cluster if cluster is not None else none).cast("long").alias("cluster"),
    ).filter("words > 0")
    sized = snapshot(sized, "sizes")  # fixed rows, so that their numbers are the same in every attempt
    n = sized.agg(F.expr(f"sum(ceil(words / {capacity}))")).first()[0] or 0
    starts = F.sequence(F.lit(0).cast("long"), F.col("words") - 1, F.lit(capacity).cast("long"))
    numbered = sized.withColumn("row", F.monotonically_increasing_id())
    pieces = numbered.select("*", F.posexplode(starts).alias("piece", "first_word")).select(
        F.xxhash64("row", "piece").alias("hash"), "doc_id", F.col("piece").cast("long").alias("piece"), "first_word",
        F.least(F.lit(capacity), F.col("words") - F.col("first_word")).cast("long").alias("n_words"), "source", "cluster",
    )
    shards, first, kept = max(1, -(-n // shard_pieces)), 0, []
    while True:
        dealt = pieces.withColumn("shard", F.pmod("hash", F.lit(shards)) + first).drop("hash")
        packed = dealt.groupBy("shard").applyInArrow(_pack(capacity), _PIECES)
        if shards == 1:
            return _all([*kept, packed])
        packed = snapshot(packed, "packed")
        fill = packed.groupBy("shard", "bin").agg(F.sum("n_words").alias("fill")).filter(F.col("fill") < FULL * capacity).select("shard", "bin")
        loose = snapshot(packed.join(fill, ["shard", "bin"], "left_semi"), "loose")
        left = loose.count()
        if left > (1 - SETTLED) * n:
            return _all([*kept, packed])
        kept.append(packed.join(fill, ["shard", "bin"], "left_anti").select(*packed.columns))
        if not left:
            return _all(kept)
        pieces = loose.withColumn("hash", F.xxhash64("shard", "bin", "position")).drop("shard", "bin", "position")
        n, first, shards = left, first + shards, -(-left // shard_pieces)


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def packed_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Documents packed by words, with their source and the cluster of equal texts as conflicts."""
    return pack(docs, word_count(F.col("text")), source=F.col("source"), cluster=F.xxhash64("text"), capacity=capacity)


def op6_best_fit(spark, d: str) -> DataFrame:
    return packed_documents(spark.read.parquet(f"{d}/documents.parquet"))


QUERIES = {"op6_best_fit": op6_best_fit}
ORACLES: dict[str, str] = {}
