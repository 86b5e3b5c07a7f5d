"""Substring dedup with prefix-partitioned suffix trees.

The suffixes of all texts (each word starts one) are dealt over groups by a prefix of 1, 2, 4, 8 or ``WINDOW`` words: the
shortest one whose group is small enough for a task, by counts over the whole corpus. A group is the subtree below its
prefixes. Its leaves are kept in the order of the fingerprints of their first ``WINDOW`` words, so the leaves below an
inner node that deep lie side by side; such a node is a repeat, and its smallest document decides. Repeats of
neighbouring suffixes are put together to maximal ones in the text itself.

Texts are packed once into chunks of some MB, bucketed by chunk. A chunk sends a leaf once, with the smallest of its
documents, so that a passage held by a third of all rows is one leaf per chunk; the groups answer with a bit per leaf,
whether a smaller document elsewhere has it, and the chunk marks its words. Leaves travel as 56 bits of fingerprint
(beside the group, some 70 bits) and the id in as many bytes as the range of ids needs; texts do not travel.

Defined results: a null or empty text has no words; rows that share an id are one document and never repeat each
other, a null id counts as larger than all others, and an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.words import SPACED, Words, chain, pieces, run_starts, text_bytes
from evenkeel.sources.tables import scratch_path, snapshot

WINDOW = 13
PREFIXES = (1, 2, 4, 8)
#: Suffixes in a group, about, and bytes of text in a chunk.
GROUP_SUFFIXES, CHUNK_BYTES = 1_000_000, 4 << 20
_CODEC = "zstd"


def _bin(prints: np.ndarray, bins: int) -> np.ndarray:
    return ((prints >> np.uint64(20)) % np.uint64(bins)).astype(np.int64)


class Chunk:
    """The suffixes of a chunk's texts that are at least a window long."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, codes: np.ndarray, window: int):
        self.data, self.offsets, self.codes, self.window = data, offsets, codes, window
        prints, starts, ends, bounds = [], [], [], [np.zeros(1, np.int64)]
        for a, b in pieces(offsets):
            words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SPACED)
            prints.append(words.fingerprints())
            starts.append(words.starts + offsets[a])
            ends.append(words.ends + offsets[a])
            bounds.append(words.bounds[1:] + bounds[-1][-1])
        self.starts, self.ends = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (starts, ends))
        self.bounds = np.concatenate(bounds)
        self.prints = np.concatenate(prints) if prints else np.empty(0, np.uint64)
        self.suffixes = np.flatnonzero(run_starts(self.bounds, window, len(self.prints)))

    def prefix_bins(self, length: int, bins: int) -> np.ndarray:
        return _bin(chain(self.prints, length)[self.suffixes], bins)

    def counts(self, bins: int) -> np.ndarray:
        return np.concatenate([np.bincount(self.prefix_bins(n, bins), minlength=bins) for n in PREFIXES])

    def leaves(self, heavy: np.ndarray, bins: int):
        """The different leaves by group and fingerprint: their groups, fingerprints and smallest ids; and for every
        suffix its leaf and whether it belongs to a larger id than the leaf's."""
        deep = chain(self.prints, self.window)[self.suffixes]
        code = np.repeat(self.codes, np.diff(self.bounds))[self.suffixes]
        order = np.argsort(deep, kind="stable")
        fresh = np.ones(len(deep), bool)
        fresh[1:] = deep[order][1:] != deep[order][:-1]
        opens = np.flatnonzero(fresh)
        least = np.minimum.reduceat(code[order], opens) if len(opens) else code
        some = order[opens]
        group = np.full(len(some), -1, np.int64)
        for level, n in enumerate(PREFIXES):
            open_ = np.flatnonzero(group < 0)
            own = _bin(chain(self.prints, n)[self.suffixes[some[open_]]], bins)
            light = ~heavy[level * bins + own]
            group[open_[light]] = level * bins + own[light]
        open_ = np.flatnonzero(group < 0)
        group[open_] = len(PREFIXES) * bins + _bin(deep[some[open_]], bins)
        by_group = np.argsort(group, kind="stable")
        place = np.empty(len(some), np.int64)
        place[by_group] = np.arange(len(some))
        leaf = np.empty(len(deep), np.int64)
        leaf[order] = place[np.cumsum(fresh) - 1]
        later = code > least[by_group][leaf]
        return group[by_group], deep[some][by_group], least[by_group], leaf, later

    def removed(self, repeated: np.ndarray) -> np.ndarray:
        """Marks the words that the windows at the marked suffixes cover."""
        change = np.zeros(len(self.prints) + 1, np.int64)
        at = self.suffixes[repeated]
        change[at] += 1
        change[at + self.window] -= 1
        return np.cumsum(change)[:-1] > 0

    def kept_text(self, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of the texts of the kept words, joined by a space."""
        starts, lengths = self.starts[kept], self.ends[kept] - self.starts[kept] + 1
        place = np.cumsum(lengths) - lengths
        size = int(lengths.sum())
        out = np.full(size, 0x20, np.uint8)
        at = np.arange(size) - np.repeat(place, lengths)
        inner = at < np.repeat(lengths - 1, lengths)
        out[inner] = self.data[(np.repeat(starts, lengths) + at)[inner]]
        before = np.concatenate([np.zeros(1, np.int64), np.cumsum(kept)])[self.bounds]
        ends = np.append(place, size)[before]
        last = ends[1:][np.diff(ends) > 0] - 1  # the space after a text's last word
        keep = np.ones(size, bool)
        keep[last] = False
        return out[keep], ends - np.concatenate([np.zeros(1, np.int64), np.cumsum(np.diff(ends) > 0)])


def _code_bytes(low: int | None, high: int | None) -> int:
    return max(1, (int(high - low + 1).bit_length() + 7) // 8) if low is not None else 1


def _packed(docs: DataFrame, bins: int, low: int, high: int, window: int) -> DataFrame:
    """Chunks of texts: chunk, codes of the ids (relative to the smallest), ids, offsets, compressed text, prefix counts."""
    names = ["chunk", "ids", "codes", "offsets", "size", "text", "counts"]

    def row(number, ids, codes, texts) -> pa.RecordBatch:
        data = np.concatenate([t[0] for t in texts])
        sizes = np.concatenate([np.diff(t[1]) for t in texts])
        offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        codes = np.concatenate(codes)
        counts = Chunk(data, offsets, codes, window).counts(bins).astype(np.int32)
        held = pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64()))
        text = pa.Codec(_CODEC).compress(data.tobytes(), asbytes=True)
        values = [pa.array([number]), held, *(pa.array([x], pa.binary()) for x in (codes.tobytes(), offsets.tobytes()))]
        return pa.RecordBatch.from_arrays([*values, pa.array([len(data)]), pa.array([text], pa.binary()), pa.array([counts.tobytes()], pa.binary())], names)

    def pack(batches):
        number, held, size = TaskContext.get().partitionId() << 32, ([], [], []), 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            own = batch.column(0).cast(pa.int64())
            code = np.where(np.asarray(own.is_valid()), np.asarray(own.fill_null(low)) - low, high - low + 1).astype(np.uint64)
            for a, b in pieces(offsets, CHUNK_BYTES // 4):
                for column, value in zip(held, (own[a:b], code[a:b], (data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))):
                    column.append(value)
                size += int(offsets[b] - offsets[a])
                if size >= CHUNK_BYTES:
                    yield row(number, *held)
                    number, held, size = number + 1, ([], [], []), 0
        if held[0]:
            yield row(number, *held)

    return docs.mapInArrow(pack, "chunk long, ids array<long>, codes binary, offsets binary, size long, text binary, counts binary")


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """The frame as files in the shared folder that are bucketed by a key, so that joins by it do not move them."""
    spark, name, path = df.sparkSession, f"chunks_{uuid.uuid4().hex}", scratch_path(df.sparkSession, "chunks")
    df.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the entry in the catalog; the files stay for this frame
    return out


def _chunk(row: dict, window: int) -> Chunk:
    data = np.frombuffer(pa.Codec(_CODEC).decompress(row["text"], row["size"], asbytes=True), np.uint8)
    return Chunk(data, np.frombuffer(row["offsets"], np.int64), np.frombuffer(row["codes"], np.uint64), window)


def _rows(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names) if name != "ids"} | (
                {"ids": batch.column(batch.schema.get_field_index("ids"))[k].values} if "ids" in batch.schema.names else {}
            )


def _leaves(chunks: DataFrame, heavy, bins: int, width: int, window: int) -> DataFrame:
    """A row for each chunk and group with the chunk's leaves there."""

    def send(batches):
        for row in _rows(batches):
            group, prints, least, _, _ = _chunk(row, window).leaves(heavy.value, bins)
            opens = np.flatnonzero(np.diff(group, prepend=-1))
            cuts = np.append(opens, len(group)).tolist()
            high = (prints >> np.uint64(8)).view(np.uint8).reshape(-1, 8)[:, :7]
            ids = least.view(np.uint8).reshape(-1, 8)[:, :width]
            spans = list(zip(cuts[:-1], cuts[1:]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(group[opens]), pa.array(np.full(len(opens), row["chunk"])),
                 pa.array([high[a:b].tobytes() for a, b in spans], pa.binary()),
                 pa.array([ids[a:b].T.tobytes() for a, b in spans], pa.binary())],
                ["group", "chunk", "prints", "ids"],
            )

    return chunks.select("chunk", "codes", "offsets", "size", "text").mapInArrow(send, "group long, chunk long, prints binary, ids binary")


def _answers(width: int):
    def answer(key, table):
        """For the leaves of each chunk a bit: a smaller document of another chunk has the leaf."""
        prints = [np.frombuffer(x, np.uint8).reshape(-1, 7) for x in table["prints"].to_pylist()]
        ids = [np.frombuffer(x, np.uint8).reshape(width, -1).T for x in table["ids"].to_pylist()]
        sizes = [len(x) for x in prints]

        def numbers(parts):
            out = np.zeros((sum(sizes), 8), np.uint8)
            out[:, : parts[0].shape[1]] = np.concatenate(parts)
            return out.view(np.uint64).ravel()

        leaf, code = numbers(prints), numbers(ids)
        order = np.argsort(leaf, kind="stable")
        fresh = np.ones(len(leaf), bool)
        fresh[1:] = leaf[order][1:] != leaf[order][:-1]
        least = np.minimum.reduceat(code[order], np.flatnonzero(fresh))
        smaller = np.empty(len(leaf), bool)
        smaller[order] = least[np.cumsum(fresh) - 1] < code[order]
        cuts = np.cumsum([0, *sizes])
        bits = [np.packbits(smaller[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.table({"chunk": table["chunk"], "group": table["group"], "n": pa.array(sizes, pa.int64()), "bits": pa.array(bits, pa.binary())})

    return answer


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, removed (ranges of words, last included) and kept_text
    (the words that stay, joined by a space)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    whole = docs.agg(F.sum(F.octet_length("text")).alias("size"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    low, high = (whole.low, whole.high) if whole.low is not None else (0, 0)
    bins, width = max(1024, int(4 * (whole.size or 0) / 6 / group_suffixes)), _code_bytes(low, high)
    buckets = max(16, int((whole.size or 0) / CHUNK_BYTES / 4))
    chunks = _bucketed(_packed(docs, bins, low, high, window), "chunk", buckets)

    def summed(batches):
        total = np.zeros(len(PREFIXES) * bins, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.frombuffer(x, np.int32)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bin", "n"])

    counted = chunks.select("counts").mapInArrow(summed, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    heavy = np.zeros(len(PREFIXES) * bins, bool)  # a flag per bin; what is collected are the bins above the limit
    heavy[[r.bin for r in counted.filter(F.col("n") > group_suffixes).select("bin").collect()]] = True
    heavy = spark.sparkContext.broadcast(heavy)

    leaves = _leaves(chunks, heavy, bins, width, window)
    answers = leaves.groupBy("group").applyInArrow(_answers(width), "chunk long, group long, n long, bits binary")
    answers = snapshot(answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("group", "n", "bits"))).alias("answers")), "answers")

    def mark(batches):
        for row in _rows(batches):
            chunk = _chunk(row, window)
            _, prints, _, leaf, later = chunk.leaves(heavy.value, bins)
            bits = [np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=a["n"]) for a in row["answers"] or ()]
            smaller = np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)
            gone = chunk.removed(smaller[leaf] | later)
            text, offsets = chunk.kept_text(~gone)
            before = np.concatenate([np.zeros(1, np.int64), np.cumsum(gone)])[chunk.bounds]
            edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
            first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
            owner = np.searchsorted(chunk.bounds, first, "right") - 1
            ranges = [[] for _ in range(len(chunk.bounds) - 1)]
            for i, a, b in zip(owner.tolist(), first.tolist(), last.tolist()):
                while a <= b:  # a run may go on into the next text
                    end = min(b, int(chunk.bounds[i + 1]) - 1)
                    if a <= end:
                        ranges[i].append({"first": a - int(chunk.bounds[i]), "last": end - int(chunk.bounds[i])})
                    a, i = end + 1, i + 1
            kept = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(text.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [row["ids"], pa.array(np.diff(chunk.bounds)), pa.array(np.diff(before)),
                 pa.array(ranges, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), kept.cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "removed", "kept_text"],
            )

    answered = chunks.select("chunk", "ids", "codes", "offsets", "size", "text").join(answers.hint("merge"), "chunk", "left")
    return answered.mapInArrow(mark, "doc_id long, n_words long, n_removed long, removed array<struct<first:long,last:long>>, kept_text string")


def op2_suffix_trees(spark, d: str) -> DataFrame:
    found = remove_repeats(spark.read.parquet(f"{d}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES = {"op2_suffix_trees": op2_suffix_trees}
ORACLES = {
    "op2_suffix_trees": r"""
WITH t AS (SELECT doc_id, COALESCE(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM t WHERE len(w) >= 13)),
hit AS (SELECT doc_id, i FROM (SELECT *, MIN(doc_id) OVER (PARTITION BY g) AS least FROM g) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM hit),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM t),
kept AS (SELECT words.doc_id, string_agg(word, ' ' ORDER BY p) AS text, COUNT(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - COALESCE(n, 0) AS BIGINT) AS n_removed, sha256(COALESCE(text, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)"""
}
