"""Target-distribution importance resampling with a head-tail vocabulary.

Features of a text are its words and its pairs of neighbouring words, hashed into buckets by the CRC-32 of their bytes.
A bucket's gain is the logarithm of its share in the target over its share in the corpus; a document weighs the mean
gain of its features, and Gumbel noise from its id turns "the highest scores" into a draw without replacement.

Text has few words that are very frequent, and very many others. The frequent ones are the head: all tasks count their
words and pairs, and those that make up one in ``HEAD_SHARE`` of all words are broadcast, of which there can be no more
than ``HEAD_SHARE`` words and as many pairs at any size of the corpus. A head word comes with the state in which
its CRC leaves the checksum, alone and followed by a space, and a head pair with its bucket, so that their bytes are not
read again. Any other feature, the tail, gets its CRC directly; a pair that begins with a head word goes on from that
word's state. Both ways give the same bucket, so totals are exact and do not depend on what is in the head.

Totals are summed per task first, and the drawn documents are ranked over ranges of their scores, not in one task.

Defined results: null and empty texts have no features and weight 0; a null id is hashed as an empty one and comes first
among equal scores; repeated rows are documents of their own, and equal scores of one id are ranked in any order; an
empty corpus or target has totals of zero. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.numbering import number_rows
from evenkeel.llm.slices import ALPHANUMERIC, folded, word_lists
from evenkeel.sources.tables import snapshot

# Buckets, seed of the noise, share drawn, words that a document needs.
BUCKETS, SEED, PERCENT, LEAST_WORDS = 10_000, 7, 25, 20
#: A word or pair belongs to the head if it is one in so many words; also the largest number of either in the head.
HEAD_SHARE = 20_000
#: Words that a task counts at a time; what is rarer among them than half that share is not counted on.
COUNTED_WORDS = 1 << 18


class Vocabulary:
    """The head: CRC states of frequent words, and buckets of frequent pairs."""

    def __init__(self, words, pairs, buckets: int = BUCKETS):
        self.buckets = buckets
        self.states = {w: zlib.crc32(w) for w in words}
        self.spaced = {w: zlib.crc32(b" ", c) for w, c in self.states.items()}
        self.pairs = {(a, b): zlib.crc32(a + b" " + b) % buckets for a, b in pairs}

    def features(self, text: bytes) -> Iterator[tuple[int, list[int]]]:
        """For each slice of a text its number of words and the buckets of the features that end in it."""
        states, spaced, pairs, buckets, crc = self.states, self.spaced, self.pairs, self.buckets, zlib.crc32
        before: list[bytes] = []
        for words in word_lists(text, ALPHANUMERIC):
            found = [c if c is not None else crc(w) for w, c in zip(words, map(states.get, words))]
            out = [c % buckets for c in found]
            first = before + words if before else words
            for pair, bucket in zip(zip(first, first[1:]), map(pairs.get, zip(first, first[1:]))):
                if bucket is None:
                    a, b = pair
                    state = spaced.get(a)
                    bucket = crc(b, crc(b" ", crc(a)) if state is None else state) % buckets
                out.append(bucket)
            before = words[-1:] or before
            yield len(words), out


def frequent(texts: DataFrame) -> tuple[list[bytes], list[tuple[bytes, bytes]]]:
    """The head of a column of texts: words and pairs by their counts over all of it."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        words, pairs, n = Counter(), Counter(), 0
        for batch in batches:
            for text in folded(batch.column(0)):
                before: list[bytes] = []
                for found in word_lists(text, ALPHANUMERIC):
                    words.update(found)
                    both = before + found
                    pairs.update(zip(both, both[1:]))
                    before, n = found[-1:] or before, n + len(found)
                    if n >= COUNTED_WORDS:
                        yield listed(words, pairs, n)
                        words, pairs, n = Counter(), Counter(), 0
        yield listed(words, pairs, n)

    def listed(words: Counter, pairs: Counter, n: int) -> pa.RecordBatch:
        least = max(2, n // (2 * HEAD_SHARE))
        rows = [(None, None, n)] + [(w, None, k) for w, k in words.items() if k >= least] + [(a, b, k) for (a, b), k in pairs.items() if k >= least]
        kinds = (pa.binary(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["a", "b", "n"])

    counted = texts.mapInArrow(count, "a binary, b binary, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    counted = snapshot(counted, "frequent")
    total = counted.filter("a IS NULL").agg(F.sum("n")).first()[0] or 0
    head = counted.filter((F.col("n") * HEAD_SHARE >= total) & F.col("a").isNotNull()).collect()  # HEAD_SHARE words and pairs at most
    return [bytes(r.a) for r in head if r.b is None], [(bytes(r.a), bytes(r.b)) for r in head if r.b is not None]


def bucket_totals(texts: DataFrame, vocabulary) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket that has any. ``vocabulary`` is a broadcast."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(vocabulary.value.buckets, np.int64)
        for batch in batches:
            for text in folded(batch.column(0)):
                for _, found in vocabulary.value.features(text):
                    totals += np.bincount(np.array(found, np.int64), minlength=len(totals))
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], ["bucket", "n"])

    return texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket from the totals of both sides."""
    spark = corpus.sparkSession
    both = spark.range(buckets).select(F.col("id").alias("bucket"))
    both = both.join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0)
    sums = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t")).first()  # two numbers
    share = f"(t + 1D) * ({sums.all_s} + {buckets}D) / ((s + 1D) * ({sums.all_t} + {buckets}D))"
    return both.selectExpr("bucket", f"CAST(floor(1000 * ln({share})) AS BIGINT) AS gain")


def weighed(docs: DataFrame, vocabulary, gain, carry, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """The ``carry`` columns of each document with __id, __n_words, __n_features, __weight and __score. ``vocabulary`` and
    ``gain`` (an array by bucket) are broadcasts."""
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"), *carry)
    numbers = ["__n_words", "__n_features", "__weight"]
    kept = [f for f in rows.schema if f.name != "__text"]
    names = [f.name for f in kept] + numbers

    def weigh(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[int]] = [[], [], []]
            for text in folded(batch.column(1)):
                n_words = n_features = total = 0
                for n, found in vocabulary.value.features(text):
                    n_words, n_features = n_words + n, n_features + len(found)
                    total += int(gain.value[np.array(found, np.int64)].sum())
                for column, value in zip(out, (n_words, n_features, total // n_features if n_features else 0)):
                    column.append(value)
            own = [batch.column(k) for k in range(batch.num_columns) if k != 1]
            yield pa.RecordBatch.from_arrays([*own, *[pa.array(c, pa.int64()) for c in out]], names)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{n} long" for n in numbers])
    noise = f"CAST(conv(substring(sha2(concat('{seed}:', coalesce(CAST(__id AS STRING), '')), 256), 1, 8), 16, 10) AS BIGINT)"
    return rows.mapInArrow(weigh, schema).selectExpr("*", f"__weight + CAST(floor(-1000 * ln(-ln(({noise} + 0.5D) / 4294967296D))) AS BIGINT) AS __score")


def _fitted(docs: DataFrame, target: DataFrame, text_col: str, buckets: int):
    """The broadcast vocabulary and gains of a corpus and its target; their sizes are fixed."""
    context = docs.sparkSession.sparkContext
    own, wanted = docs.select(F.col(text_col).alias("text")), target.select(F.col(text_col).alias("text"))
    vocabulary = context.broadcast(Vocabulary(*frequent(own), buckets))
    found = gains(snapshot(bucket_totals(own, vocabulary), "totals"), snapshot(bucket_totals(wanted, vocabulary), "totals"), buckets)
    gain = np.zeros(buckets, np.int64)
    for r in found.collect():  # one row for each bucket
        gain[r.bucket] = r.gain
    return vocabulary, context.broadcast(gain)


def ranked(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
    least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score and its rank among the drawn (else null)."""
    scores = snapshot(weighed(docs, *_fitted(docs, target, text_col, buckets), [], id_col, text_col, seed), "scores")
    names = {"__id": "doc_id", "__n_words": "n_words", "__n_features": "n_features", "__weight": "weight", "__score": "score"}
    scores = scores.withColumnsRenamed(names)
    able = scores.filter(F.col("n_words") >= least_words)
    drawn = percent * able.count() // 100
    numbered = number_rows(able.withColumn("__all", F.lit(0)), ["__all"], ["-score", "doc_id"], "place").drop("__all")
    placed = numbered.withColumn("rank", F.when(F.col("place") <= drawn, F.col("place"))).drop("place")
    return placed.unionByName(scores.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The drawn documents with all their columns, in no order. The last drawn score and id are the cut, so no text is
    shuffled; rows that repeat the id and text at the cut are drawn together."""
    buckets, seed = options.get("buckets", BUCKETS), options.get("seed", SEED)
    last = ranked(docs, target, id_col, text_col, **options).filter("rank IS NOT NULL").agg(F.max(F.struct("rank", "score", "doc_id")).alias("r")).first().r
    if last is None:
        return docs.filter(F.lit(False))
    fitted = _fitted(docs, target, text_col, buckets)
    whole = docs.select(F.struct("*").alias("whole"), F.col(id_col).alias("__own"), F.col(text_col).alias("__words"))
    scores = weighed(whole, *fitted, ["whole"], "__own", "__words", seed).filter(F.col("__n_words") >= options.get("least_words", LEAST_WORDS))
    tied = F.col("__id").isNull() if last.doc_id is None else F.col("__id").isNull() | (F.col("__id") <= last.doc_id)
    return scores.filter((F.col("__score") > last.score) | ((F.col("__score") == last.score) & tied)).select("whole.*")


def op12_head_tail(spark, d: str) -> DataFrame:
    found = ranked(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {"op12_head_tail": op12_head_tail}


def _crc_entry(n: int) -> int:
    for _ in range(8):
        n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
    return n


_TABLE = ", ".join(str(_crc_entry(n)) for n in range(256))
#: CRC-32 of the text f, byte by byte.
CRC_SQL = f"""xor(4294967295, list_reduce(
    list_transform(range(0, octet_length(encode(f))), lambda i: CAST(('0x' || substr(hex(encode(f)), 2 * i + 1, 2)) AS BIGINT)),
    lambda c, b: xor(c >> 8, [{_TABLE}][(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)))"""
_WORDS = r"regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLES = {
    "op12_head_tail": f"""
WITH w AS (SELECT 0 AS side, doc_id, {_WORDS} AS w FROM documents UNION ALL SELECT 1, NULL, {_WORDS} FROM benchmark),
g AS (SELECT side, doc_id, unnest(w) AS f FROM w
  UNION ALL SELECT side, doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w),
k AS (SELECT f, {CRC_SQL} % 10000 AS bucket FROM (SELECT DISTINCT f FROM g)),
b AS (SELECT side, doc_id, bucket FROM g JOIN k USING (f)),
n AS (SELECT bucket, COUNT(*) FILTER (side = 0) AS s, COUNT(*) FILTER (side = 1) AS t FROM b GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * ((SELECT SUM(s) FROM n)::DOUBLE + 10000) / ((s + 1.0::DOUBLE) * ((SELECT SUM(t) FROM n)::DOUBLE + 10000)))) AS gain FROM n),
m AS (SELECT doc_id, COUNT(*) AS n_features, CAST(floor(SUM(gain) / COUNT(*)) AS BIGINT) AS weight FROM b JOIN gain USING (bucket) WHERE side = 0 GROUP BY doc_id),
d AS (SELECT doc_id, len(w) AS n_words, COALESCE(n_features, 0) AS n_features, COALESCE(weight, 0) AS weight,
    COALESCE(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('7:' || doc_id), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM w LEFT JOIN m USING (doc_id) WHERE side = 0),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM d WHERE n_words >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
  CAST(CASE WHEN rank <= (SELECT 25 * COUNT(*) // 100 FROM r) THEN rank END AS BIGINT) AS rank FROM d LEFT JOIN r USING (doc_id)"""
}
