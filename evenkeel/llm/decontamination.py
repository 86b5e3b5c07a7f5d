"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of consecutive words of every item. Training words stream through it; after each
word it knows the longest run of item words that ends there. Where that is at least a window long, the words of
the window are hit, and the state that stands for the window knows its items. An item of fewer words than a
window is one window itself.

The automaton is bounded, whatever the benchmark: items are cut into overlapping pieces and dealt over shards of
``SHARD_WORDS`` words, and the documents stream through one shard after the other. A first look at the word
fingerprints (64 bits) leaves out words that occur in no item, so that only runs that can match are streamed.

Defined results: a null or empty text has no words and no hits, a null item is ignored, items that share an id
count once, repeated documents are judged each for itself, a table without rows gives none, an empty benchmark
hits nothing. Texts are read whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.llm.words import ALPHANUMERIC, Words, pieces, text_bytes
from evenkeel.sources.tables import snapshot

WINDOW = 13
#: Words of items in an automaton; about 0.5 KB each in a worker.
SHARD_WORDS = 200_000
PIECE_WORDS = 20_000
_RANGES = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))
RESULT = T.StructType([
    T.StructField("__n_words", T.LongType()),
    T.StructField("__hits", _RANGES),
    T.StructField("__items", T.ArrayType(T.StringType())),
])


class Automaton:
    """Suffix automaton of several sequences, with what a matcher needs at each state."""

    def __init__(self, sequences: list[tuple[str, list[int]]], window: int):
        self.window, self.next, self.link, self.length = window, [{}], [-1], [0]
        ends: list[tuple[str, list[int]]] = []
        for name, sequence in sequences:
            state, path = 0, []
            for symbol in sequence:
                state = self._extend(state, symbol)
                path.append(state)
            ends.append((name, path))
        self.window_state = [-1] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            if self.length[s] >= window:
                up = self.link[s]
                self.window_state[s] = s if self.length[up] < window else self.window_state[up]
        self.items: dict[int, set[str]] = {}
        short: dict[int, set[str]] = {}
        for name, path in ends:
            if len(path) < window:
                short.setdefault(path[-1], set()).add(name)
            for s in path[window - 1 :]:
                self.items.setdefault(self.window_state[s], set()).add(name)
        self.short = short
        self.short_above = [-1] * len(self.next)  # the nearest state at or above that is a whole short item
        if short:
            for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
                self.short_above[s] = s if s in short else self.short_above[self.link[s]]

    def _extend(self, last: int, symbol: int) -> int:
        to = self.next[last].get(symbol)
        if to is not None:
            return to if self.length[to] == self.length[last] + 1 else self._split(last, symbol, to)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            to = self.next[at][symbol]
            self.link[new] = to if self.length[to] == self.length[at] + 1 else self._split(at, symbol, to)
        return new

    def _split(self, at: int, symbol: int, to: int) -> int:
        """A copy of state ``to`` for its shorter runs."""
        copy = self._state(self.length[at] + 1, dict(self.next[to]))
        self.link[copy], self.link[to] = self.link[to], copy
        while at >= 0 and self.next[at].get(symbol) == to:
            self.next[at][symbol] = copy
            at = self.link[at]
        return copy

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def matches(self, symbols: list[int]) -> Iterator[tuple[int, int, set[str]]]:
        """(first, last, items) of each window that occurs in ``symbols``."""
        following, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for i, symbol in enumerate(symbols):
            while state and symbol not in following[state]:
                state = link[state]
                matched = length[state]
            to = following[state].get(symbol)
            if to is None:
                continue
            state, matched = to, matched + 1
            if matched >= window:
                at = state
                if length[link[at]] >= window:
                    at = self.window_state[at]
                yield i - window + 1, i, self.items.get(at, set())
            at = self.short_above[state] if self.short else -1
            while at > 0:
                if length[at] <= matched:
                    yield i - length[at] + 1, i, self.short[at]
                at = self.short_above[link[at]]


def _item_pieces(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """item, part, n_words and the words' fingerprints, for each piece of each item that has words."""

    def cut(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            out = ([], [], [], [])
            for a, b in pieces(offsets):
                words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], ALPHANUMERIC, fold=True)
                prints = words.fingerprints()
                for i in range(b - a):
                    own = prints[words.bounds[i] : words.bounds[i + 1]]
                    for k, first in enumerate(range(0, max(len(own) - window + 1, min(len(own), 1)), PIECE_WORDS)):
                        piece = own[first : first + PIECE_WORDS + window - 1]
                        for column, value in zip(out, (batch.column(0)[a + i].as_py(), k, len(piece), piece.tobytes())):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary())],
                ["item", "part", "n_words", "prints"],
            )

    named = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    return named.mapInArrow(cut, "item string, part long, n_words long, prints binary")


@lru_cache(maxsize=1)
def _matcher(shard: tuple[tuple[str, bytes], ...], window: int) -> tuple[np.ndarray, int, Automaton]:
    """The vocabulary, the length of the shortest window and the automaton; made once per worker."""
    prints = [np.frombuffer(b, np.uint64) for _, b in shard]
    vocabulary = np.unique(np.concatenate(prints))
    symbols = [(name, np.searchsorted(vocabulary, p).tolist()) for (name, _), p in zip(shard, prints)]
    return vocabulary, min(window, *(len(p) for p in prints), window), Automaton(symbols, window)


def _found(words: Words, vocabulary: np.ndarray, shortest: int, automaton: Automaton) -> list[tuple[int, int, int, set[str]]]:
    """(text, first word, last word, items) of the windows in a piece."""
    prints = words.fingerprints()
    if len(prints) < shortest:
        return []
    # A bit per hash of the vocabulary settles most words before they are looked up.
    bits = np.zeros(1 << 16, bool)
    bits[(vocabulary >> np.uint64(48)).astype(np.int64)] = True
    maybe = np.flatnonzero(bits[(prints >> np.uint64(48)).astype(np.int64)])
    symbol = np.full(len(prints), -1, np.int64)
    place = np.minimum(np.searchsorted(vocabulary, prints[maybe]), len(vocabulary) - 1)
    same = vocabulary[place] == prints[maybe]
    symbol[maybe[same]] = place[same]
    known = symbol >= 0
    opens = known.copy()
    opens[1:] &= ~known[:-1]
    firsts = words.bounds[:-1][(np.diff(words.bounds) > 0)]
    opens[firsts] = known[firsts]
    closes = known.copy()
    closes[:-1] &= ~known[1:]
    lasts = words.bounds[1:][(np.diff(words.bounds) > 0)] - 1
    closes[lasts] = known[lasts]
    opens, closes = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    long = closes - opens >= shortest
    out = []
    for first, end in zip(opens[long].tolist(), closes[long].tolist()):
        text = int(np.searchsorted(words.bounds, first, "right")) - 1
        base = first - int(words.bounds[text])
        out += [(text, base + a, base + b, names) for a, b, names in automaton.matches(symbol[first:end].tolist())]
    return out


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def _through(docs: DataFrame, text_col: str, carry: list[str], shard, window: int, earlier: bool) -> DataFrame:
    """The carried columns and RESULT, with the hits of one shard added to those of earlier ones."""
    names = [*carry, *RESULT.names]
    schema = T.StructType([docs.schema[c] for c in carry] + RESULT.fields)

    def stream(batches):
        vocabulary, shortest, automaton = _matcher(shard.value, window) if shard.value else (None, 0, None)
        for batch in batches:
            data, offsets = text_bytes(batch.column(batch.schema.get_field_index(text_col)))
            counts, hits, items = np.zeros(len(offsets) - 1, np.int64), {}, {}
            for a, b in pieces(offsets):
                words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], ALPHANUMERIC, fold=True)
                counts[a:b] = np.diff(words.bounds)
                for text, first, last, found in _found(words, vocabulary, shortest, automaton) if automaton else ():
                    hits.setdefault(a + text, []).append((first, last))
                    items.setdefault(a + text, set()).update(found)
            if earlier:
                for i, old in enumerate(batch.column(batch.schema.get_field_index("__hits")).to_pylist()):
                    if old:
                        hits.setdefault(i, []).extend((r["first"], r["last"]) for r in old)
                        items.setdefault(i, set()).update(batch.column(batch.schema.get_field_index("__items"))[i].as_py())
            spans = [[{"first": f, "last": z} for f, z in _merged(hits[i])] if i in hits else [] for i in range(len(counts))]
            lists = [sorted(items[i]) if i in items else [] for i in range(len(counts))]
            ranges = pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))
            carried = [batch.column(batch.schema.get_field_index(c)) for c in carry]
            yield pa.RecordBatch.from_arrays([*carried, pa.array(counts), ranges, pa.array(lists, pa.list_(pa.string()))], names)

    read = list(dict.fromkeys([*carry, text_col, *(RESULT.names[1:] if earlier else ())]))
    return docs.select(*read).mapInArrow(stream, schema)


def matched(docs: DataFrame, items: DataFrame, carry: list[str], text_col: str = "text", item_id: str = "item_id",
            item_text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The carried columns of ``docs`` with ``__n_words``, ``__hits`` (merged ranges of words, last included) and
    ``__items`` (ids of items with an occurring window)."""
    parts = snapshot(_item_pieces(items, item_id, item_text, window), "benchmark-pieces")
    total = parts.agg(F.sum("n_words")).first()[0] or 0
    shards = max(1, -(-2 * total // shard_words))  # twice as many as needed, as they are dealt by a hash
    parts = parts.withColumn("shard", F.pmod(F.xxhash64("item", "part"), F.lit(shards)))
    spark = docs.sparkSession
    for k in range(shards):
        rows = parts.filter(F.col("shard") == k).select("item", "prints").collect()  # bounded by shard_words
        shard = spark.sparkContext.broadcast(tuple((r.item, bytes(r.prints)) for r in rows))
        last = k == shards - 1
        docs = _through(docs, text_col, carry if last else list(dict.fromkeys([*carry, text_col])), shard, window, earlier=k > 0)
        if not last:
            docs = snapshot(docs, "decontamination")
    return docs


def _judged(found: DataFrame, coverage: int) -> DataFrame:
    hit = F.aggregate("__hits", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    found = found.withColumn("__n_hit", hit)
    return found.withColumn("__contaminated", (F.col("__n_hit") > 0) & (coverage * F.col("__n_hit") >= F.col("__n_words")))


def judge(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", coverage: int = 20, **options) -> DataFrame:
    """One row per document: its id, n_words, n_hit, items, spans and contaminated (at least one in ``coverage`` words is hit)."""
    found = _judged(matched(docs, items, [id_col], text_col, **options), coverage)
    return found.select(
        F.col(id_col).alias("doc_id"), F.col("__n_words").alias("n_words"), F.col("__n_hit").alias("n_hit"),
        F.col("__items").alias("items"), F.col("__hits").alias("spans"), F.col("__contaminated").alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", coverage: int = 20, **options) -> DataFrame:
    """The documents that are not contaminated, unchanged and with all their columns."""
    whole = docs.select(F.struct("*").alias("whole"), F.col(text_col).alias("text"))
    found = _judged(matched(whole, items, ["whole"], **options), coverage)
    return found.filter(~F.col("__contaminated")).select("whole.*")


def remove_spans(docs: DataFrame, items: DataFrame, text_col: str = "text", longest: int = WINDOW, coverage: int = 2, **options) -> DataFrame:
    """Documents without the hit spans of at least ``longest`` words: the words that stay, lower-cased and joined by a
    space, where something was removed, else the text as it was. A document with one in ``coverage`` words hit goes."""
    whole = docs.select(F.struct("*").alias("whole"), F.col(text_col).alias("text"))
    found = _judged(matched(whole, items, ["whole", "text"], **options), coverage).filter(~F.col("__contaminated"))
    folded = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(folded, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), 0)
    spans = F.filter("__hits", lambda r: r["last"] - r["first"] + 1 >= longest)
    left = F.filter(words, lambda w, i: ~F.exists(spans, lambda r: (r["first"] <= i) & (i <= r["last"])))
    text = F.when(F.size(spans) > 0, F.concat_ws(" ", left)).otherwise(F.col("text"))
    return found.select(*[text.alias(c) if c == text_col else F.col("whole")[c].alias(c) for c in docs.columns])


def op5_suffix_automaton(spark, d: str) -> DataFrame:
    found = judge(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


QUERIES = {"op5_suffix_automaton": op5_suffix_automaton}
_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLES = {
    "op5_suffix_automaton": f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM bw),
t AS (SELECT doc_id, COALESCE({_WORDS}, []) AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM t),
found AS (SELECT doc_id, i, bw.k, item_id FROM places CROSS JOIN sizes JOIN bw ON bw.k = sizes.k AND bw.g = array_to_string(w[i:i + sizes.k - 1], ' ')
  WHERE i + sizes.k - 1 <= len(w)),
hit AS (SELECT doc_id, COUNT(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, COUNT(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(hit.n, 0) AS n_hit, COALESCE(named.n, 0) AS n_items,
  sha256(COALESCE(items, '')) AS items_sha256, COALESCE(hit.n > 0 AND 20 * hit.n >= len(w), FALSE) AS contaminated
FROM t LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""
}
