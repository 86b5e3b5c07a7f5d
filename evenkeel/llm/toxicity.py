"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word enters the network by its own evidence and embedding and by those of its character n-grams (3 to 5, with the
word's edges), so that unseen forms of a known stem are met. The network reads windows of ``WINDOW`` words that
overlap; every window of every text is scored, and a text's score is that of its highest window.

It is fitted on a bounded sample of labelled rows, ``PER_CLASS`` of each class by a hash of the id, in one task;
what comes back is some hundred KB of weights. Scoring is one pass over the texts and shuffles nothing.

Defined results: null and empty texts get the score of an empty window, labels other than 0 and 1 and labels without
a text are ignored, repeated rows are scored each for itself; without labels of both classes every score is 0.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.llm.words import ALPHANUMERIC, Words, give_back, mix, pieces, text_bytes

WINDOW, STRIDE, THRESHOLD = 40, 24, 0.3
#: Labelled rows of each class that the network is fitted on, at most.
PER_CLASS = 3000
GRAMS = (3, 4, 5)
WORD_BUCKETS = GRAM_BUCKETS = 1 << 17
ROWS, EMBEDDED, HIDDEN, ATTENTION = 1 << 11, 4, 8, 8
EPOCHS, BATCH, RATE, PRIOR = 6, 128, 0.01, 4.0
_EDGE = np.uint64(0x5BD1E995)


class Tokens:
    """The words of some texts as numbers: ``kind`` of each word, and hashes of the kinds and of their n-grams."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets, ALPHANUMERIC, fold=True)
        prints = words.fingerprints()
        self.bounds = words.bounds
        kinds, first, self.kind = np.unique(prints, return_index=True, return_inverse=True)
        self.word = (kinds >> np.uint64(32)).astype(np.int64)
        starts, lengths = words.starts[first], words.ends[first] - words.starts[first]
        # Kinds laid end to end, with an edge mark (0) before and after each.
        padded = lengths + 2
        base = np.cumsum(padded) - padded
        letters = np.zeros(int(padded.sum()), np.uint64)
        inner = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        letters[np.repeat(base + 1, lengths) + inner] = words.data[np.repeat(starts, lengths) + inner].astype(np.uint64) + _EDGE
        owner = np.repeat(np.arange(len(kinds)), padded)
        grams, owners = [], []
        for n in GRAMS:
            if len(letters) < n:
                continue
            code = np.full(len(letters) - n + 1, n, np.uint64)
            for k in range(n):
                code *= np.uint64(0x9E3779B97F4A7C15)
                code += letters[k : k + len(code)]
            whole = owner[: len(code)] == owner[n - 1 :]
            grams.append((mix(code[whole]) >> np.uint64(32)).astype(np.int64))
            owners.append(owner[: len(code)][whole])
        gram, own = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (grams, owners))
        order = np.argsort(own, kind="stable")
        self.gram, self.gram_bounds = gram[order], np.searchsorted(own[order], np.arange(len(kinds) + 1))

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, number of words and text of every window. The last one of a text ends with it; an empty text
        has an empty window."""
        sizes = np.diff(self.bounds)
        counts = np.where(sizes <= WINDOW, 1, -(-(sizes - WINDOW) // STRIDE) + 1)
        text = np.repeat(np.arange(len(sizes)), counts)
        number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        first = np.minimum(number * STRIDE, np.maximum(sizes[text] - WINDOW, 0))
        return self.bounds[:-1][text] + first, np.minimum(sizes[text], WINDOW), text


def _reduced(ufunc, values: np.ndarray, bounds: np.ndarray, empty: float = 0.0) -> np.ndarray:
    """``ufunc`` over each range of values."""
    out = np.full((len(bounds) - 1, *values.shape[1:]), empty, np.float32)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        out[full] = ufunc.reduceat(values, bounds[:-1][full])
    return out


def _ranges(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All positions from each first to its end."""
    lengths = end - first
    return np.repeat(first - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))


def _scattered(rows: np.ndarray, values: np.ndarray, n: int = ROWS) -> np.ndarray:
    """The sum of the values of each row."""
    return np.stack([np.bincount(rows, values[:, k], n) for k in range(values.shape[1])], 1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Evidence:
    """Log odds of the toxic class, by hashed word and n-gram, from the texts in which they occur."""

    def __init__(self, size: int):
        self.toxic, self.all = np.zeros(size, np.float32), np.zeros(size, np.float32)

    def add(self, hashes: np.ndarray, label: int) -> None:
        self.all[hashes] += 1
        self.toxic[hashes] += label

    def odds(self, hashes: np.ndarray, without: int | None = None) -> np.ndarray:
        """``without``: the label of the text that asks, which does not count as its own evidence."""
        toxic, every = self.toxic[hashes], self.all[hashes]
        if without is not None:
            toxic, every = toxic - without, every - 1
        return np.log((toxic + PRIOR / 2) / (every - toxic + PRIOR / 2)).astype(np.float32)


class Network:
    """Embeddings, a gated recurrent layer in each direction, attention and a logistic output."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        d, h = 3 + 2 * EMBEDDED, HIDDEN
        normal = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {
            "word": 0.05 * rng.standard_normal((ROWS, EMBEDDED)).astype(np.float32),
            "gram": 0.05 * rng.standard_normal((ROWS, EMBEDDED)).astype(np.float32),
            "xf": normal(d, 3 * h), "hf": normal(h, 3 * h), "bf": np.zeros(3 * h, np.float32),
            "xb": normal(d, 3 * h), "hb": normal(h, 3 * h), "bb": np.zeros(3 * h, np.float32),
            "att": normal(2 * h, ATTENTION), "query": normal(ATTENTION), "out": normal(2 * h), "bias": np.full(1, -1.0, np.float32),
        }
        self.words, self.grams = Evidence(WORD_BUCKETS), Evidence(GRAM_BUCKETS)
        self.fitted = False

    # -- inputs ------------------------------------------------------------------------------------------------

    def features(self, t: Tokens, without: int | None = None) -> np.ndarray:
        """Inputs of each kind of word: its odds, the highest and the mean of its n-grams' odds."""
        own = self.words.odds(t.word % WORD_BUCKETS, without)
        odds = self.grams.odds(t.gram % GRAM_BUCKETS, without)
        count = np.maximum(np.diff(t.gram_bounds), 1)
        high = _reduced(np.maximum, odds, t.gram_bounds)
        return np.stack([own, high, _reduced(np.add, odds, t.gram_bounds) / count], 1)

    def _embedded(self, t: Tokens) -> np.ndarray:
        grams = _reduced(np.add, self.p["gram"][t.gram % ROWS], t.gram_bounds)
        return np.concatenate([self.p["word"][t.word % ROWS], grams / np.maximum(np.diff(t.gram_bounds), 1)[:, None]], 1)

    # -- forward -----------------------------------------------------------------------------------------------

    def _layer(self, gates: np.ndarray, mask: np.ndarray | None, side: str, keep: list | None) -> np.ndarray:
        """States (time, HIDDEN, window) of one direction; gates are the inputs' share, (time, 3 HIDDEN, window).
        The windows lie along the last axis, so that every operation runs over contiguous numbers."""
        steps, _, n = gates.shape
        h, w = HIDDEN, np.ascontiguousarray(self.p["h" + side].T)
        state, out = np.zeros((h, n), np.float32), np.empty((steps, h, n), np.float32)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            from_state = w @ state
            gate = gates[t, : 2 * h] + from_state[: 2 * h]
            gate *= 0.5
            np.tanh(gate, out=gate)
            gate += 1
            gate *= 0.5
            new = gate[h:] * from_state[2 * h :]
            new += gates[t, 2 * h :]
            np.tanh(new, out=new)
            after = state - new
            after *= gate[:h]
            after += new
            if mask is not None:
                after = np.where(mask[t], after, state)
            if keep is not None:
                keep.append((t, state, from_state, gate[:h], gate[h:], new))
            state = out[t] = after
        return out

    def logits(self, gates_f: np.ndarray, gates_b: np.ndarray, mask: np.ndarray | None, keep: dict | None = None) -> np.ndarray:
        trail_f, trail_b = ([], []) if keep is not None else (None, None)
        states = np.concatenate([self._layer(gates_f, mask, "f", trail_f), self._layer(gates_b, mask, "b", trail_b)], 1)
        key = np.tanh(np.ascontiguousarray(self.p["att"].T) @ states)
        weight = np.einsum("j,tjb->tb", self.p["query"], key)
        if mask is not None:
            weight = np.where(mask, weight, np.float32(-1e9))
        weight = np.exp(weight - weight.max(0))
        if mask is not None:
            weight = weight * mask
        weight /= np.maximum(weight.sum(0), np.float32(1e-9))
        pooled = np.einsum("tb,tib->ib", weight, states)
        if keep is not None:
            keep |= {"f": trail_f, "b": trail_b, "states": states, "key": key, "weight": weight, "pooled": pooled}
        return self.p["out"] @ pooled + self.p["bias"]

    def window_scores(self, t: Tokens, without: int | None = None, block: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """Score and text of every window."""
        first, size, text = t.windows()
        if not self.fitted:
            return np.zeros(len(text), np.float32), text
        inputs = np.concatenate([self.features(t, without), self._embedded(t)], 1)
        shares = [np.concatenate([inputs @ self.p["x" + s] + self.p["b" + s], np.zeros((1, 3 * HIDDEN), np.float32)]) for s in "fb"]
        kind = np.append(t.kind, len(inputs))  # the last one pads
        scores = np.empty(len(text), np.float32)
        whole = size == WINDOW
        for chosen, padded in ((np.flatnonzero(whole), False), (np.flatnonzero(~whole), True)):
            for k in range(0, len(chosen), block):
                rows = chosen[k : k + block]
                steps = int(size[rows].max(initial=1)) if padded else WINDOW
                at = first[rows][None, :] + np.arange(max(steps, 1))[:, None]
                mask = (np.arange(max(steps, 1))[:, None] < size[rows][None, :]) if padded else None
                at = np.where(mask, at, len(t.kind)) if padded else at
                gates = [np.ascontiguousarray(share[kind[at]].transpose(0, 2, 1)) for share in shares]
                scores[rows] = _sigmoid(self.logits(*gates, mask))
        return scores, text

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        windows, text = self.window_scores(Tokens(data, offsets))
        return np.maximum.reduceat(windows, np.searchsorted(text, np.arange(len(offsets) - 1)))

    # -- fitting -----------------------------------------------------------------------------------------------

    def _gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, word, gram) -> dict[str, np.ndarray]:
        """Of the mean log loss; x is (time, window, inputs), word and gram say which rows the embeddings came from."""
        p, h, keep = self.p, HIDDEN, {}
        gates = [np.ascontiguousarray((x @ p["x" + s] + p["b" + s]).transpose(0, 2, 1)) for s in "fb"]
        error = ((_sigmoid(self.logits(*gates, mask, keep)) - y) / len(y)).astype(np.float32)
        grad = {"bias": error.sum(keepdims=True), "out": keep["pooled"] @ error}
        pooled = p["out"][:, None] * error
        states, weight, key = keep["states"], keep["weight"], keep["key"]
        d_weight = np.einsum("tib,ib->tb", states, pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        grad["query"] = np.einsum("tjb,tb->j", key, d_score)
        d_key = d_score[:, None, :] * p["query"][:, None] * (1 - key * key)
        grad["att"] = np.matmul(states, d_key.transpose(0, 2, 1)).sum(0)
        d_states = weight[:, None, :] * pooled + p["att"] @ d_key
        d_x = np.zeros_like(x)
        for side, part in (("f", d_states[:, :h]), ("b", d_states[:, h:])):
            back, d_h, d_gates = np.zeros_like(part[0]), np.zeros_like(p["h" + side]), np.zeros((len(x), 3 * h, x.shape[1]), np.float32)
            for t, state, from_state, z, r, new in reversed(keep[side]):
                total = part[t] + back
                d_out = total * mask[t]
                d_new = d_out * (1 - z) * (1 - new * new)
                d_gates[t, :h] = d_out * (state - new) * z * (1 - z)
                d_gates[t, h : 2 * h] = d_new * from_state[2 * h :] * r * (1 - r)
                d_gates[t, 2 * h :] = d_new
                d_from = d_gates[t].copy()
                d_from[2 * h :] *= r
                d_h += state @ d_from.T
                back = np.where(mask[t], d_out * z + p["h" + side] @ d_from, total)
            grad["h" + side] = d_h
            grad["x" + side] = np.matmul(x.transpose(0, 2, 1), d_gates.transpose(0, 2, 1)).sum(0)
            grad["b" + side] = d_gates.sum((0, 2))
            d_x += (p["x" + side] @ d_gates).transpose(0, 2, 1)
        flat = d_x.reshape(-1, x.shape[2])
        grad["word"] = _scattered(word, flat[:, 3 : 3 + EMBEDDED])
        cell, rows, share = gram
        grad["gram"] = _scattered(rows, flat[cell, 3 + EMBEDDED :] * share[:, None])
        return grad

    def fit(self, texts: list[bytes], labels: np.ndarray, seed: int = 11) -> None:
        """Fit on whole texts: each teaches by its most suspicious window, and clean ones by another one too."""
        if len(set(labels.tolist())) < 2:
            return
        groups: list[tuple[Tokens, int]] = []  # texts of one label, some at a time
        for label in (0, 1):
            own = [t for t, y in zip(texts, labels) if y == label]
            data, offsets = np.frombuffer(b"".join(own), np.uint8), np.cumsum([0, *map(len, own)])
            groups += [(Tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), label) for a, b in pieces(offsets, 1 << 20)]
        for t, label in groups:
            for first, end in zip(t.bounds[:-1], t.bounds[1:]):
                kinds = np.unique(t.kind[first:end])
                self.words.add(np.unique(t.word[kinds] % WORD_BUCKETS), label)
                self.grams.add(np.unique(t.gram[_ranges(t.gram_bounds[kinds], t.gram_bounds[kinds + 1])] % GRAM_BUCKETS), label)
        features = [self.features(t, label) for t, label in groups]
        rng, moments, step = np.random.default_rng(seed), {}, 0
        for round_ in range(2):
            examples = []
            for g, (t, label) in enumerate(groups):
                first, size, text = t.windows()
                if round_ == 0:
                    suspicion = features[g][:, 0] + features[g][:, 1]
                    scores = np.array([suspicion[t.kind[a : a + n]].max(initial=-9) for a, n in zip(first, size)])
                else:
                    scores = self.window_scores(t, label)[0]
                order = np.lexsort((-scores, text))
                opens = np.searchsorted(text, np.arange(len(t.bounds) - 1))
                chosen = order[opens]  # windows of a text lie together, the highest first
                if not label:
                    counts = np.append(opens[1:], len(text)) - opens
                    chosen = np.unique(np.append(chosen, opens + rng.integers(counts)))
                examples += [(g, int(first[k]), int(size[k])) for k in chosen]
            self.fitted = True
            for _ in range(EPOCHS):
                for rows in np.array_split(rng.permutation(len(examples)), -(-len(examples) // BATCH)):
                    step += 1
                    self._step(self._batch([examples[r] for r in rows], groups, features), moments, step)

    def _batch(self, examples, groups, features):
        steps, n = max(1, max(e[2] for e in examples)), len(examples)
        x, mask = np.zeros((steps, n, 3 + 2 * EMBEDDED), np.float32), np.zeros((steps, n), bool)
        word, cells, rows, shares = np.zeros((steps, n), np.int64), [], [], []
        for b, (i, first, size) in enumerate(examples):
            t = groups[i][0]
            kinds = t.kind[first : first + size]
            x[:size, b, :3], mask[:size, b] = features[i][kinds], True
            word[:size, b] = t.word[kinds] % ROWS
            lengths = t.gram_bounds[kinds + 1] - t.gram_bounds[kinds]
            rows.append(t.gram[_ranges(t.gram_bounds[kinds], t.gram_bounds[kinds + 1])] % ROWS)
            cells.append(np.repeat(np.arange(size) * n + b, lengths))
            shares.append(np.repeat(1 / np.maximum(lengths, 1), lengths).astype(np.float32))
        cell, row, share = (np.concatenate(v) if v else np.empty(0, np.int64) for v in (cells, rows, shares))
        x[:, :, 3 : 3 + EMBEDDED] = self.p["word"][word] * mask[:, :, None]
        x[:, :, 3 + EMBEDDED :] = _scattered(cell, self.p["gram"][row] * share[:, None], steps * n).reshape(steps, n, EMBEDDED)
        return x, mask, np.array([groups[e[0]][1] for e in examples], np.float32), word.ravel(), (cell, row, share)

    def _step(self, batch, moments: dict, step: int) -> None:
        for name, g in self._gradients(*batch).items():
            m, v = moments.setdefault(name, (np.zeros_like(g), np.zeros_like(g)))
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            self.p[name] -= (RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        learn_from=None, per_class: int = PER_CLASS) -> bytes:
    """The fitted network. ``learn_from``: a condition on the label rows that may teach."""
    usable = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    usable = usable.filter(learn_from) if learn_from is not None else usable
    usable = usable.groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).alias("__label"))
    drawn = [usable.filter(F.col("__label") == c).orderBy(F.xxhash64("__id"), "__id").limit(per_class) for c in (0, 1)]
    sample = F.broadcast(drawn[0].union(drawn[1]))  # 2 * per_class rows at most
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(sample, "__id")
    # One text of each id, so that the sample is bounded also where ids repeat.
    texts = texts.groupBy("__id").agg(F.max("__label").alias("label"), F.max("text").alias("text"))

    def learn(batches):
        rows = [r for batch in batches for r in zip(*(batch.column(k).to_pylist() for k in range(3)))]
        rows.sort(key=lambda r: zlib.crc32(str(r[0]).encode()))
        network = Network()
        network.fit([(r[2] or "").encode() for r in rows], np.array([r[1] for r in rows], np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(network)], pa.binary())], ["network"])

    found = texts.select("__id", "label", "text").coalesce(1).mapInArrow(learn, "network binary").collect()
    return bytes(found[0].network) if found else pickle.dumps(Network())


def scored(docs: DataFrame, network: bytes, carry: list[str], text_col: str = "text", inside: str | None = None) -> DataFrame:
    """The carried columns and ``__score``. The text may lie ``inside`` one of them, which is a struct."""
    weights = docs.sparkSession.sparkContext.broadcast(network)
    schema = T.StructType([docs.schema[c] for c in carry] + [T.StructField("__score", T.DoubleType())])

    def score(batches):
        model = pickle.loads(weights.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(inside or text_col))
            data, offsets = text_bytes(pc.struct_field(column, text_col) if inside else column)
            out = [model.scores(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in pieces(offsets, 1 << 20)]
            found = pa.array(np.concatenate(out).astype(np.float64) if out else np.empty(0))
            carried = [batch.column(batch.schema.get_field_index(c)) for c in carry]
            yield pa.RecordBatch.from_arrays([*carried, found], [*carry, "__score"])
            del batch, column, carried, data
            give_back()

    return docs.select(*dict.fromkeys([*carry, *([] if inside else [text_col])])).mapInArrow(score, schema)


def held_out(id_col: str = "doc_id"):
    """The quarter of ids whose labels never teach."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    network = fit(docs, labels, text_col=text_col, learn_from=~held_out(), **options)
    whole = docs.select(F.struct("*").alias("whole"))  # the text goes to the workers once
    return scored(whole, network, ["whole"], text_col, inside="whole").filter(F.col("__score") < threshold).select("whole.*")


def op8_gated_recurrent(spark, d: str) -> DataFrame:
    docs = spark.read.parquet(f"{d}/documents.parquet")
    network = fit(docs, spark.read.parquet(f"{d}/labels.parquet"), learn_from=~held_out())
    return scored(docs, network, ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= THRESHOLD).cast("int").alias("predicted")
    )


QUERIES = {"op8_gated_recurrent": op8_gated_recurrent}
ORACLES: dict[str, str] = {}
