"""Importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from evenkeel.llm import resampling, slices

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets(text):
    w = WORD.findall(brute.fold(text))
    return len(w), [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def plain(docs, target):
    """(id, features, weight, score) and the drawn ids in order, of (id, text) pairs."""
    own, wanted = [(i, *buckets(t)) for i, t in docs], [buckets(t)[1] for t in target]
    s, t = Counter(b for *_, bs in own for b in bs), Counter(b for bs in wanted for b in bs)
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + 10000) / ((s[b] + 1) * (sum(t.values()) + 10000)))) for b in s}
    rows = []
    for i, _, bs in own:
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in bs) // len(bs) if bs else 0
        rows.append((i, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((-r[3], r[0] is not None, r[0]) for r, (_, n, _) in zip(rows, own) if n >= 20)
    return sorted(rows, key=str), [i for *_, i in able[: 25 * len(able) // 100]]


def answered(df):
    rows = df.collect()
    return sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in rows), key=str), [r.doc_id for r in sorted((r for r in rows if r["rank"]), key=lambda r: r["rank"])]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(12)
    out = [" ".join(f"w{int(rng.paretovariate(0.8)) % 900}" for _ in range(rng.randint(1, 120))) for _ in range(60)]
    out += out[:6] + [None, "", " .,; ", "One", "É ß İ x\x0by 'tis", "a" * 40000, "A b " * 9000]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def target():
    rng = random.Random(13)
    return [" ".join(f"W{rng.randint(1, 60)}" for _ in range(40)) for _ in range(10)] + [None, ""]


@pytest.mark.parametrize("share", [20_000, 50, 1])
def test_scores_and_ranks_match_brute_force(spark, texts, target, share, monkeypatch):
    """With any head, none included, the totals are the same."""
    monkeypatch.setattr(resampling, "HEAD_SHARE", share)
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in texts], SCHEMA).repartition(3)
    items = spark.createDataFrame([(str(k), t) for k, t in enumerate(target)], "item_id string, text string")
    found = answered(resampling.ranked(docs, items))
    assert found == plain(texts, target) and len(found[1]) > 5
    if share == 50:
        drawn = resampling.resample(docs, items)
        assert drawn.columns == docs.columns and sorted(r.doc_id for r in drawn.collect()) == sorted(found[1])


@pytest.mark.parametrize("limit", [1, 9, 1 << 20])
def test_features_do_not_depend_on_slices_or_head(texts, limit, monkeypatch):
    monkeypatch.setattr(resampling, "word_lists", lambda d, p: slices.word_lists(d, p, limit))
    for words, pairs in (([], []), ([b"w1", b"w2"], [(b"w1", b"w2"), (b"w1", b"w1")])):
        head = resampling.Vocabulary(words, pairs)
        for _, t in texts:
            found = list(head.features((t or "").encode().lower()))
            n, want = buckets(t)
            assert sum(k for k, _ in found) == n and sorted(b for _, bs in found for b in bs) == sorted(want)


def test_the_head_holds_what_is_frequent(spark, monkeypatch):
    monkeypatch.setattr(resampling, "COUNTED_WORDS", 100)
    monkeypatch.setattr(resampling, "HEAD_SHARE", 6)
    rows = [(f"the cat x{k} the cat",) for k in range(300)]
    words, pairs = resampling.frequent(spark.createDataFrame(rows, "text string").repartition(4))
    assert set(words) == {b"the", b"cat"} and pairs == [(b"the", b"cat")]
    assert (b"the", b"cat") in resampling.Vocabulary(words, pairs).pairs


def test_odd_rows(spark, target):
    long = " ".join(f"w{k % 7}" for k in range(30))
    rows = [(None, long, None, None, 1), (None, None, None, None, None), (3, long, None, "s", 2), (3, long, None, "s", 2), (5, long, None, "s", 2),
            *[(k, f"{long} {k}", None, None, None) for k in range(10, 20)]]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(None) for c in ("n_words", "weight", "score", "rank", "place", "bucket", "whole", "__own")})
    items = spark.createDataFrame([(t, 1) for t in target], "text string, bucket int")
    assert answered(resampling.ranked(docs, items)) == plain([(r[0], r[1]) for r in rows], target)
    assert resampling.ranked(docs.filter("false"), items).collect() == []
    assert resampling.resample(docs.filter("false"), items).columns == docs.columns
    assert answered(resampling.ranked(docs, items.filter("false"))) == plain([(r[0], r[1]) for r in rows], [])
