"""Fingerprints and the trie join against plain Python."""

import random

import brute
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from evenkeel.llm import simhash, slices

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_print(text, length=4):
    words = [w.encode() for w in brute.words(brute.fold(text))]
    grams = [b" ".join(words[k : k + length]) for k in range(len(words) - length + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(docs, budget=4):
    """Sorted (id, fingerprint, smallest id within reach) of (id, text) pairs."""
    prints = [(i, plain_print(t)) for i, t in docs]
    distinct = sorted({p for _, p in prints})
    label = {p: p for p in distinct}
    for k, p in enumerate(distinct):
        for q in distinct[k + 1 :]:
            if (p ^ q).bit_count() <= budget and label[p] != label[q]:
                old, new = label[q], label[p]
                label = {x: new if y == old else y for x, y in label.items()}
    least = {}
    for i, p in prints:
        if i is not None:
            least[label[p]] = min(i, least.get(label[p], i))
    return sorted(((i, f"{p:016x}", least.get(label[p])) for i, p in prints), key=str)


def answered(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    base = [" ".join(f"w{int(rng.paretovariate(0.8)) % 300}" for _ in range(rng.randint(30, 200))) for _ in range(40)]
    out = base + base[:5] + [None, "", " \t\n", "one", "ONE", "two words", "three words now", "four words right now", "É ß x\x0by", "z" * 30000]
    for t in base[:20]:
        for _ in range(3):
            w = t.split()
            w[rng.randrange(len(w))] = "changed"
            out.append(" ".join(w))
    return list(enumerate(out))


@pytest.mark.parametrize("leaves", [1 << 17, 3])
def test_components_match_brute_force(spark, texts, leaves, monkeypatch):
    monkeypatch.setattr(simhash, "TRIE_LEAVES", leaves)
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in texts], SCHEMA).repartition(3)
    want = plain_components(texts)
    assert answered(simhash.near_duplicates(docs)) == want
    assert 1 < sum(c != i for i, _, c in want) < len(want)


@pytest.mark.parametrize("limit", [1, 7, 100])
def test_slices_do_not_change_words_or_prints(texts, limit, monkeypatch):
    for _, t in texts:
        data = (t or "").encode().lower()
        assert [w for ws in slices.word_lists(data, slices.SPACED, limit) for w in ws] == slices.SPACED.findall(data)
        with monkeypatch.context() as m:
            m.setattr(simhash, "word_lists", lambda d, p: slices.word_lists(d, p, limit))
            assert simhash.fingerprint(data) == plain_print(t)


def whole(n):
    return tuple(np.array([e]) for e in (0, n, 0, n, 0))


@pytest.mark.parametrize("frontier", [1 << 20, 64])
@pytest.mark.parametrize("budget", [0, 1, 4, 9])
def test_the_walk_finds_every_pair(budget, frontier, monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", frontier)
    rng = np.random.default_rng(5)
    keys = [int(k) for k in rng.integers(0, 2**63, 60)] + [0, 1, 2**64 - 1, 2**63]
    keys += [k ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 8), replace=False)) for k in keys for _ in range(3)]
    keys = np.unique(np.array(keys, np.uint64))
    got = [tuple(sorted(p)) for u, v in simhash.close_pairs(simhash.Trie(keys), whole(len(keys)), 0, budget) for p in zip(u.tolist(), v.tolist())]
    want = {(i, j) for i in range(len(keys)) for j in range(i + 1, len(keys)) if (int(keys[i]) ^ int(keys[j])).bit_count() <= budget}
    assert set(got) == want


def test_a_dense_group_gives_a_forest(spark):
    """Thousands of fingerprints that all link: rows in proportion to their number, not to their pairs."""
    prints = spark.range(4096).select((F.col("id") * 16 + 5).alias("fingerprint"))
    links = simhash.trie_links(prints, 4)
    assert 4095 <= links.count() <= 5 * 4095
    from evenkeel.llm.components import components

    assert components(links).select("label").distinct().count() == 1


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "a null id", None, None, 1), (3, "a null id", None, "s", 2), (3, "a null id", None, "s", 2),
            (9, "", None, None, None), (7, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(None) for c in ("fingerprint", "least", "label", "block", "node", "component_id", "value")})
    assert answered(simhash.near_duplicates(docs)) == plain_components([(r[0], r[1]) for r in rows])
    alone = simhash.near_duplicates(docs.filter("doc_id IS NULL AND text IS NOT NULL")).first()
    assert alone.component_id is None
    assert simhash.near_duplicates(docs.filter("false")).collect() == []


def test_query(spark, sf):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert answered(simhash.op11_trie_join(spark, sf)) == plain_components(texts)
