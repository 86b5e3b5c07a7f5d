"""The registered corpus queries over whole small tables: against their SQL, or against plain Python."""

from collections import Counter

import brute
import duckdb
import pytest

from evenkeel.llm import packing, sanitise, toxicity, workload

TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


def multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(repr(r[i]) for i in order) for r in rows)


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in workload.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(workload.ORACLES))
def test_query_gives_what_its_sql_gives(spark, sf, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = workload.QUERIES[name](spark, sf)
    cursor = db.execute(workload.ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert multiset(df.columns, df.collect()) == multiset(names, cursor.fetchall())


def test_personal_data_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = sanitise.op10_disclosure(spark, sf).collect()
    assert len(found) == len(texts)
    for r in found:
        spans = brute.base_spans(texts[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == brute.sha(listed) and r.spans.startswith(listed)
        assert [r[f"n_{k}"] for k in sanitise.KINDS[:4]] == [sum(k == s[0] for s in spans) for k in sanitise.KINDS[:4]]


def test_packing_query_holds_all_words(spark, sf):
    texts = {r.doc_id: len(brute.words(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    words = Counter()
    for r in packing.op6_best_fit(spark, sf).collect():
        words[r.doc_id] += r.n_words
    assert words == Counter({i: n for i, n in texts.items() if n})


def test_toxicity_query_in_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = [r for r in toxicity.op8_gated_recurrent(spark, sf).collect()]
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in found)
    assert sum(p == y for p, y in held) / len(held) > 0.85
