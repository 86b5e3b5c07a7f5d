"""The stages of the corpus pipeline on a small table with planted cases."""

import random

import corpus_pipeline
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, path = random.Random(4), str(tmp_path_factory.mktemp("tables"))
    prose = lambda n: " ".join(f"t{rng.randrange(5000)}" for _ in range(n))
    test = prose(30)
    rows = [(i, prose(100)) for i in range(200)]
    rows += [(200 + i, rows[i][1] + " nasty" + rng.choice("abc")) for i in range(0, 60)]
    rows += [(300 + i, rows[100 + i][1]) for i in range(10)]
    rows += [(320 + i, rows[120 + i][1] + " more words") for i in range(10)]
    rows += [(340 + i, prose(40) + " " + test) for i in range(10)] + [(400, None), (401, ""), (402, ""), (None, "no id")]
    spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 5}", None) for i, t in rows], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, test)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(i, 1, int(200 <= i < 260)) for i, _ in rows if i is not None and i < 260]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_keep_what_is_clean(spark, folder):
    docs = first = spark.read.parquet(f"{folder}/documents.parquet").persist()
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).persist()
        assert docs.columns == first.columns and docs.exceptAll(first).isEmpty(), name
        kept.append({r.doc_id for r in docs.collect()})
    toxic, exact, near, clean = kept
    assert len([i for i in toxic if i and 200 <= i < 260]) <= 3 and len(set(range(200)) - toxic) <= 3
    assert not exact & set(range(100, 110)) and set(range(300, 310)) <= exact | (set(range(300, 310)) - toxic)
    assert len({400, 401, 402} & exact) == 1 and None in exact
    assert not near & set(range(320, 330)) and toxic & set(range(120, 130)) <= near
    assert not clean & set(range(340, 350)) and near - set(range(340, 350)) == clean
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in last.select("doc_id").collect()} == {r.doc_id for r in docs.filter("length(text) > 0").collect()}


def test_run_and_empty_tables(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 150
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_are_linked_by_five_words_from_four_fifths(spark):
    """Two changed words of 100: 86 of 106 runs of five words are shared (0.81), but 92 of 104 of three (0.88)."""
    words = [f"u{k}" for k in range(100)]
    near = ["x" if k in (30, 60) else w for k, w in enumerate(words)]
    far = ["y" if k in (20, 40, 60) else w for k, w in enumerate(words)]  # 81 of 111, 0.73
    docs = spark.createDataFrame([(i, " ".join(w), "en", "s", None) for i, w in enumerate((words, near, far))], SCHEMA)
    assert {r.doc_id for r in corpus_pipeline.without_near_copies(spark, docs, "").collect()} == {0, 2}
