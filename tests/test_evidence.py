"""Evidence behind a filter, and pairs of surplus rows."""

import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from evenkeel.operators import keyed, multiset, pairing, sieve


@pytest.fixture(scope="module")
def pair(spark):
    s = spark.range(6000).selectExpr("id AS k", "CAST(id % 7 AS STRING) AS a", "id % 50 AS b").repartition(4)
    return s, s.withColumn("a", F.expr("if(k % 20 = 3, 'changed', a)")).filter("k % 100 <> 9")


@pytest.mark.parametrize("at_once", [1 << 24, 50])
def test_filtered_evidence_is_the_same(spark, pair, at_once, monkeypatch):
    """In one pass and in several."""
    monkeypatch.setattr(sieve, "KEYS_AT_ONCE", at_once)
    columns = pair[0].columns
    for of in (multiset.bucket_samples, multiset.excess_rows):
        assert rows(of(*pair, columns, broadcast_bytes=0)) == rows(of(*pair, columns))
    plain, quick = (keyed.column_findings(*pair, ["k"], columns, 0.0, broadcast_bytes=b) for b in (1 << 20, 0))
    assert rows(quick.withColumn("diffs", F.to_json("diffs"))) == rows(plain.withColumn("diffs", F.to_json("diffs")))


@pytest.mark.parametrize("n, share", [(0, 0), (10, 0.05), (5000, 0.05), (200_000, 0.05)])
def test_all_keys_and_few_others_pass(spark, n, share):
    df = spark.range(1_000_000).selectExpr("id AS x")
    got = sieve.sieved(df, "x", df.filter(f"x < {n}"), "x", n)
    assert got.columns == ["x"] and got.filter(f"x < {n}").count() == n
    assert got.filter(f"x >= {n}").count() <= share * (1_000_000 - n)


def test_a_crowded_filter_still_bounds_the_share(spark, monkeypatch):
    monkeypatch.setattr(sieve, "BLOCKS", 1000)
    df = spark.range(400_000).selectExpr("id AS x")
    for n, share in ((8_000, 0.06), (16_000, 0.2)):
        assert sieve.sieved(df, "x", df.filter(f"x < {n}"), "x", n).filter(f"x >= {n}").count() <= share * 400_000


def test_the_filter_is_applied_before_the_shuffle(spark, sf):
    """Without a bound on broadcasts every row of both sides would be shuffled by digest."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    changed = lines.withColumn("l_tax", F.expr("if(l_orderkey % 90 = 1, l_tax + 1, l_tax)"))
    text = multiset.bucket_samples(lines, changed, lines.columns, broadcast_bytes=0)._jdf.queryExecution().executedPlan().toString()
    assert text.count("__bits") > 2 and "BroadcastHashJoin [__block" in text
    # from the top down: the exact join by digest, its exchange, and below that the filter
    assert re.search(r"Join \[__digest.*Exchange hashpartitioning\(__digest.*__block", text, re.S) or re.search(r"BroadcastHashJoin \[__digest.*__block", text, re.S)


def test_evidence_that_is_gone_is_reported(spark, pair):
    s, t = pair
    found = multiset.condensed(multiset.row_buckets(s, t, s.columns))
    from evenkeel.sources.tables import snapshot

    buckets = snapshot(found, "buckets")
    gone = multiset.bucket_samples(s.filter("k % 20 <> 3"), t.filter("k % 20 <> 3"), s.columns, buckets=buckets)
    want = multiset.bucket_samples(s, t, s.columns)
    assert gone.count() == want.count()
    assert gone.filter("pk_values = 'row changed during the comparison'").count() == 2 * 300


# --- pairs -----------------------------------------------------------------------------------------

def totals(df):
    out = {}
    for r in df.collect():
        key = (r.change, r.column_name, r.source_value, r.target_value)
        out[key] = out.get(key, 0) + r.n_rows
    return out


@pytest.mark.parametrize("lane", [100_000, 2])
def test_pairs_name_the_changed_column(spark, lane, monkeypatch):
    monkeypatch.setattr(pairing, "LANE_ROWS", lane)
    s = spark.createDataFrame([("a", 1, 1.0)] * 5 + [("b", 2, 2.0)] * 3 + [("c", 3, None), ("d", 4, 4.0), ("e", 5, 5.0)], "x string, y int, z double")
    t = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 7.0), ("a", 1, 7.0), ("a", 1, 8.0), ("b2", 2, 2.0), ("c", 3, 3.0), ("d", 40, 40.0), ("e", 5, 5.0), ("f", 6, 6.0)],
                              "x string, y int, z double")
    assert totals(pairing.pair_changes(s, t, s.columns)) == {
        ("changed", "z", "1.0", "7.0"): 2, ("changed", "z", "1.0", "8.0"): 1, ("changed", "x", "b", "b2"): 1, ("changed", "z", None, "3.0"): 1,
        ("only_in_source", None, None, None): 1 + 2 + 1, ("only_in_target", None, None, None): 2,
    }


def test_pairs_are_one_to_one_and_none_is_left_that_could_be_paired(spark):
    rng = random.Random(4)
    make = lambda n: [(rng.choice("ab"), rng.randrange(3), rng.choice([None, 0.5])) for _ in range(n)]
    source, target = make(60), make(50)
    s, t = (spark.createDataFrame(x, "x string, y int, z double").repartition(3) for x in (source, target))
    found = pairing.pair_changes(s, t, s.columns).collect()
    extra = {k: source.count(k) - target.count(k) for k in set(source + target)}
    taken = {"s": sum(r.n_rows for r in found if r.change != "only_in_target"), "t": sum(r.n_rows for r in found if r.change != "only_in_source")}
    assert taken == {"s": sum(n for n in extra.values() if n > 0), "t": -sum(n for n in extra.values() if n < 0)}
    import json

    lone = {side: [tuple(json.loads(r.row).get(c) for c in "xyz") for r in found if r.change == f"only_in_{side}"] for side in ("source", "target")}
    assert not any(sum(u != v for u, v in zip(a, b)) == 1 for a in lone["source"] for b in lone["target"])


def test_one_column_and_nothing_to_pair(spark):
    s = spark.createDataFrame([("a",), ("b",), ("b",)], "x string")
    t = spark.createDataFrame([("c",), ("b",)], "x string")
    assert totals(pairing.pair_changes(s, t, ["x"])) == {("changed", "x", "a", "c"): 1, ("only_in_source", None, None, None): 1}
    assert pairing.pair_changes(s, s, ["x"]).collect() == []


def test_rows_without_a_partner_are_not_tried_again(spark, monkeypatch):
    """One pair among many lone rows: one round finds it, and no other is made for rows that have no choice."""
    seen = []
    monkeypatch.setattr(pairing, "_choices", lambda rows, *more, keep=pairing._choices: (seen.append(rows.count()), keep(rows, *more))[1])
    s = spark.range(50).selectExpr("id AS x", "concat('s', id) AS y")
    t = s.selectExpr("x + if(x > 0, 100, 0) AS x", "replace(y, 's', 't') AS y")
    found = totals(pairing.pair_changes(s, t, s.columns))
    assert found == {("changed", "y", "s0", "t0"): 1, ("only_in_source", None, None, None): 49, ("only_in_target", None, None, None): 49}
    assert seen == [100]
