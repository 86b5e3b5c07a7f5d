"""Diffs by segments against the row-by-row diffs, and what they shuffle."""

import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from evenkeel import TableSpec, compare
from evenkeel.operators import keyed, multiset, segments

SCHEMA = "k long, name string, price double, at timestamp, tags array<int>, ok boolean"


def table(rng, n, keys):
    return [(next(keys), rng.choice(["a", "b", None]), rng.choice([0.0, -0.0, 1.5, float("nan"), None]), None, rng.choice([[1, 2], [2, 1], None]), rng.choice([True, None])) for _ in range(n)]


def damaged(rng, data, share):
    out = []
    for r in data:
        x = rng.random()
        if x < share / 3:
            continue
        out.append((r[0], "changed", *r[2:]) if x < share else r)
        if x > 1 - share / 5:
            out.append(r if x > 1 - share / 10 else (-5 - len(out), *r[1:]))
    return out


def settled(frame, keys):
    """Findings without the matches, and the number of those."""
    found = frame.collect()
    matched = [sum(r[f"n_{x}"] for r in found if r.diff_class == "match") for x in ("source", "target")]
    key = [r for r in found if r.diff_class != "match"]
    return sorted(((*[str(r[k]) for k in keys], r.n_source, r.n_target, r.diff_class) for r in key)), matched


@pytest.fixture(params=["whole", "small"])
def small(request, monkeypatch):
    """With small limits, segments are opened over several levels."""
    if request.param == "small":
        for limit, value in {"FIRST_BITS": 3, "MAX_SEGMENTS": 64, "LEAF_ROWS": 2, "PUSHED_RANGES": 2}.items():
            monkeypatch.setattr(segments, limit, value)


@pytest.mark.parametrize("kind, share", [("dense", 0), ("dense", 0.3), ("sparse", 0.004), ("extreme", 0.01), ("hot", 0), ("hot", 0.004), ("text", 0.004)])
def test_keyed_segments_find_what_pairs_find(spark, small, kind, share):
    rng = random.Random(f"{share}{kind}")
    keys = {
        "dense": lambda: iter(range(7, 10**6)), "sparse": lambda: iter(sorted(rng.sample(range(-(10**15), 10**15), 5000))),
        "extreme": lambda: iter([-(2**63), 2**63 - 1, None, None, 0, -1] + rng.sample(range(10**6), 5000)),
        "hot": lambda: iter(rng.choice([5, rng.randrange(10**4), None]) for _ in range(5000)), "text": lambda: iter(range(10**6)),
    }[kind]()
    source = table(rng, 600, keys)
    s, t = (spark.createDataFrame(x, SCHEMA).repartition(3) for x in (source, damaged(rng, source, share)))
    if kind == "text":
        s, t = (df.withColumn("k", F.concat(F.lit("key "), "k")) for df in (s, t))
    if kind == "dense":
        t = t.withColumn("k", F.col("k").cast("decimal(20,0)"))  # its common type with a bigint is no integer
    want = settled(keyed.condensed(keyed.hash_pairs(s, t, ["k"], s.columns), ["k"]), ["k"])
    assert settled(segments.keyed_segments(s, t, ["k"], s.columns), ["k"]) == want
    pair = ["k", "name"]
    assert settled(segments.keyed_segments(s, t, pair, s.columns), pair) == settled(keyed.condensed(keyed.hash_pairs(s, t, pair, s.columns), pair), pair)


@pytest.mark.parametrize("share", [0, 0.01])
def test_keyless_segments_find_what_buckets_find(spark, small, share):
    rng = random.Random(str(share))
    source = table(rng, 700, iter(rng.choice([3, rng.randrange(40)]) for _ in range(1000)))
    s, t = (spark.createDataFrame(x, SCHEMA).repartition(3) for x in (source, damaged(rng, source, share)))
    for form in ({}, {"decimals": 0, "round_decimals": True}):
        want = multiset.multiset_outcome(multiset.row_buckets(s, t, s.columns, **form), "hash_no_pk").first()
        found = segments.keyless_segments(s, t, s.columns, **form)
        assert multiset.multiset_outcome(found, "hash_no_pk").first() == want
        assert rows(found.filter("n_source <> n_target")) == rows(multiset.row_buckets(s, t, s.columns, **form).filter("n_source <> n_target"))


def test_empty_sides(spark):
    some = spark.createDataFrame([(1, "a", 1.0, None, None, None)], SCHEMA)
    none = some.filter("false")
    for s, t, status in ((none, none, "PASS"), (some, none, "FAIL"), (none, some, "FAIL")):
        for spec in (TableSpec("t", "hash", keys=("k",), by_segments=True), TableSpec("t", "hash_no_pk", by_segments=True)):
            assert compare(s, t, spec).outcome.first().raw_status == status


def test_samples_by_segments(spark):
    rng = random.Random(1)
    source = table(rng, 300, iter(range(10**6)))
    s, t = spark.createDataFrame(source, SCHEMA), spark.createDataFrame(damaged(rng, source, 0.1), SCHEMA)
    for mode in ("hash", "hash_no_pk"):
        plain, quick = (compare(s, t, TableSpec("t", mode, keys=("k",), by_segments=x), keep=True) for x in (False, True))
        assert rows(quick.outcome) == rows(plain.outcome) and rows(quick.samples) == rows(plain.samples)


def test_a_null_in_another_place_is_a_difference(spark):
    s = spark.createDataFrame([(1, "a", None)], "k long, x string, y string")
    t = spark.createDataFrame([(1, None, "a")], "k long, x string, y string")
    assert compare(s, t, TableSpec("t", "hash", keys=("k",), by_segments=True)).outcome.first().rows_with_mismatches == 1
    assert compare(s, t, TableSpec("t", "hash_no_pk", by_segments=True)).outcome.first().raw_status == "INCONCLUSIVE"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_equal_sides_shuffle_sums_only(spark, sf, monkeypatch):
    """Everything that is written for equal sides comes from a shuffle by segment; the diff of rows is left with none."""
    seen, keep = [], segments.snapshot
    monkeypatch.setattr(segments, "snapshot", lambda df, label: (seen.append((label, plan(df))), keep(df, label))[1])
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    segments.keyed_segments(orders, orders, ["o_orderkey"], orders.columns)
    for label, text in seen:
        if label in ("segments", "repeats"):
            assert set(re.findall(r"Exchange hashpartitioning\((\w+)#", text)) == {"segment"}, label
            assert "sha2" not in text and "to_json" not in text
    sums = next(text for label, text in seen if label == "segments")
    assert sums.count("Exchange") == 1 and "partial_sum" in sums and "Join" not in sums
    bitmaps = next(text for label, text in seen if label == "repeats")
    assert "bitmap_construct_agg" in bitmaps and "partial_bitmap_construct_agg" in bitmaps


def test_opened_ranges_reach_the_scan(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    changed = orders.withColumn("o_orderstatus", F.expr("if(o_orderkey BETWEEN 40 AND 42, 'x', o_orderstatus)"))
    found = segments.compare_segments(segments._keyed_sides(orders, changed, ["o_orderkey"], orders.columns, {}))
    text = plan(found.opened()[0])
    assert "GreaterThanOrEqual(o_orderkey" in text and "LessThanOrEqual(o_orderkey" in text
    assert 3 <= found.opened()[0].count() < 20
