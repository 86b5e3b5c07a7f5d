"""One source against many copies, against the copies one by one."""

import random
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from evenkeel import TableSpec, compare
from evenkeel.operators import keyed, many, multiset
from evenkeel.plans.compare import TablePair, compare_many, run_tables
from evenkeel.sources.tables import scratch_path

SCHEMA = "k long, part string, v double, tags array<int>"


def table(rng, n, twice):
    keys = [rng.randrange(n) if twice else k for k in range(n)]
    return [(None if rng.random() < twice / 20 else k, rng.choice(["a", None]), rng.choice([0.5, 1.5, None]), rng.choice([[1], None])) for k in keys]


def damaged(rng, data):
    out = [r for r in data if rng.random() > 0.05]
    out = [(r[0], "x", *r[2:]) if rng.random() < 0.05 else r for r in out]
    return out + [(-1 - k, "new", None, None) for k in range(rng.randrange(3))] + out[: rng.randrange(2) * 2]


@pytest.mark.parametrize("twice", [0, 1])
def test_keyed_copies(spark, twice):
    rng = random.Random(twice)
    data = table(rng, 200, twice)
    source = spark.createDataFrame(data, SCHEMA).repartition(3)
    copies = {f"c{i}": spark.createDataFrame(damaged(rng, data), SCHEMA) for i in range(5)} | {"same": source, "none": source.filter("false")}
    for keys in (["k"], ["k", "part"]):
        found = many.keyed_many(source, copies, keys, source.columns)
        for name, target in copies.items():
            want = keyed.condensed(keyed.hash_pairs(source, target, keys, source.columns), keys)
            assert rows(found[name].select(*want.columns)) == rows(want), (keys, name)


def test_keyless_copies(spark, monkeypatch):
    monkeypatch.setattr(many, "MOST_KEYLESS", 3)
    rng = random.Random(5)
    data = table(rng, 150, 1) * 2
    source = spark.createDataFrame(data, SCHEMA).repartition(3)
    copies = {f"c{i}": spark.createDataFrame(damaged(rng, data), SCHEMA) for i in range(5)} | {"same": source, "none": source.filter("false")}
    found = many.keyless_many(source, copies, source.columns)
    for name, target in copies.items():
        want = multiset.condensed(multiset.row_buckets(source, target, source.columns))
        assert rows(found[name]) == rows(want), name


def test_the_source_is_read_once(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    copies = {str(i): spark.read.parquet(f"{sf}/orders.parquet").filter(f"o_orderkey % {i} <> 0") for i in (3, 5, 7)}
    seen, keep = [], many.snapshot
    with pytest.MonkeyPatch.context() as m:
        m.setattr(many, "snapshot", lambda df, label: (seen.append(df._jdf.queryExecution().executedPlan().toString()), keep(df, label))[1])
        many.keyed_many(orders, copies, ["o_orderkey"], orders.columns)
    assert seen[0].count("FileScan") == 4 and "Join" not in seen[0] and "partial_bit_or" in seen[0]


def test_copies_that_cannot_go_together_are_left_out(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    wide = source.withColumn("k", F.col("k").cast("decimal(20,0)"))
    spec = TableSpec("t", "hash", keys=("k",))
    found = compare_many(source, {
        "one": (source, spec), "two": (source.filter("k = 1"), spec), "types": (wide, spec), "drift": (source.drop("v"), spec),
        "alone": (source, TableSpec("t", "basic")), "mode": (source, TableSpec("t", "what")), "advanced": (source, TableSpec("t", "advanced", keys=("k",))),
    })
    assert sorted(found) == ["one", "two"]
    assert found["two"].outcome.first() == compare(source, source.filter("k = 1"), spec).outcome.first()
    assert rows(found["two"].samples) == rows(compare(source, source.filter("k = 1"), spec).samples)


@pytest.mark.parametrize("mode", ["hash", "advanced", "hash_no_pk"])
def test_times_without_a_zone_go_together(spark, mode):
    """They are compared as times with a zone, which is no reason to compare each copy alone; as keys, too."""
    source = spark.range(40).selectExpr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + id * INTERVAL 1 HOUR AS at", "id % 7 AS k", "CAST(id AS STRING) AS v")
    copies = {"same": source, "lost": source.filter("k <> 3"), "changed": source.withColumn("v", F.expr("if(k = 2, 'x', v)"))}
    spec = TableSpec("t", mode, keys=() if "no_pk" in mode else ("at", "k"))
    found = compare_many(source, {n: (t, spec) for n, t in copies.items()})
    assert set(found) == set(copies)
    for n, target in copies.items():
        alone = compare(source, target, spec)
        assert found[n].outcome.first() == alone.outcome.first() and rows(found[n].samples) == rows(alone.samples), n


def test_a_later_group_leaves_the_evidence_of_an_earlier_one_alone(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k long, v string")
    specs = {"all": TableSpec("t", "hash_no_pk"), "some": TableSpec("t", "hash_no_pk", skip=("v",))}
    copies = {f"{n}{i}": (source.filter(f"k <> {i}"), spec) for n, spec in specs.items() for i in (1, 2)}
    found = compare_many(source, copies)
    for n, (target, spec) in copies.items():
        assert rows(found[n].samples) == rows(compare(source, target, spec).samples), n


@pytest.mark.parametrize("mode", ["hash", "advanced", "hash_no_pk"])
def test_runs_give_the_same_with_and_without(spark, sf, mode):
    now = datetime(2024, 2, 1)
    read = lambda: spark.read.parquet(f"{sf}/events.parquet")
    targets = {"same": read, "lost": lambda: read().filter("event_id % 9 <> 0"), "changed": lambda: read().withColumn("value", F.expr("if(event_id % 7 = 1, value + 1, value)")),
               "drift": lambda: read().drop("props"), "broken": lambda: spark.read.parquet(f"{sf}/absent")}
    kept = []
    for shared in (None, "events"):
        spec = lambda n: TableSpec(n, mode, keys=() if "no_pk" in mode else ("event_id",), filter_column="ts", filter_days=60)
        pairs = [TablePair(spec(n), read, target, shared) for n, target in targets.items()]
        out = scratch_path(spark, "run")
        results = run_tables(spark, pairs, "r", now, f"{out}/results", f"{out}/samples")
        kept.append((rows(results.drop("duration_seconds")), rows(spark.read.parquet(f"{out}/samples"))))
    assert kept[0] == kept[1]
    assert {r[1] for r in kept[0][0]} == set(targets)
