"""Keyless matching under a tolerance against a plain largest matching."""

import random
from decimal import Decimal

import pytest
from conftest import rows

from evenkeel import TableSpec, compare
from evenkeel.operators import multiset, tolerant


def largest(source, target, close):
    """Pairs in a largest matching, row by row."""
    owner = {}

    def place(i, seen):
        for j, t in enumerate(target):
            if j not in seen and close(source[i], t):
                seen.add(j)
                if j not in owner or place(owner[j], seen):
                    owner[j] = i
                    return True
        return False

    return sum(place(i, set()) for i in range(len(source)))


def close(kinds, tolerance):
    def near(a, b):
        for k, x, y in zip(kinds, a, b):
            if k == "text" or x is None or y is None:
                same = x == y
            elif k == "float":
                same = (x != x and y != y) or x == y or abs(x - y) <= tolerance
            else:
                same = abs(x - y) <= Decimal(repr(tolerance))
            if not same:
                return False
        return True

    return near


def matched(spark, source, target, schema, tolerance, partitions=3):
    s, t = (spark.createDataFrame(x, schema).repartition(partitions) for x in (source, target))
    s, t = tolerant.aligned(s, t, s.columns)
    found = tolerant.tolerant_buckets(s, t, s.columns, tolerance).collect()
    lone = [r for r in found if r["__digest"] is not None]
    assert sum(r.n_source for r in found) == len(source) and sum(r.n_target for r in found) == len(target)
    assert all(r.n_source >= 0 and r.n_target >= 0 and r.n_source + r.n_target for r in lone)
    return len(source) - sum(r.n_source for r in lone), len(target) - sum(r.n_target for r in lone)


def moved(rng, data, step):
    out = []
    for r in data:
        x = rng.random()
        if x > 0.1:
            out.append(tuple(v + type(v)(rng.choice([0, 0, 1, -1, 2])) * step if x < 0.5 and isinstance(v, (float, Decimal)) and v == v else v for v in r))
        if x > 0.95:
            out.append(r)
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("cell", [256, 2])
@pytest.mark.parametrize("spread", [8, 40])
def test_one_column(spark, cell, spread, monkeypatch):
    """Chains of close values, copies, nulls, NaN and infinities; with narrow cells chains run through many of them."""
    monkeypatch.setattr(tolerant, "CELL", cell)
    rng = random.Random(spread)
    value = lambda: rng.choice([None, float("nan"), float("inf"), *[rng.randrange(spread) * 0.25] * 12])
    source = [(rng.choice("ab"), value()) for _ in range(60)]
    target = moved(rng, source, 0.25)
    want = largest(source, target, close(("text", "float"), 0.25))
    assert matched(spark, source, target, "name string, v double", 0.25) == (want, want)


@pytest.mark.parametrize("seed", [1, 2])
def test_several_columns(spark, seed):
    rng = random.Random(seed)
    source = [(rng.choice("ab"), rng.randrange(6) * 0.5, Decimal(rng.randrange(5)) / 2, rng.choice([None, 1.0, 1.5])) for _ in range(50)]
    target = moved(rng, [(a, b, c, d) for a, b, c, d in source], 0)
    target = [(a, b + rng.choice([0, 0.5, -0.5, 1]), c + rng.choice([0, Decimal("0.5")]), d) for a, b, c, d in target]
    want = largest(source, target, close(("text", "float", "decimal", "float"), 0.5))
    assert matched(spark, source, target, "name string, v double, w decimal(12,3), x double", 0.5) == (want, want)


def test_augmenting_paths_alone():
    rng = random.Random(9)
    for _ in range(60):
        points = sorted({(rng.randrange(5), rng.randrange(5)) for _ in range(9)})
        data = [(p, rng.randrange(3), rng.randrange(3), k) for k, p in enumerate(points)]
        source, target = ([p for p, *n, _ in data for _ in range(n[k])] for k in (0, 1))
        want = largest(source, target, lambda a, b: abs(a[0] - b[0]) <= 1 and abs(a[1] - b[1]) <= 2)
        left = list(tolerant.by_paths(data, [1, 2]))
        assert len(source) - sum(s for _, s, _ in left) == want == len(target) - sum(t for *_, t in left)


def test_decimals_that_doubles_confuse(spark):
    base = 9007199254740992
    source = [("a", Decimal(base + k)) for k in (0, 3, 5)]
    target = [("a", Decimal(base + k)) for k in (1, 4, 9)]
    assert matched(spark, source, target, "name string, v decimal(38,0)", 1.0) == (2, 2)


def test_rounding_edges_do_not_matter(spark):
    s, t = (spark.createDataFrame([("a", v)], "name string, v double") for v in (0.0004999, 0.0005001))
    assert compare(s, t, TableSpec("t", "advanced_no_pk", tolerance=0.001)).outcome.first().raw_status == "PASS"
    t = spark.createDataFrame([("a", 0.0016)], "name string, v double")
    found = compare(s, t, TableSpec("t", "advanced_no_pk", tolerance=0.001), keep=True)
    assert found.outcome.first().raw_status == "INCONCLUSIVE"
    assert [(r.mismatch_type, r.pk_values, r.source_value, r.target_value) for r in found.samples.orderBy("mismatch_type").collect()] == [
        ("only_in_source_no_pk", '{"name":"a","v":"4.999E-4"}', "1", "0"), ("only_in_target_no_pk", '{"name":"a","v":"0.0016"}', "0", "1")]


def test_a_pair_is_given_up_where_that_matches_more(spark):
    """0 is on both sides, but two pairs need it apart."""
    assert matched(spark, [(0.0,), (-1.0,)], [(0.0,), (1.0,)], "v double", 1.0) == (2, 2)


def test_hot_values_are_counted(spark):
    s = spark.range(200_000).selectExpr("'a' AS name", "1.0D AS v").unionByName(spark.range(3).selectExpr("'b' AS name", "CAST(id AS DOUBLE) AS v"))
    t = spark.range(199_990).selectExpr("'a' AS name", "1.0005D AS v").unionByName(spark.range(3).selectExpr("'b' AS name", "id + 0.0005D AS v"))
    found = rows(tolerant.tolerant_buckets(s, t, s.columns, 0.001).filter("__digest IS NOT NULL").select("n_source", "n_target"))
    assert found == [(10, 0)]


def test_without_tolerant_columns_and_empty_sides(spark):
    s = spark.createDataFrame([("a", 1), ("b", 2)], "name string, n long")
    for t in (s, s.filter("n = 1"), s.filter("false")):
        buckets = tolerant.tolerant_buckets(s, t, s.columns, 0.001)
        want = multiset.multiset_outcome(multiset.row_buckets(s, t, s.columns), "x").first()
        assert multiset.multiset_outcome(buckets, "x").first() == want
    v = s.selectExpr("name", "CAST(n AS DOUBLE) AS n")
    assert rows(tolerant.tolerant_buckets(v, v.filter("false"), v.columns, 0.5).selectExpr("n_source", "n_target")) == [(0, 0), (1, 0), (1, 0)]


def test_chains_are_whole_where_leading_numbers_tie(spark):
    """Many rows with one leading number and different others, over several ranges."""
    s = spark.range(3000).selectExpr("CAST(id DIV 3 AS STRING) AS name", "0.5D AS a", "id * 10.0D AS b").repartition(5)
    t = s.selectExpr("name", "a", "b + 0.0005D AS b")
    assert rows(tolerant.tolerant_buckets(s, t, s.columns, 0.001)) == [(None, 3000, 3000)]


def test_what_must_agree_is_hashed_once_a_side(spark):
    """A cell is of rows that agree in it, so the digest of a row in a cell needs its numbers alone."""
    s = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "name string, v double")
    t = spark.createDataFrame([("a", 1.0), ("c", 1.0)], "name string, v double")
    text = tolerant._open_cells(s, t, tolerant._form_of(s, ["name", "v"], ["v"], 0.001, {}, False))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("isnull(name#") == 2
    assert matched(spark, [("a", 1.0), ("b", 1.0)], [("a", 1.0), ("c", 1.0)], "name string, v double", 0.001) == (1, 1)


@pytest.mark.parametrize("broadcast", [True, False])
def test_rows_that_all_match_are_not_written(spark, monkeypatch, broadcast):
    """Rows that all moved by less than the tolerance, but for a few: only those few are looked at one by one."""
    seen = []
    monkeypatch.setattr(tolerant, "snapshot", lambda df, label="snapshot", keep=tolerant.snapshot: (seen.append((label, out := keep(df, label), out.count())), out)[1])
    if not broadcast:
        monkeypatch.setattr(multiset, "_BROADCAST_BYTES", 0)
    s = spark.range(4000).selectExpr("id", "id % 11 / 100D AS a", "id + 0.0004999D AS b")
    t = s.selectExpr("id", "a", "b + if(id % 400 = 3, 0.002D, 0.0000002D) AS b")
    found = tolerant.tolerant_buckets(s, t, s.columns, 0.001)
    assert sorted(r[1:] for r in found.collect()) == [(0, 1)] * 10 + [(1, 0)] * 10 + [(3990, 3990)]
    assert {"opened", "chains"} <= {label for label, *_ in seen} and all(n <= 100 for *_, n in seen)
