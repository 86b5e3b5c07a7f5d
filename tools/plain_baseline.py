"""Time the plain way to do each comparison, next to this library's.

The plain way is what one writes first: an action per figure (nulls, counts, distinct keys), a full outer join
on the key, one count per class, ``exceptAll`` both ways, and collected samples.

    BENCH_SF_DIR=/root/testdata/sf0.1 python tools/plain_baseline.py
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from check_oracles import session  # noqa: E402

from evenkeel import TableSpec, compare  # noqa: E402
from evenkeel.functions.canonical import canonical_rows, with_row_hash  # noqa: E402
from workload.inputs import load, orders_pair  # noqa: E402


def plain_keyed(source, target, key, changed):
    for side in (source, target):
        side.filter(F.col(key).isNull()).count()
        side.count()
        side.select(key).distinct().count()
    both = source.alias("s").join(target.alias("t"), F.col(f"s.{key}") == F.col(f"t.{key}"), "full_outer")
    classes = [F.col(f"s.{key}").isNull(), F.col(f"t.{key}").isNull(), F.col(f"s.{key}").isNotNull() & F.col(f"t.{key}").isNotNull() & changed]
    sizes = [source.count(), target.count(), *[both.filter(c).count() for c in classes]]
    for c, n in zip(classes, sizes[2:], strict=True):
        if n:
            both.filter(c).select(f"s.{key}").limit(1000).collect()
    return sizes


def plain_hash(source, target):
    sides = [with_row_hash(df, df.columns, ["o_orderkey"]).select("o_orderkey", "row_hash") for df in (source, target)]
    return plain_keyed(*sides, "o_orderkey", F.col("s.row_hash") != F.col("t.row_hash"))


def plain_advanced(source, target):
    changed = F.lit(False)
    for c in source.columns[1:]:
        a, b = F.col(f"s.{c}"), F.col(f"t.{c}")
        near = a.eqNullSafe(b) | (F.abs(a - b) <= 0.001) if c == "o_totalprice" else a.eqNullSafe(b)
        changed = changed | ~near
    return plain_keyed(source, target, "o_orderkey", changed)


def plain_multiset(source, target):
    hashed = [with_row_hash(df, df.columns).cache() for df in (source, target)]
    sizes = [h.count() for h in hashed]
    counted = [h.groupBy("row_hash").count().withColumnRenamed("count", n) for h, n in zip(hashed, ("a", "b"), strict=True)]
    diff = counted[0].join(counted[1], "row_hash", "full_outer").fillna(0, ["a", "b"]).filter("a <> b").cache()
    sizes += list(diff.agg(F.sum(F.greatest(F.col("a") - F.col("b"), F.lit(0))), F.sum(F.greatest(F.col("b") - F.col("a"), F.lit(0)))).first())
    hashes = [r[0] for r in diff.limit(1000).collect()]
    for h in hashed:
        h.filter(F.col("row_hash").isin(hashes)).dropDuplicates(["row_hash"]).collect()
        h.unpersist()
    diff.unpersist()
    return sizes


def plain_rows(source, target):
    sides = [canonical_rows(df, df.columns, decimals=3, decimal_as_double=True).cache() for df in (source, target)]
    sizes = [s.count() for s in sides]
    for a, b in (sides, sides[::-1]):
        lone = a.exceptAll(b).cache()
        sizes.append(lone.count())
        lone.groupBy(*lone.columns).count().limit(500).collect()
        lone.unpersist()
    for s in sides:
        s.unpersist()
    return sizes


def ours(spec):
    def run(source, target):
        check = compare(source, target, spec, keep=True)
        row = check.outcome.first()
        check.samples.collect()
        return [row.source_count, row.target_count, row.rows_only_in_source, row.rows_only_in_target]

    return run


def main():
    spark, folder = session(), os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    lines = load(spark, folder, "lineitem")
    changed = lines.withColumn("l_quantity", F.expr("if(l_orderkey % 500 = 3, l_quantity + 100, l_quantity)"))
    orders, key = orders_pair(spark, folder), ("o_orderkey",)
    big = 2_000_000_000
    cases = {
        "hash, orders": (orders, plain_hash, TableSpec("x", "hash", keys=key)),
        "advanced, orders": (orders, plain_advanced, TableSpec("x", "advanced", keys=key)),
        "hash_no_pk, lineitem": ((lines, changed), plain_multiset, TableSpec("x", "hash_no_pk")),
        "advanced_no_pk, lineitem": ((lines, changed), plain_rows, TableSpec("x", "advanced_no_pk")),
    }
    out = {}
    for name, (pair, plain, spec) in cases.items():
        taken = {}
        for label, run in (("plain", plain), ("ours", ours(spec))):
            seconds = []
            for _ in range(4):
                began = time.perf_counter()
                run(*pair)
                seconds.append(time.perf_counter() - began)
            taken[label] = round(statistics.median(seconds[1:]), 2)
        out[name] = taken
        print(name, taken, flush=True)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
