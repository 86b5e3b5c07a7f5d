"""Merges, copies and schema evolution of stored tables, with crashes in between."""

import random
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.errors import ConfigError, SchemaDrift
from evenkeel.operators.merge import upsert_merge
from evenkeel.sources import copies, evolution, merges
from evenkeel.sources.files import Folder, partition_columns, partition_folder
from evenkeel.sources.tables import merge_into, scratch_path

SCHEMA = "k long, part string, v string"


def table(rng, n=80):
    parts = ["a", "b c", "d=e/f", "1%2", "x[1]*", None, "01"]
    return [(rng.randrange(60) if rng.random() > 0.1 else None, rng.choice(parts), f"old {i}") for i in range(n)]


@pytest.fixture
def path(spark):
    return scratch_path(spark, "stored")


def stored(spark, path, data, files=3):
    spark.createDataFrame(data, SCHEMA).repartition(files).write.partitionBy("part").parquet(path)


def read(spark, path, schema="k long, v string, part string"):
    return spark.read.schema(schema).parquet(path).select("k", "part", "v")


def stamps(spark, path):
    folder = Folder(spark, path)
    return {f: folder.fs.getFileStatus(folder.at(f)).getModificationTime() for f in folder.data_files()}


WHOLE = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("part", T.StringType())])


@pytest.mark.parametrize("delete", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_merge_touched_gives_what_a_merge_of_all_rows_gives(spark, path, seed, delete):
    rng = random.Random(seed)
    stored(spark, path, table(rng))
    source = spark.createDataFrame([(k, rng.choice(["a", "new?", None]), f"new {k}") for k in rng.sample(range(90), 12)] + [(None, "a", "null key")], SCHEMA)
    want = rows(upsert_merge(read(spark, path), source, ["k"], delete))
    before = stamps(spark, path)
    done = merges.merge_touched(path, source, ["k"], delete, schema=WHOLE)
    assert rows(read(spark, path)) == want
    after = stamps(spark, path)
    assert {f for f in before if f in after} == set(done.kept) and all(after[f] == before[f] for f in done.kept)
    assert set(done.kept) | set(done.rewritten) | set(done.removed) == set(before) and set(done.added) == set(after) - set(before)
    assert bool(done.removed) == delete or not done.kept
    assert sorted(r.action for r in done.files(spark).collect()).count("added") == len(done.added)


def test_one_key_rewrites_one_file(spark, path):
    spark.range(4000).selectExpr("id AS k", "CAST(id % 5 AS STRING) AS part", "'x' AS v").repartition(4).write.partitionBy("part").parquet(path)
    done = merges.merge_touched(path, spark.createDataFrame([(7, "2", "new")], SCHEMA), ["k"])
    assert len(done.rewritten) == len(done.added) == 1 and len(done.kept) == 19 and not done.removed
    assert done.added[0].startswith("part=2/") and read(spark, path).filter("v = 'new'").count() == 1 and read(spark, path).count() == 4000


def test_merge_reads_keys_and_names_first(spark, path):
    spark.range(100).selectExpr("id AS k", "'x' AS v").write.parquet(path)
    seen = merges._between(spark.createDataFrame([(7, "n"), (9, "n")], "k long, v string"), ["k"], spark.read.parquet(path))
    text = spark.read.parquet(path).filter(seen)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,7)" in text and "LessThanOrEqual(k,9)" in text


@pytest.mark.parametrize("moves", [0, 1, 2])
def test_a_crash_while_files_are_exchanged_is_finished(spark, path, moves, monkeypatch):
    rng = random.Random(3)
    stored(spark, path, table(rng))
    source = spark.createDataFrame([(k, "a", f"new {k}") for k in range(0, 60, 7)], SCHEMA)
    want = rows(upsert_merge(read(spark, path), source, ["k"]))
    move, left = Folder.move, [moves]

    def failing(self, before, after):
        if "/data/" in before:
            if not left[0]:
                raise RuntimeError("crash")
            left[0] -= 1
        move(self, before, after)

    with monkeypatch.context() as m:
        m.setattr(Folder, "move", failing)
        with pytest.raises(RuntimeError):
            merges.merge_touched(path, source, ["k"], schema=WHOLE)
    merges.finish(spark, path)
    merges.finish(spark, path)
    spark.catalog.refreshByPath(path)
    assert rows(read(spark, path)) == want and not Folder(spark, path).names("_merges")


def test_a_crash_before_the_journal_changes_nothing(spark, path, monkeypatch):
    stored(spark, path, table(random.Random(4)))
    before, files = rows(read(spark, path)), stamps(spark, path)
    source = spark.createDataFrame([(1, "a", "new")], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(Folder, "write_text", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            merges.merge_touched(path, source, ["k"], schema=WHOLE)
    assert rows(read(spark, path)) == before and stamps(spark, path) == files and Folder(spark, path).names("_merges")
    want = rows(upsert_merge(read(spark, path), source, ["k"]))
    merges.merge_touched(path, source, ["k"], schema=WHOLE)
    assert rows(read(spark, path)) == want and not Folder(spark, path).names("_merges")


def test_merge_creates_and_refuses(spark, path):
    source = spark.createDataFrame([(1, "a", "x"), (2, None, "y")], SCHEMA)
    done = merges.merge_touched(path, source, ["k"], partition_by=["part"])
    assert len(done.added) == 2 and not done.kept and rows(read(spark, path)) == rows(source)
    with pytest.raises(ConfigError, match="duplicate"):
        merges.merge_touched(path, source.union(source), ["k"])
    with pytest.raises(ConfigError, match="partitioned by"):
        merges.merge_touched(path, source, ["k"], partition_by=["v"])
    with pytest.raises(ConfigError, match="not found"):
        merges.merge_touched(path + "-other", source, ["k"], partition_by=["absent"])
    assert merges.merge_touched(path, source.filter("false"), ["k"]).rewritten == ()


def test_merge_into_keeps_partition_folders(spark, path):
    stored(spark, path, [(i, "a" if i % 2 else "b", "old") for i in range(10)])
    merge_into(path, spark.createDataFrame([(3, "a", "new"), (30, "c", "new")], SCHEMA), ["k"])
    assert {f.split("/")[0] for f in Folder(spark, path).data_files()} == {"part=a", "part=b", "part=c"}
    assert read(spark, path).filter("v = 'new'").count() == 2 and read(spark, path).count() == 11


def test_merge_into_a_catalog_table(spark):
    name = "t_" + scratch_path(spark, "x").rsplit("-", 1)[1]
    spark.createDataFrame([(i, f"0{i % 3}", "old") for i in range(9)], SCHEMA).write.partitionBy("part").saveAsTable(name)
    done = merges.merge_into_table(spark, name, spark.createDataFrame([(4, "07", "new"), (50, "08", "new")], SCHEMA), ["k"])
    assert len(done.rewritten) == 1
    assert {r.part for r in spark.table(name).filter("v = 'new'").collect()} == {"07", "08"} and spark.table(name).count() == 10
    spark.sql(f"DROP TABLE {name}")
    with pytest.raises(ConfigError):
        merges.merge_into_table(spark, "bad name", spark.range(1).selectExpr("id AS k"), ["k"])


def test_partition_names():
    assert partition_columns(["a=1/b=2/x", "a=3/b=2/y"]) == ["a", "b"] and partition_columns(["x"]) == [] == partition_columns([])
    for bad in (["a=1/x", "b=1/x"], ["sub/x"], ["a=1/x", "y"]):
        with pytest.raises(ConfigError):
            partition_columns(bad)
    assert partition_folder("p", None) == "p=__HIVE_DEFAULT_PARTITION__"


# --- copies ----------------------------------------------------------------------------------------

def times(spark, extra=()):
    data = [(i, datetime(2024, 1, 1 + i // 24 % 28, i % 24, i % 60, 0, i)) for i in range(24 * 10)] + [(-1, None), *extra]
    return spark.createDataFrame(data, "id long, at timestamp_ntz")


def held(spark, path):
    return rows(copies.read_copy(spark, path))


def test_a_window_is_copied_by_whole_days_and_again(spark, path):
    df = times(spark)
    window = (datetime(2024, 1, 3, 5), datetime(2024, 1, 5, 1))
    inside = "at >= '2024-01-03' AND at < '2024-01-06'"
    assert copies.copy_window(df, path, "at", *window) == 72
    assert copies.copy_window(df, path, "at", *window) == 72
    assert held(spark, path) == rows(df.filter(inside))
    copies.copy_window(df, path, "at", datetime(2024, 1, 5, 3), datetime(2024, 1, 7))
    changed = df.filter("day(at) <> 4").withColumn("id", F.expr("if(day(at) = 3, -id, id)"))
    assert copies.copy_window(changed, path, "at", *window) == 48  # a day without rows goes from the copy
    assert held(spark, path) == rows(changed.filter("at >= '2024-01-03' AND at < '2024-01-07'"))
    assert copies.copy_window(df.filter("false"), path, "at", *window) == 0
    assert held(spark, path) == rows(df.filter("day(at) = 6"))


def test_a_copy_that_failed_can_be_repeated(spark, path):
    df = times(spark)
    every = (datetime(2024, 1, 1), datetime(2024, 1, 11))
    copies.copy_window(df, path, "at", *every)
    bad = df.withColumn("id", F.expr("if(id = 100, raise_error('gone'), id)"))
    with pytest.raises(Exception, match="gone"):
        copies.copy_window(bad, path, "at", *every)
    assert held(spark, path) == rows(df.filter("at IS NOT NULL"))
    copies.copy_window(df.filter("id > 30"), path, "at", *every)
    assert held(spark, path) == rows(df.filter("id > 30 AND at IS NOT NULL"))


@pytest.mark.parametrize("period, window, whole", [
    ("day", (datetime(2024, 1, 3), datetime(2024, 1, 4)), (datetime(2024, 1, 3), datetime(2024, 1, 4))),
    ("day", (datetime(2024, 1, 31, 1), datetime(2024, 1, 31, 2)), (datetime(2024, 1, 31), datetime(2024, 2, 1))),
    ("hour", (datetime(2024, 12, 31, 23, 1), datetime(2024, 12, 31, 23, 59)), (datetime(2024, 12, 31, 23), datetime(2025, 1, 1))),
    ("hour", (datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 7, 0, 1)), (datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 8))),
    ("month", (datetime(2023, 11, 30), datetime(2023, 12, 2)), (datetime(2023, 11, 1), datetime(2024, 1, 1))),
])
def test_whole_periods(period, window, whole):
    assert copies.whole_periods(*window, period) == whole
    with pytest.raises(ConfigError):
        copies.whole_periods(*window, "week")


# --- evolution -------------------------------------------------------------------------------------

@pytest.mark.parametrize("old, new, value", [
    (T.IntegerType(), T.LongType(), "7"), (T.ShortType(), T.IntegerType(), "7"), (T.ByteType(), T.LongType(), "7"), (T.IntegerType(), T.DoubleType(), "7"),
    (T.FloatType(), T.DoubleType(), "0.5"), (T.DecimalType(9, 2), T.DecimalType(20, 4), "1.25"), (T.DateType(), T.TimestampNTZType(), "DATE '2024-01-02'"),
])
def test_old_files_are_read_under_wider_types(spark, path, old, new, value):
    first = spark.range(3).select(F.expr(value).cast(old).alias("v"))
    evolution.store_schema(spark, path, first.schema)
    evolution.append_stored(first, path)
    evolution.evolve_stored(spark, path, widen={"v": new})
    evolution.append_stored(spark.range(2).select(F.expr(value).cast(new).alias("v")), path)
    got = evolution.read_evolved(spark, path)
    assert got.schema["v"].dataType == new and got.distinct().count() == 1 and got.count() == 5


def test_evolution_refuses_and_repeats(spark, path):
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    with pytest.raises(ConfigError, match="no stored schema"):
        evolution.read_evolved(spark, path)
    evolution.store_schema(spark, path, df.schema)
    evolution.append_stored(df, path)
    with pytest.raises(ConfigError, match="already"):
        evolution.store_schema(spark, path, df.schema)
    with pytest.raises(ConfigError, match="cannot turn"):
        evolution.evolve_stored(spark, path, widen={"v": T.LongType()})
    with pytest.raises(ConfigError, match="fill"):
        evolution.evolve_stored(spark, path, add=[("x", T.StringType(), evolution.Fill("x", fill_from="absent"))])
    with pytest.raises(SchemaDrift):
        evolution.append_stored(df.withColumn("more", F.lit(1)), path)
    for _ in range(2):
        evolution.evolve_stored(spark, path, add=[("x", T.IntegerType(), evolution.Fill("x", default="42"))], widen={"k": T.LongType()})
    assert len(Folder(spark, path).names("_schema")) == 2
    evolution.append_stored(spark.createDataFrame([(2, "b", 7)], "k long, v string, x int"), path)
    with pytest.raises(ConfigError, match="wider"):
        evolution.append_stored(spark.createDataFrame([(2, "b", 7)], "k long, v string, x long"), path)
    assert rows(evolution.read_evolved(spark, path)) == [(1, "a", 42), (2, "b", 7)]
