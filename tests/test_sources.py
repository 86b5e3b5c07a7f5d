"""Windows, database options, copies, merges, evolution."""

from datetime import datetime

import pytest
from conftest import NOW, rows
from pyspark.sql import functions as F

from evenkeel import ConfigError, ParityFailure
from evenkeel.functions.names import safe_name
from evenkeel.operators import drift
from evenkeel.operators.evolve import add_and_backfill, backfill_check
from evenkeel.operators.merge import check_merge_source, empty_like, upsert_merge
from evenkeel.sources import jdbc, tables, window

START, END = window.window_bounds(NOW, 7, 30)


def test_bounds():
    assert (START, END) == (datetime(2024, 1, 25), datetime(2024, 2, 1))
    assert window.window_bounds(NOW, 0, 0) == (NOW, NOW)
    assert window.iso_utc(datetime(2024, 1, 1, 2, 3, 4, 5)) == "2024-01-01T02:03:04.000005+00:00"


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_window_is_half_open_to_the_microsecond(spark, kind):
    times = ["2024-01-24 23:59:59.999999", "2024-01-25 00:00:00", "2024-01-31 23:59:59.999999", "2024-02-01 00:00:00", None]
    df = spark.createDataFrame(list(enumerate(times)), "id int, ts string").withColumn("ts", F.col("ts").cast(kind))
    assert [r[0] for r in rows(window.windowed_scan(df, "ts", START, END))] == [1, 2]
    assert rows(window.windowed_count(df, "ts", START, END)) == [(2,)]
    template = "\"ts\" >= '{window_start}' AND \"ts\" < '{window_end}' OR id = 0 AND ts < '{window_start}'"
    assert [r[0] for r in rows(window.scan(df, template, START, END, trusted=True))] == [0, 1, 2]
    assert window.scan(df, None, START, END).count() == 5
    with pytest.raises(ConfigError):
        window.scan(df, template, START, END)
    with pytest.raises(ConfigError):
        window.windowed_scan(df, "ts; --", START, END)


def test_window_reaches_the_scan(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    plan = window.windowed_scan(events, "ts", START, END).select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_jdbc_text():
    db = jdbc.JdbcSource("jdbc:some:db", {"user": "u", "driver": "d"})
    assert db.read_options() == {"url": "jdbc:some:db", "fetchsize": "10000", "user": "u", "driver": "d"}
    assert jdbc.windowed_query(db, "sales", "orders", "changed_at", START, END) == (
        "SELECT * FROM sales.orders WHERE \"changed_at\" >= TIMESTAMPTZ '2024-01-25T00:00:00.000000+00:00' "
        "AND \"changed_at\" < TIMESTAMPTZ '2024-02-01T00:00:00.000000+00:00'"
    )
    assert jdbc.where_clause(db, "a >= '{window_start}'", START, END, trusted=True) == "a >= '2024-01-25T00:00:00.000000+00:00'"
    for bad in ({"table": "orders; drop"}, {"schema": "x y"}, {"filter_column": 'a" OR 1=1'}, {"filter_column": "a >= '{window_start}'"}):
        args = {"schema": "sales", "table": "orders", "filter_column": "changed_at", **bad}
        with pytest.raises(ConfigError):
            jdbc.windowed_query(db, args["schema"], args["table"], args["filter_column"], START, END)


def test_jdbc_partitions_and_writes():
    assert jdbc.partition_options("id", 3, 900) == {"partitionColumn": '"id"', "lowerBound": "3", "upperBound": "900", "numPartitions": "4"}
    assert jdbc.partition_options("id", None, None) == {}
    db = jdbc.JdbcSource("jdbc:some:db")
    assert jdbc.write_options(db, "s.t", "overwrite") == {"url": "jdbc:some:db", "dbtable": "s.t", "batchsize": "100000", "truncate": "false"}
    assert "truncate" not in jdbc.write_options(db, "s.t", "append")
    with pytest.raises(ConfigError):
        jdbc.write_options(db, "s.t", "merge")


def test_copy(spark, tmp_path):
    df = spark.range(0, 1000, 1, 7).selectExpr("id", "array(id) AS a")
    path = str(tmp_path / "copy")
    assert tables.copy_table(df, path) == 1000
    assert tables.copy_table(df.limit(10), path, "append") == 10
    assert spark.read.parquet(path).count() == 1010
    assert tables.copy_table(df.selectExpr("id", "1 AS other"), path) == 1000  # a new schema replaces the old
    assert spark.read.parquet(path).columns == ["id", "other"]
    with pytest.raises(ConfigError):
        tables.copy_table(df, path, "merge")
    assert tables.copy_to_catalog(df.drop("a"), "copied_ids") == 1000
    assert "copied_ids" in rows(tables.catalog_tables(spark, "default"))[0]
    spark.sql("DROP TABLE copied_ids")


def test_copies_are_isolated(spark, tmp_path):
    def broken():
        raise RuntimeError("no such source")

    jobs = [
        tables.CopyJob("good", lambda: spark.range(5), str(tmp_path / "good")),
        tables.CopyJob("bad", broken, str(tmp_path / "bad")),
        tables.CopyJob("also good", lambda: spark.range(5), str(tmp_path / "also")),
        tables.CopyJob("fine", lambda: spark.range(6), str(tmp_path / "fine")),
    ]
    results = tables.copy_tables(spark, jobs)
    assert [(r.table_name, r.status, r.n_rows) for r in results.collect()] == [
        ("good", "success", 5), ("bad", "failed", 0), ("also good", "failed", 0), ("fine", "success", 6),
    ]
    assert rows(tables.copy_summary(results).drop("seconds")) == [("failed", 2, 0), ("success", 2, 11)]
    with pytest.raises(ParityFailure, match="copy: failed for also good, bad$"):
        tables.fail_if_any(results, ["failed"], context="copy")
    tables.fail_if_any(results, ["cancelled"])


def test_snapshot_is_fixed(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    fixed = tables.snapshot(spark.read.parquet(path))
    spark.range(50).write.mode("append").parquet(path)
    assert fixed.count() == 5
    assert tables.discover_tables(spark, str(tmp_path)) == []


def test_shared_folder_follows_the_session(spark, monkeypatch):
    folder = tables.shared_folder(spark)
    assert folder == tables.shared_folder(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or folder == named.rstrip("/")
    first, second = tables.scratch_path(spark, "x"), tables.scratch_path(spark, "x")
    assert first != second and first.startswith(f"{folder}/x-")


def test_merge(spark):
    target = spark.createDataFrame([(1, "a", 1), (1, "a2", 2), (2, "b", 3), (None, "n", 4)], "k int, v string, w int")
    source = spark.createDataFrame([(1, "A"), (3, "C"), (None, "N")], "k int, v string")
    assert rows(upsert_merge(target, source, ["k"])) == [
        (1, "A", 1), (1, "A", 2), (2, "b", 3), (3, "C", None), (None, "N", None), (None, "n", 4),
    ]
    assert rows(upsert_merge(target, source, ["k"], delete_unmatched=True)) == [(1, "A", 1), (1, "A", 2), (3, "C", None), (None, "N", None)]
    assert rows(upsert_merge(empty_like(source), source, ["k"])) == rows(source)
    nulled = spark.createDataFrame([(2, None)], "k int, v string")
    assert (2, None, 3) in rows(upsert_merge(target, nulled, ["k"]))
    with pytest.raises(ConfigError, match="duplicate"):
        check_merge_source(target, ["k"])
    with pytest.raises(ConfigError, match="not found"):
        check_merge_source(source, ["nope"])
    with pytest.raises(ConfigError, match="not found"):
        upsert_merge(source, target, ["k"])
    check_merge_source(source, ["k"])


def test_backfill(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, "own")], "id int, created string, updated string")
    filled = add_and_backfill(df, "updated", F.lit("now"), "created")
    assert rows(filled) == [(1, "x", "x"), (2, None, "own")]
    assert rows(add_and_backfill(filled, "updated", F.lit("later"), "created")) == rows(filled)
    assert rows(add_and_backfill(df, "seen", F.lit("now"), "absent").select("seen")) == [("now",), ("now",)]
    assert rows(backfill_check(df, "updated")) == [(2, 1)]


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ConfigError, match="spark.checkpoint.dir"):
        tables.shared_folder(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(ConfigError):
        tables.shared_folder(Session())


def test_names_end_where_they_end():
    with pytest.raises(ConfigError):
        safe_name("orders\n")


def test_mutations_refuse_what_they_cannot_change(spark):
    df = spark.range(3).selectExpr("id", "'a' AS s", "current_timestamp() AS ts")
    for column in ("absent", "id", "ts"):
        with pytest.raises(ConfigError):
            drift.update_column(df, ["id"], column, F.lit("x"), datetime(2024, 1, 1), filter_column="ts")
    with pytest.raises(ConfigError):
        drift.drop_column(df, "absent")
    with pytest.raises(ConfigError):
        drift.drop_column(df, "id", ("id",))


def test_a_window_is_read_in_ranges():
    db = jdbc.JdbcSource("jdbc:some:db")
    got = jdbc.windowed_split_options(db, "app", "orders", "changedAt", START, END, "Id", 1, 9, 3)
    window_sql = f"""SELECT * FROM app.orders WHERE "changedAt" >= TIMESTAMPTZ '{window.iso_utc(START)}' AND "changedAt" < TIMESTAMPTZ '{window.iso_utc(END)}'"""
    assert got == {"dbtable": f"({window_sql}) windowed", "partitionColumn": '"Id"', "lowerBound": "1", "upperBound": "9", "numPartitions": "3"}
    assert jdbc.bounds_query(db, "app", "orders", None, START, END, "Id") == '(SELECT MIN("Id") AS lo, MAX("Id") AS hi FROM app.orders WHERE 1 = 1) bounds'


def test_quotes_inside_literals_stay(spark):
    df = spark.sql("""SELECT 1 AS id, 'say "id"' AS s UNION ALL SELECT 2, 'x'""")
    assert [r.id for r in window.expr_window_scan(df, """"s" = 'say "id"' AND "id" < 5""", START, END, trusted=True).collect()] == [1]


def test_merge_into_a_path(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    assert rows(tables.merge_into(path, first, ["k"])) == [(1, "a"), (2, "b")]
    assert rows(tables.merge_into(path, spark.createDataFrame([(2, "x"), (3, "c")], "k int, s string"), ["k"])) == [(1, "a"), (2, "x"), (3, "c")]
    assert rows(tables.merge_into(path, first.filter("k = 1"), ["k"], delete_unmatched=True)) == [(1, "a")]
    with pytest.raises(ConfigError):
        tables.merge_into(path, first.union(first), ["k"])
    assert rows(spark.read.parquet(path)) == [(1, "a")] and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_scope_deletes_what_it_wrote(spark):
    from evenkeel.sources.files import Folder
    from evenkeel.sources.tables import scratch_path, scratch_scope, snapshot

    with scratch_scope(spark):
        inner = scratch_path(spark, "inner")
        snapshot(spark.range(3), "in-scope")
        with scratch_scope(spark):
            deeper = scratch_path(spark, "deeper")
        assert deeper.startswith(inner.rsplit("/", 1)[0])
    folder = inner.rsplit("/", 1)[0]
    assert not Folder(spark, folder).exists() and "scope-" not in scratch_path(spark, "outside")
    with pytest.raises(RuntimeError), scratch_scope(spark):
        broken = snapshot(spark.range(3), "in-scope")
        raise RuntimeError
    with pytest.raises(Exception):
        broken.count()
