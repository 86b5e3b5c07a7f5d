"""Shapes of the physical plans that keep the work parallel."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from evenkeel import TableSpec, compare
from evenkeel.operators import counts, drift, keyed, keys, many, multiset, pairing, renames, segments, sieve, tolerant
from workload import forms, stored
from workload.inputs import orders_pair

EAGER = {"validation_results", "run_row", "scenario_run", "copy_summary", "copy_table", "merge_into"} | set(stored.QUERIES)
#: Queries that write what they find on the way, and the modules that do so.
STAGED = ("diff_segments", "diff_segments_lineitem", "diff_segments_rows", "diff_many", "diff_many_rows", "diff_rows_tolerant", "evidence_filtered",
          "findings_filtered", "pair_changes", "column_renames")
WRITERS = (keyed, many, multiset, pairing, renames, segments, sieve, tolerant)
BAD = ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas", "ExistingRDD")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> list[str]:
    """Shuffles, without those that gather a single row of totals."""
    return [e for e in re.findall(r"Exchange (\w+)", text) if e not in ("SinglePartition",)]


@pytest.fixture
def pair(spark, sf):
    return orders_pair(spark, sf)


def test_hash_diff_is_one_shuffle_without_a_join(pair):
    text = plan(compare(*pair, TableSpec("orders", "hash", keys=("o_orderkey",))).outcome)
    assert exchanges(text) == ["hashpartitioning"]
    assert "Join" not in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text
    assert "partial_bit_xor" in text  # combined before the shuffle


def test_multiset_diff_is_one_shuffle_of_digests(pair):
    text = plan(compare(*pair, TableSpec("orders", "hash_no_pk")).outcome)
    assert exchanges(text) == ["hashpartitioning"]
    assert "Join" not in text and "SortAggregate" not in text
    assert re.search(r"Exchange hashpartitioning\(__digest#\d+, ", text)


def test_counts_read_no_columns(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    text = plan(counts.diff_basic(orders, orders))
    assert text.count("ReadSchema: struct<>") == 2 and exchanges(text) == []


def test_key_quality_reads_keys_once(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    text = plan(keys.key_quality(lines, ["l_orderkey", "l_linenumber"]))
    assert text.count("FileScan") == 1 and "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text
    assert exchanges(text) == ["hashpartitioning"]


def test_samples_are_pruned_before_every_shuffle(pair):
    text = plan(keyed.keyed_samples(keyed.hash_pairs(*pair, ["o_orderkey"], pair[0].columns), ["o_orderkey"], 1000))
    assert text.count("WindowGroupLimit") == 4


def test_column_diff_does_not_shuffle_rows(pair):
    found = keyed.column_findings(*pair, ["o_orderkey"], pair[0].columns, 0.001)
    text = plan(found)
    assert text.count("BroadcastHashJoin") == text.count("LeftSemi") >= 2 and "SortMergeJoin" not in text
    assert text.count("Exchange hashpartitioning") == 1  # above the joins: rows of suspects alone are moved


def test_evidence_joins_a_measured_pick(pair):
    text = plan(multiset.bucket_samples(*pair, pair[0].columns))
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    assert text.index("StructsToJson") < text.index("BroadcastHashJoin")  # the text is made after the join


def test_drift_picks_are_pruned_and_broadcast(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    for df in (drift.delete_rows(orders, ["o_orderkey"], 50, "o_orderdate"), drift.update_column(orders, ["o_orderkey"], "o_orderstatus", F.lit("x"), None, 20),
               drift.delete_rows_keyless(orders, 5, "o_orderdate"), drift.null_out_key(orders, ["o_orderkey"])):
        text = plan(df)
        assert "TakeOrderedAndProject" in text and "BroadcastHashJoin" in text


@pytest.mark.parametrize("name", sorted(n for n in set(registry.queries()) - EAGER - set(STAGED) - set(forms.QUERIES) if not re.match(r"op\d+_|pipeline$", n)))
def test_no_query_pairs_everything_or_leaves_the_jvm(spark, sf, name):
    text = plan(registry.queries()[name](spark, sf))
    for bad in BAD:
        assert bad not in text, bad


@pytest.mark.parametrize("name", STAGED)
def test_no_step_of_a_staged_query_pairs_everything(spark, sf, name, monkeypatch):
    """Also in what is written on the way; only the matching of close rows is Python, in Arrow batches."""
    seen = []
    for module in WRITERS:
        if hasattr(module, "snapshot"):
            monkeypatch.setattr(module, "snapshot", lambda df, label="snapshot", keep=module.snapshot: (seen.append(plan(df)), keep(df, label))[1])
    seen.append(plan(registry.queries()[name](spark, sf)))
    assert len(seen) > 1
    for text in seen:
        for bad in BAD:
            assert bad not in text, bad
        assert "MapInArrow" not in text or name == "diff_rows_tolerant"
