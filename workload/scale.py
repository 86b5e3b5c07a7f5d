"""Diffs that move little: by segments, with a filter before the shuffle, and of one source against many copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel import TableSpec, compare
from evenkeel.operators import keyed as keyed_ops, many, multiset, pairing, segments
from workload import keyed, keyless, wide
from workload.inputs import EVENTS_PAIR_SQL, ORDERS_PAIR_SQL, events_pair, load, orders_pair


def diff_segments(spark, d):
    return compare(*orders_pair(spark, d), TableSpec("orders", "hash", keys=("o_orderkey",), by_segments=True)).outcome


def diff_segments_lineitem(spark, d):
    """Keys that are not unique, by segments: equal segments are checked for them too."""
    lines = load(spark, d, "lineitem")
    spec = TableSpec("lineitem", "hash", keys=("l_orderkey", "l_linenumber"), by_segments=True)
    return compare(lines, lines.filter("l_orderkey % 97 <> 0"), spec).outcome


def diff_segments_rows(spark, d):
    """All columns of a wide table without a key, by segments of a hash."""
    lines = load(spark, d, "lineitem")
    changed = lines.withColumn("l_quantity", F.when(F.col("l_orderkey") % 500 == 3, F.col("l_quantity") + 100).otherwise(F.col("l_quantity")))
    return compare(lines, changed, TableSpec("lineitem", "hash_no_pk", by_segments=True)).outcome


def diff_segments_equal(spark, d):
    """Equal tables: nothing but sums of segments is moved, bitmaps of keys included."""
    orders = load(spark, d, "orders")
    return compare(orders, orders, TableSpec("orders", "hash", keys=("o_orderkey",), by_segments=True)).outcome


def segment_sums(spark, d):
    source, target = orders_pair(spark, d)
    return segments.segment_sums(source, target, ["o_orderkey"], source.columns)


def diff_rows_tolerant(spark, d):
    """Prices of all lines lie on either side of a rounding edge, some of them further apart than the tolerance."""
    lines = load(spark, d, "lineitem")
    low = lines.withColumn("l_extendedprice", F.expr("l_extendedprice + 0.0004999D"))
    high = lines.withColumn("l_extendedprice", F.expr("l_extendedprice + if(l_orderkey % 500 = 3, 0.0025D, 0.0005001D)"))
    return compare(low, high, TableSpec("lineitem", "advanced_no_pk", tolerance=0.001)).outcome


def evidence_filtered(spark, d):
    """The evidence of a keyless diff by a filter of digests, as for very many differing rows."""
    return multiset.bucket_samples(*events_pair(spark, d), ["event_type", "user_id"], broadcast_bytes=0)


def findings_filtered(spark, d):
    """Differing columns of keyed rows by a filter of keys, as for very many differing rows."""
    source, target = orders_pair(spark, d)
    found = keyed_ops.column_findings(source, target, ["o_orderkey"], source.columns, 0.001, broadcast_bytes=0)
    return keyed_ops.value_diffs(found, ["o_orderkey"])


def pair_changes(spark, d):
    """Lines without a key of which some changed in one column, some in two, and some went: rows per changed column."""
    lines = load(spark, d, "lineitem").drop("l_linenumber")
    changed = lines.filter("l_orderkey % 700 <> 9").withColumns({
        "l_returnflag": F.expr("if(l_orderkey % 100 = 3, 'X', l_returnflag)"),
        "l_linestatus": F.expr("if(l_orderkey % 100 IN (5, 7), 'Y', l_linestatus)"),
        "l_quantity": F.expr("if(l_orderkey % 100 = 7, l_quantity + 1000, l_quantity)"),
    })
    return pairing.changes_by_column(pairing.pair_changes(lines, changed, lines.columns))


def pair_changes_copies(spark, d):
    """Events without a key: copies of a row that changed are paired by their number."""
    events = load(spark, d, "events").select("user_id", "event_type")
    changed = events.withColumn("event_type", F.expr("if(user_id % 10 = 3, concat(event_type, '?'), event_type)"))
    return pairing.pair_changes(events, changed, events.columns).groupBy("change", "column_name", "source_value", "target_value").agg(
        F.expr("CAST(sum(n_rows) AS BIGINT) AS n_rows"))


_COPIES = {
    "same": "true", "lost": "o_orderkey % 97 <> 0", "few": "o_orderkey % 1000 = 7",
}


def diff_many(spark, d):
    """Orders against five copies in one shuffle: equal, with rows lost, with nearly all lost, changed, and with copies of keys."""
    orders = load(spark, d, "orders")
    copies = {n: orders.filter(where) for n, where in _COPIES.items()}
    copies["changed"] = orders_pair(spark, d)[1]
    copies["twice"] = orders.unionByName(orders.filter("o_orderkey % 50 = 3"))
    found = many.keyed_many(orders, copies, ["o_orderkey"], orders.columns)
    out = None
    for n, findings in found.items():
        one = keyed_ops.keyed_outcome(findings, "hash", "hash_diff").select(F.lit(n).alias("copy"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def diff_many_rows(spark, d):
    """The same without a key: events against copies, by the number of each row."""
    source, target = events_pair(spark, d)
    copies = {"same": source, "drifted": target, "none": source.filter("false"), "doubled": source.unionByName(source)}
    found, out = many.keyless_many(source, copies, ["event_type", "user_id"]), None
    for n, buckets in found.items():
        one = multiset.multiset_outcome(buckets, "hash_no_pk").select(F.lit(n).alias("copy"), "source_count", "target_count", "rows_only_in_source", "rows_only_in_target", "raw_status")
        out = one if out is None else out.unionByName(one)
    return out


QUERIES = {
    "diff_segments": diff_segments,
    "diff_segments_lineitem": diff_segments_lineitem,
    "diff_segments_rows": diff_segments_rows,
    "diff_segments_equal": diff_segments_equal,
    "segment_sums": segment_sums,
    "diff_rows_tolerant": diff_rows_tolerant,
    "evidence_filtered": evidence_filtered,
    "findings_filtered": findings_filtered,
    "pair_changes": pair_changes,
    "pair_changes_copies": pair_changes_copies,
    "diff_many": diff_many,
    "diff_many_rows": diff_many_rows,
}


def _copy_sql(n: str, where: str) -> str:
    gone = f"COUNT(*) FILTER (NOT ({where}))"
    return f"""SELECT '{n}' AS copy, 'hash' AS comparison_mode, COUNT(*) AS source_count, COUNT(*) FILTER ({where}) AS target_count, {gone} = 0 AS count_match,
        {gone} AS rows_only_in_source, CAST(0 AS BIGINT) AS rows_only_in_target, CAST(0 AS BIGINT) AS rows_with_mismatches, CASE WHEN {gone} = 0 THEN 'PASS' ELSE 'FAIL' END AS raw_status,
        CASE WHEN {gone} > 0 THEN 'Mismatches: 0 only_in_target, ' || {gone} || ' only_in_source, 0 hash_diff' END AS error_message FROM orders"""


ORACLES = {
    "diff_many": " UNION ALL ".join(_copy_sql(n, where) for n, where in _COPIES.items()) + f""" UNION ALL SELECT 'changed' AS copy, * FROM ({keyed.ORACLES["diff_hash"]})
        UNION ALL SELECT 'twice', 'hash', COUNT(*), COUNT(*) + COUNT(*) FILTER (o_orderkey % 50 = 3), NULL, NULL, NULL, NULL, 'DATA_QUALITY_ERROR',
          'target: ' || COUNT(*) FILTER (o_orderkey % 50 = 3) || ' duplicate PK rows' FROM orders""",
    "diff_many_rows": f"""WITH {EVENTS_PAIR_SQL}, n AS (SELECT (SELECT COUNT(*) FROM s) AS sn, (SELECT COUNT(*) FROM t) AS tn,
          (SELECT COUNT(*) FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM t)) AS a, (SELECT COUNT(*) FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM s)) AS b)
        SELECT 'same' AS copy, sn AS source_count, sn AS target_count, CAST(0 AS BIGINT) AS rows_only_in_source, CAST(0 AS BIGINT) AS rows_only_in_target, 'PASS' AS raw_status FROM n
        UNION ALL SELECT 'drifted', sn, tn, a, b, 'FAIL' FROM n UNION ALL SELECT 'none', sn, 0, sn, 0, 'FAIL' FROM n UNION ALL SELECT 'doubled', sn, 2 * sn, 0, sn, 'FAIL' FROM n""",
    "diff_rows_tolerant": wide.keyless_sql(
        "advanced_no_pk", "SELECT * FROM lineitem",
        "SELECT * REPLACE (CASE WHEN l_orderkey % 500 = 3 THEN l_extendedprice + 0.002 ELSE l_extendedprice END AS l_extendedprice) FROM lineitem"),
    "evidence_filtered": keyless.ORACLES["bucket_samples"],
    "findings_filtered": keyed.ORACLES["value_diffs"],
    "pair_changes": """SELECT 'changed' AS change, 'l_returnflag' AS column_name, COUNT(*) AS n_rows FROM lineitem WHERE l_orderkey % 700 <> 9 AND l_orderkey % 100 = 3
        UNION ALL SELECT 'changed', 'l_linestatus', COUNT(*) FROM lineitem WHERE l_orderkey % 700 <> 9 AND l_orderkey % 100 = 5
        UNION ALL SELECT 'only_in_target', NULL, COUNT(*) FROM lineitem WHERE l_orderkey % 700 <> 9 AND l_orderkey % 100 = 7
        UNION ALL SELECT 'only_in_source', NULL, COUNT(*) FROM lineitem WHERE l_orderkey % 700 = 9 OR l_orderkey % 100 = 7""",
    "pair_changes_copies": """SELECT 'changed' AS change, 'event_type' AS column_name, event_type AS source_value, event_type || '?' AS target_value, COUNT(*) AS n_rows
        FROM events WHERE user_id % 10 = 3 GROUP BY event_type""",
    "diff_segments": keyed.ORACLES["diff_hash"],
    "diff_segments_lineitem": keyed.ORACLES["diff_hash_bad_keys"],
    "diff_segments_rows": keyless.ORACLES["diff_multiset_lineitem"],
    "diff_segments_equal": """SELECT 'hash' AS comparison_mode, COUNT(*) AS source_count, COUNT(*) AS target_count, TRUE AS count_match,
        CAST(0 AS BIGINT) AS rows_only_in_source, CAST(0 AS BIGINT) AS rows_only_in_target, CAST(0 AS BIGINT) AS rows_with_mismatches,
        'PASS' AS raw_status, CAST(NULL AS VARCHAR) AS error_message FROM orders""",
    "segment_sums": f"""WITH {ORDERS_PAIR_SQL},
        e AS (SELECT MIN(o_orderkey) AS low, GREATEST(0, length(bin(MAX(o_orderkey) - MIN(o_orderkey))) - 12) AS shift
              FROM (SELECT o_orderkey FROM s UNION ALL SELECT o_orderkey FROM t)),
        a AS (SELECT 1 AS n, 0 AS m, * FROM s UNION ALL SELECT 0, 1, * FROM t),
        p AS (SELECT low + ((o_orderkey - low) >> shift << shift) AS segment, a.* FROM a CROSS JOIN e),
        r AS (SELECT segment, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, SUM(n) AS n, SUM(m) AS m
              FROM p GROUP BY ALL)
        SELECT segment, CAST(SUM(n) AS BIGINT) AS n_source, CAST(SUM(m) AS BIGINT) AS n_target, bool_and(n = m) AS agrees FROM r GROUP BY segment""",
}
