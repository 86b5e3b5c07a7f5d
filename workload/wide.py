"""Diffs of long texts, arrays, nested times, large decimals and whole wide rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel import TableSpec, compare
from workload.inputs import load


def _changed(df, column, where, value):
    return df.withColumn(column, F.when(F.expr(where), value).otherwise(F.col(column)))


def diff_conversations(spark, d):
    """A composite key."""
    turns = load(spark, d, "conversations")
    target = _changed(turns.filter("conv_id % 9 <> 4 OR turn <> 1"), "text", "conv_id % 7 = 3 AND turn = 0", F.concat("text", F.lit(".")))
    return compare(turns, target, TableSpec("conversations", "advanced", keys=("conv_id", "turn"))).outcome


def diff_embeddings(spark, d):
    """Arrays, compared as a whole."""
    vectors = load(spark, d, "embeddings")
    target = _changed(vectors, "embedding", "vec_id % 20 = 7", F.reverse("embedding"))
    return compare(vectors, target, TableSpec("embeddings", "advanced", keys=("vec_id",))).outcome


def diff_documents(spark, d):
    docs = load(spark, d, "documents")
    target = _changed(docs.filter("doc_id % 31 <> 5"), "text", "doc_id % 20 = 1", F.concat("text", F.lit(" ")))
    return compare(docs, target, TableSpec("documents", "hash", keys=("doc_id",))).outcome


def diff_pages(spark, d):
    pages = load(spark, d, "pages")
    target = _changed(pages, "html", "page_id % 10 = 1", F.concat("html", F.lit("\n")))
    return compare(pages, target, TableSpec("pages", "advanced", keys=("page_id",))).outcome


def _amounts(spark, d):
    big = F.expr("CAST(9007199254740992 + o_orderkey AS DECIMAL(38, 2)) AS amount")
    source = load(spark, d, "orders").select("o_orderkey", big)
    return source, _changed(source, "amount", "o_orderkey % 50 = 1", F.expr("CAST(amount + 1 AS DECIMAL(38, 2))"))


def diff_decimals(spark, d):
    """Amounts beyond 2^53 that differ by one: no double can tell them apart."""
    return compare(*_amounts(spark, d), TableSpec("amounts", "advanced_no_pk")).outcome


def diff_decimals_keyed(spark, d):
    return compare(*_amounts(spark, d), TableSpec("amounts", "advanced", keys=("o_orderkey",))).outcome


def diff_nested(spark, d):
    """A struct and an array of times that differ by a microsecond."""
    shaped = lambda ts: load(spark, d, "events").select(
        "event_id", F.expr(f"named_struct('at', {ts}, 'user', user_id) AS detail"), F.expr(f"array({ts}, ts) AS times"))
    later = "if(event_id % 100 = 7, ts + INTERVAL 1 MICROSECOND, ts)"
    return compare(shaped("ts"), shaped(later), TableSpec("shaped", "advanced", keys=("event_id",))).outcome


def diff_rows_lineitem(spark, d):
    """All columns without a key: prices that move by less than the tolerance pass, those by more do not."""
    lines = load(spark, d, "lineitem")
    moved = F.expr("CASE WHEN l_orderkey % 500 = 3 THEN l_extendedprice + 0.01D WHEN l_orderkey % 500 = 7 THEN l_extendedprice + 0.0001D ELSE l_extendedprice END")
    return compare(lines, lines.withColumn("l_extendedprice", moved), TableSpec("lineitem", "advanced_no_pk", tolerance=0.001)).outcome


QUERIES = {
    "diff_conversations": diff_conversations,
    "diff_embeddings": diff_embeddings,
    "diff_documents": diff_documents,
    "diff_pages": diff_pages,
    "diff_decimals": diff_decimals,
    "diff_decimals_keyed": diff_decimals_keyed,
    "diff_nested": diff_nested,
    "diff_rows_lineitem": diff_rows_lineitem,
}


def _keyed_sql(table: str, mode: str, gone: str, changed: str) -> str:
    """The outcome if rows with ``gone`` are left out of the target and those with ``changed`` differ."""
    what = "hash_diff" if mode == "hash" else "col_diff"
    return f"""WITH n AS (SELECT COUNT(*) AS source_count, COUNT(*) FILTER (NOT ({gone})) AS target_count, COUNT(*) FILTER ({gone}) AS rows_only_in_source,
        CAST(0 AS BIGINT) AS rows_only_in_target, COUNT(*) FILTER (NOT ({gone}) AND ({changed})) AS rows_with_mismatches FROM {table})
      SELECT '{mode}' AS comparison_mode, *, source_count = target_count AS count_match,
        CASE WHEN rows_only_in_source + rows_with_mismatches = 0 THEN 'PASS' ELSE 'FAIL' END AS raw_status,
        CASE WHEN rows_only_in_source + rows_with_mismatches > 0 THEN 'Mismatches: 0 only_in_target, ' || rows_only_in_source || ' only_in_source, '
          || rows_with_mismatches || ' {what}' END AS error_message FROM n"""


def keyless_sql(mode: str, source: str, target: str) -> str:
    """The outcome of two multisets with equal totals."""
    return f"""WITH s AS ({source}), t AS ({target}), a AS (SELECT * FROM s EXCEPT ALL SELECT * FROM t), b AS (SELECT * FROM t EXCEPT ALL SELECT * FROM s),
        n AS (SELECT (SELECT COUNT(*) FROM s) AS source_count, (SELECT COUNT(*) FROM t) AS target_count, (SELECT COUNT(*) FROM a) AS rows_only_in_source,
          (SELECT COUNT(*) FROM b) AS rows_only_in_target, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM a)) + (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM b)) AS k)
        SELECT '{mode}' AS comparison_mode, source_count, target_count, TRUE AS count_match, rows_only_in_source, rows_only_in_target,
          CAST(0 AS BIGINT) AS rows_with_mismatches, CASE WHEN k = 0 THEN 'PASS' ELSE 'INCONCLUSIVE' END AS raw_status,
          CASE WHEN k > 0 THEN 'contents differ while totals match: ' || rows_only_in_target || ' extra row' || CASE WHEN rows_only_in_target = 1 THEN '' ELSE 's' END
            || ' in target, ' || rows_only_in_source || ' extra row' || CASE WHEN rows_only_in_source = 1 THEN '' ELSE 's' END || ' in source ('
            || k || ' distinct rows affected; see samples)' END AS error_message FROM n"""


ORACLES = {
    "diff_conversations": _keyed_sql("conversations", "advanced", "conv_id % 9 = 4 AND turn = 1", "conv_id % 7 = 3 AND turn = 0"),
    "diff_embeddings": _keyed_sql("embeddings", "advanced", "FALSE", "vec_id % 20 = 7 AND list_reverse(embedding) <> embedding"),
    "diff_documents": _keyed_sql("documents", "hash", "doc_id % 31 = 5", "doc_id % 20 = 1"),
    "diff_pages": _keyed_sql("pages", "advanced", "FALSE", "page_id % 10 = 1"),
    "diff_decimals": keyless_sql("advanced_no_pk", "SELECT o_orderkey, 9007199254740992 + o_orderkey AS amount FROM orders",
                                  "SELECT o_orderkey, 9007199254740992 + o_orderkey + CASE WHEN o_orderkey % 50 = 1 THEN 1 ELSE 0 END AS amount FROM orders"),
    "diff_decimals_keyed": _keyed_sql("orders", "advanced", "FALSE", "o_orderkey % 50 = 1"),
    "diff_nested": _keyed_sql("events", "advanced", "FALSE", "event_id % 100 = 7"),
    "diff_rows_lineitem": keyless_sql("advanced_no_pk", "SELECT * FROM lineitem",
                                       "SELECT * REPLACE (CASE WHEN l_orderkey % 500 = 3 THEN l_extendedprice + 0.01 ELSE l_extendedprice END AS l_extendedprice) FROM lineitem"),
}
