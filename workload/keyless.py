"""Keyless diffs: multisets of rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel import TableSpec, compare
from evenkeel.operators import multiset
from workload.inputs import EVENTS_PAIR_SQL, events_pair, load

_COLUMNS = ["event_type", "user_id"]
_JSON = """'{"event_type":"' || event_type || '","user_id":"' || user_id || '"}'"""
_BUCKETS_SQL = f"""{EVENTS_PAIR_SQL},
b AS (SELECT event_type, user_id, SUM(ns) AS n_source, SUM(nt) AS n_target FROM
        (SELECT *, 1 AS ns, 0 AS nt FROM s UNION ALL SELECT *, 0, 1 FROM t) GROUP BY 1, 2),
d AS (SELECT *, {_JSON} AS evidence FROM b WHERE n_source <> n_target),
n AS (SELECT (SELECT COUNT(*) FROM s) AS source_count, (SELECT COUNT(*) FROM t) AS target_count,
        CAST((SELECT SUM(GREATEST(n_source - n_target, 0)) FROM d) AS BIGINT) AS rows_only_in_source,
        CAST((SELECT SUM(GREATEST(n_target - n_source, 0)) FROM d) AS BIGINT) AS rows_only_in_target,
        (SELECT COUNT(*) FROM d) AS n_buckets)"""
_CLASS = """CASE WHEN n_source = 0 THEN 'only_in_target_multiset' WHEN n_target = 0 THEN 'only_in_source_multiset' ELSE 'multiset_count_diff' END"""


def diff_multiset(spark, d):
    return compare(*events_pair(spark, d), TableSpec("events", "hash_no_pk")).outcome


def diff_rows(spark, d):
    return compare(*events_pair(spark, d), TableSpec("events", "advanced", pk_fallback_strategy="no_pk_advanced")).outcome


def diff_multiset_lineitem(spark, d):
    """All columns of a wide table without a key; equal totals, different content."""
    lines = load(spark, d, "lineitem")
    changed = lines.withColumn("l_quantity", F.when(F.col("l_orderkey") % 500 == 3, F.col("l_quantity") + 100).otherwise(F.col("l_quantity")))
    return compare(lines, changed, TableSpec("lineitem", "hash_no_pk")).outcome


def diff_multiset_buckets(spark, d):
    return multiset.diverging_buckets(multiset.row_buckets(*events_pair(spark, d), _COLUMNS))


def bucket_samples(spark, d):
    return multiset.bucket_samples(*events_pair(spark, d), _COLUMNS)


def excess_rows(spark, d):
    return multiset.excess_rows(*events_pair(spark, d), _COLUMNS, decimals=3, round_decimals=True)


def except_all_source(spark, d):
    source, target = events_pair(spark, d)
    return multiset.except_all(source, target, _COLUMNS)


def except_all_target(spark, d):
    source, target = events_pair(spark, d)
    return multiset.except_all(target, source, _COLUMNS)


QUERIES = {
    "diff_multiset": diff_multiset,
    "diff_rows": diff_rows,
    "diff_multiset_lineitem": diff_multiset_lineitem,
    "diff_multiset_buckets": diff_multiset_buckets,
    "bucket_samples": bucket_samples,
    "excess_rows": excess_rows,
    "except_all_source": except_all_source,
    "except_all_target": except_all_target,
}


def _outcome_sql(mode: str) -> str:
    return f"""WITH {_BUCKETS_SQL} SELECT '{mode}' AS comparison_mode, source_count, target_count, source_count = target_count AS count_match,
      rows_only_in_source, rows_only_in_target, CAST(0 AS BIGINT) AS rows_with_mismatches, 'FAIL' AS raw_status,
      rows_only_in_target || ' extra row' || CASE WHEN rows_only_in_target = 1 THEN '' ELSE 's' END || ' in target, '
        || rows_only_in_source || ' extra row' || CASE WHEN rows_only_in_source = 1 THEN '' ELSE 's' END || ' in source ('
        || n_buckets || ' distinct row' || CASE WHEN n_buckets = 1 THEN '' ELSE 's' END || ' affected; see samples)' AS error_message FROM n"""


ORACLES = {
    "diff_multiset": _outcome_sql("hash_no_pk"),
    "diff_rows": _outcome_sql("advanced_no_pk"),
    "diff_multiset_lineitem": """WITH s AS (SELECT * FROM lineitem),
        t AS (SELECT * REPLACE (CASE WHEN l_orderkey % 500 = 3 THEN l_quantity + 100 ELSE l_quantity END AS l_quantity) FROM lineitem),
        a AS (SELECT * FROM s EXCEPT ALL SELECT * FROM t), b AS (SELECT * FROM t EXCEPT ALL SELECT * FROM s),
        n AS (SELECT (SELECT COUNT(*) FROM s) AS source_count, (SELECT COUNT(*) FROM t) AS target_count,
          (SELECT COUNT(*) FROM a) AS rows_only_in_source, (SELECT COUNT(*) FROM b) AS rows_only_in_target,
          (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM a)) + (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM b)) AS n_buckets)
        SELECT 'hash_no_pk' AS comparison_mode, source_count, target_count, TRUE AS count_match, rows_only_in_source, rows_only_in_target,
          CAST(0 AS BIGINT) AS rows_with_mismatches, 'INCONCLUSIVE' AS raw_status,
          'contents differ while totals match: ' || rows_only_in_target || ' extra row' || CASE WHEN rows_only_in_target = 1 THEN '' ELSE 's' END
            || ' in target, ' || rows_only_in_source || ' extra row' || CASE WHEN rows_only_in_source = 1 THEN '' ELSE 's' END || ' in source ('
            || n_buckets || ' distinct rows affected; see samples)' AS error_message FROM n""",
    "diff_multiset_buckets": f"""WITH {_BUCKETS_SQL} SELECT sha256(evidence) AS row_hash, {_CLASS} AS mismatch_type,
        CAST(n_source AS BIGINT) AS n_source, CAST(n_target AS BIGINT) AS n_target FROM d""",
    "bucket_samples": f"""WITH {_BUCKETS_SQL}
        SELECT {_CLASS} AS mismatch_type, evidence AS pk_values, CAST(NULL AS VARCHAR) AS column_name,
          CAST(CAST(n_source AS BIGINT) AS VARCHAR) AS source_value, CAST(CAST(n_target AS BIGINT) AS VARCHAR) AS target_value FROM d""",
    "excess_rows": f"""WITH {_BUCKETS_SQL}, e AS (SELECT evidence, CASE WHEN n_source > n_target THEN 'source' ELSE 'target' END AS side,
          CAST(ABS(n_source - n_target) AS BIGINT) AS surplus FROM d)
        SELECT 'only_in_' || side || '_no_pk' AS mismatch_type, evidence AS pk_values, CAST(NULL AS VARCHAR) AS column_name,
          CASE WHEN side = 'source' THEN CAST(surplus AS VARCHAR) ELSE '0' END AS source_value,
          CASE WHEN side = 'source' THEN '0' ELSE CAST(surplus AS VARCHAR) END AS target_value FROM e""",
    "except_all_source": f"WITH {EVENTS_PAIR_SQL} SELECT event_type, CAST(user_id AS VARCHAR) AS user_id FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM t)",
    "except_all_target": f"WITH {EVENTS_PAIR_SQL} SELECT event_type, CAST(user_id AS VARCHAR) AS user_id FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM s)",
}
