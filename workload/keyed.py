"""Scans, keyed diffs and their samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel import TableSpec, compare
from evenkeel.functions.canonical import canonical_rows, with_row_hash
from evenkeel.operators import counts, keyed, keys as key_ops
from evenkeel.operators.columns import schema_drift as drift_report
from evenkeel.operators.drift import add_extra_column, drop_column
from evenkeel.operators.evolve import backfill_check
from evenkeel.plans.verdict import samples_audit as store_samples
from evenkeel.sources import window
from workload.inputs import NOW, ORDERS_NOW, ORDERS_PAIR_SQL, load, orders_pair

_KEY = ["o_orderkey"]
_TEMPLATE = "\"ts\" >= '{window_start}' AND \"ts\" < '{window_end}' OR \"event_type\" = 'error' AND \"ts\" < '{window_start}'"
_PAIRED = "FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey"
_HASH_CLASS = """CASE WHEN s.o_orderkey IS NULL THEN 'only_in_target' WHEN t.o_orderkey IS NULL THEN 'only_in_source'
  WHEN s.o_custkey IS DISTINCT FROM t.o_custkey OR s.o_orderstatus IS DISTINCT FROM t.o_orderstatus
    OR s.o_totalprice IS DISTINCT FROM t.o_totalprice OR s.o_orderdate IS DISTINCT FROM t.o_orderdate
    OR s.o_orderpriority IS DISTINCT FROM t.o_orderpriority THEN 'hash_diff' ELSE 'match' END"""
_STATUS_DIFFERS = "s.o_orderstatus IS DISTINCT FROM t.o_orderstatus"
_PRICE_DIFFERS = "NOT COALESCE(ABS(s.o_totalprice - t.o_totalprice) <= 0.001, FALSE)"
_COUNTS = "(SELECT COUNT(*) FROM s) AS source_count, (SELECT COUNT(*) FROM t) AS target_count"
_VALUE_DIFFS_SQL = f"""vd AS (
  SELECT s.o_orderkey, 'o_orderstatus' AS column_name, s.o_orderstatus AS source_value, t.o_orderstatus AS target_value
  FROM s JOIN t USING (o_orderkey) WHERE {_STATUS_DIFFERS}
  UNION ALL
  SELECT s.o_orderkey, 'o_totalprice', CAST(s.o_totalprice AS VARCHAR), CAST(t.o_totalprice AS VARCHAR)
  FROM s JOIN t USING (o_orderkey) WHERE {_PRICE_DIFFERS})"""
_SAMPLES_SQL = f"""{_VALUE_DIFFS_SQL},
lone AS (
  SELECT 'only_in_target' AS mismatch_type, t.o_orderkey AS k, NULL AS column_name, NULL AS source_value, 'EXISTS' AS target_value
  FROM t ANTI JOIN s USING (o_orderkey)
  UNION ALL
  SELECT 'only_in_source', s.o_orderkey, NULL, 'EXISTS', NULL FROM s ANTI JOIN t USING (o_orderkey)),
every AS (SELECT * FROM lone UNION ALL SELECT 'value_diff', o_orderkey, column_name, source_value, target_value FROM vd),
samples AS (SELECT mismatch_type, '{{"o_orderkey":"' || k || '"}}' AS pk_values, column_name, source_value, target_value FROM every)"""


def _window(days=7, lag=30):
    return window.window_bounds(NOW, days, lag)


def windowed_scan(spark, d):
    return window.windowed_scan(load(spark, d, "events"), "ts", *_window())


def expr_window_scan(spark, d):
    return window.expr_window_scan(load(spark, d, "events"), _TEMPLATE, *_window(), trusted=True)


def windowed_count(spark, d):
    return window.windowed_count(load(spark, d, "events"), "ts", *_window(14, 0))


def window_bounds(spark, d):
    """Per event: the window a run at that time would look at."""
    events = load(spark, d, "events").select(
        "event_id", "ts", (F.col("user_id") % 10).cast("int").alias("filter_days"), (F.col("event_id") % 90).cast("int").alias("safety_lag_minutes")
    )
    return window.with_window_bounds(events, "ts")


def count_delta(spark, d):
    return counts.count_delta(*orders_pair(spark, d))


def diff_basic(spark, d):
    return counts.diff_basic(*orders_pair(spark, d))


def keys_only_in_source(spark, d):
    return key_ops.keys_only_in_source(*orders_pair(spark, d), _KEY)


def keys_only_in_target(spark, d):
    return key_ops.keys_only_in_target(*orders_pair(spark, d), _KEY)


def key_quality(spark, d):
    return key_ops.key_quality(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def duplicate_keys(spark, d):
    return key_ops.duplicate_keys(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def row_hash(spark, d):
    orders = load(spark, d, "orders")
    return with_row_hash(orders, orders.columns, _KEY).select("o_orderkey", "row_hash")


def canonical(spark, d):
    return canonical_rows(load(spark, d, "events"), ["event_id", "event_type", "props", "ts", "user_id", "value"], decimals=1)


def schema_drift(spark, d):
    """Drifted columns with how many rows carry a value in them on the side that has them."""
    source = load(spark, d, "orders")
    target = add_extra_column(drop_column(source, "o_orderpriority"), "scenario_extra").withColumn("o_custkey", F.col("o_custkey").cast("string"))
    report = drift_report(source, target)
    filled = [
        backfill_check(df, c).select(F.lit(c).alias("column_name"), "total_rows", "filled_rows")
        for df, c in ((source, "o_orderpriority"), (target, "scenario_extra"), (target, "o_custkey"))
    ]
    return report.join(filled[0].unionByName(filled[1]).unionByName(filled[2]), "column_name")


def _hash_pairs(spark, d):
    source, target = orders_pair(spark, d)
    return keyed.hash_pairs(source, target, _KEY, source.columns)


def _findings(spark, d):
    source, target = orders_pair(spark, d)
    return keyed.column_findings(source, target, _KEY, source.columns, 0.001)


def diff_hash_classes(spark, d):
    return keyed.class_counts(_hash_pairs(spark, d))


def diff_hash(spark, d):
    return compare(*orders_pair(spark, d), TableSpec("orders", "hash", keys=("o_orderkey",))).outcome


def diff_hash_bad_keys(spark, d):
    """A key that is not unique ends in a data-quality error, found in the same pass."""
    lines = load(spark, d, "lineitem")
    kept = lines.filter("l_orderkey % 97 <> 0")
    return compare(lines, kept, TableSpec("lineitem", "hash", keys=("l_orderkey", "l_linenumber"))).outcome


def diff_columns(spark, d):
    return compare(*orders_pair(spark, d), TableSpec("orders", "advanced", keys=("o_orderkey",))).outcome


def tolerant_diff(spark, d):
    """Diff classes under the tolerance, per key and with the number of differing columns."""
    pairs = _findings(spark, d)
    return pairs.filter("diff_class = 'value_diff'").select("o_orderkey", F.size("diffs").alias("n_columns"))


def value_diffs(spark, d):
    return keyed.value_diffs(_findings(spark, d), _KEY)


def value_diffs_by_column(spark, d):
    return keyed.value_diffs_by_column(_findings(spark, d), _KEY)


def mismatch_samples(spark, d):
    return keyed.keyed_samples(_findings(spark, d), _KEY)


def samples_audit(spark, d):
    samples = keyed.keyed_samples(_findings(spark, d), _KEY)
    return store_samples(samples, "run_1", "orders", ORDERS_NOW)


QUERIES = {
    "windowed_scan": windowed_scan,
    "expr_window_scan": expr_window_scan,
    "windowed_count": windowed_count,
    "window_bounds": window_bounds,
    "count_delta": count_delta,
    "diff_basic": diff_basic,
    "keys_only_in_source": keys_only_in_source,
    "keys_only_in_target": keys_only_in_target,
    "key_quality": key_quality,
    "duplicate_keys": duplicate_keys,
    "row_hash": row_hash,
    "canonical_rows": canonical,
    "schema_drift": schema_drift,
    "diff_hash_classes": diff_hash_classes,
    "diff_hash": diff_hash,
    "diff_hash_bad_keys": diff_hash_bad_keys,
    "diff_columns": diff_columns,
    "tolerant_diff": tolerant_diff,
    "value_diffs": value_diffs,
    "value_diffs_by_column": value_diffs_by_column,
    "mismatch_samples": mismatch_samples,
    "samples_audit": samples_audit,
}


def _keyed_outcome_sql(mode: str, counted: str, changed: str, what: str) -> str:
    return f"""WITH {ORDERS_PAIR_SQL}, c AS ({counted}),
    n AS (SELECT {_COUNTS},
      CAST((SELECT COUNT(*) FROM c WHERE cls = 'only_in_source') AS BIGINT) AS rows_only_in_source,
      CAST((SELECT COUNT(*) FROM c WHERE cls = 'only_in_target') AS BIGINT) AS rows_only_in_target,
      CAST((SELECT COUNT(*) FROM c WHERE cls = '{changed}') AS BIGINT) AS rows_with_mismatches)
    SELECT '{mode}' AS comparison_mode, source_count, target_count, source_count = target_count AS count_match,
      rows_only_in_source, rows_only_in_target, rows_with_mismatches, 'FAIL' AS raw_status,
      'Mismatches: ' || rows_only_in_target || ' only_in_target, ' || rows_only_in_source || ' only_in_source, '
        || rows_with_mismatches || ' {what}' AS error_message FROM n"""


_HASHED = f"SELECT {_HASH_CLASS} AS cls {_PAIRED}"
_VALUED = f"""SELECT CASE WHEN s.o_orderkey IS NULL THEN 'only_in_target' WHEN t.o_orderkey IS NULL THEN 'only_in_source'
  WHEN {_STATUS_DIFFERS} OR {_PRICE_DIFFERS} THEN 'value_diff' ELSE 'match' END AS cls {_PAIRED}"""

ORACLES = {
    "windowed_scan": "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-13 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'",
    "expr_window_scan": """SELECT * FROM events WHERE (ts >= TIMESTAMP '2024-01-13 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00')
        OR (event_type = 'error' AND ts < TIMESTAMP '2024-01-13 00:00:00')""",
    "windowed_count": "SELECT COUNT(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-06 00:30:00' AND ts < TIMESTAMP '2024-01-20 00:30:00'",
    "window_bounds": """SELECT event_id, ts, CAST(user_id % 10 AS INT) AS filter_days, CAST(event_id % 90 AS INT) AS safety_lag_minutes,
        ts - to_minutes(CAST(event_id % 90 AS INT)) AS window_end,
        ts - to_minutes(CAST(event_id % 90 AS INT)) - to_days(CAST(user_id % 10 AS INT)) AS window_start FROM events""",
    "count_delta": f"WITH {ORDERS_PAIR_SQL}, n AS (SELECT {_COUNTS}) SELECT *, source_count = target_count AS count_match, source_count - target_count AS delta FROM n",
    "diff_basic": f"""WITH {ORDERS_PAIR_SQL}, n AS (SELECT {_COUNTS})
        SELECT 'basic' AS comparison_mode, *, source_count = target_count AS count_match, CAST(NULL AS BIGINT) AS rows_only_in_source,
          CAST(NULL AS BIGINT) AS rows_only_in_target, CAST(NULL AS BIGINT) AS rows_with_mismatches,
          CASE WHEN source_count = target_count THEN 'PASS' ELSE 'FAIL' END AS raw_status,
          CASE WHEN source_count <> target_count THEN 'Count mismatch: target=' || target_count || ', source=' || source_count END AS error_message FROM n""",
    "keys_only_in_source": f"WITH {ORDERS_PAIR_SQL} SELECT o_orderkey, COUNT(*) AS n_rows FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t) GROUP BY 1",
    "keys_only_in_target": f"WITH {ORDERS_PAIR_SQL} SELECT o_orderkey, COUNT(*) AS n_rows FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) GROUP BY 1",
    "key_quality": """SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (l_orderkey IS NULL OR l_linenumber IS NULL) AS null_key_rows,
        COUNT(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys, COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_rows FROM lineitem""",
    "duplicate_keys": "SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1",
    "row_hash": """SELECT o_orderkey, sha256('{"o_custkey":"' || o_custkey || '","o_orderdate":"' || CAST(epoch(o_orderdate) AS BIGINT)
        || '","o_orderpriority":"' || o_orderpriority || '","o_orderstatus":"' || o_orderstatus || '","o_totalprice":"' || CAST(o_totalprice AS VARCHAR) || '"}') AS row_hash FROM orders""",
    "canonical_rows": """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, props, CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS ts,
        CAST(user_id AS VARCHAR) AS user_id, CAST(CAST(ROUND(CAST(CAST(value AS VARCHAR) AS DECIMAL(20, 6)), 1) AS DOUBLE) AS VARCHAR) AS value FROM events""",
    "schema_drift": """SELECT 'o_orderpriority' AS column_name, 'extra_in_source' AS drift, 'string' AS source_type, NULL AS target_type,
          COUNT(*) AS total_rows, COUNT(o_orderpriority) AS filled_rows FROM orders
        UNION ALL SELECT 'scenario_extra', 'extra_in_target', NULL, 'string', COUNT(*), 0 FROM orders
        UNION ALL SELECT 'o_custkey', 'type_mismatch', 'bigint', 'string', COUNT(*), COUNT(o_custkey) FROM orders""",
    "diff_hash_classes": f"WITH {ORDERS_PAIR_SQL} SELECT {_HASH_CLASS} AS diff_class, COUNT(*) AS n {_PAIRED} GROUP BY 1",
    "diff_hash": _keyed_outcome_sql("hash", _HASHED, "hash_diff", "hash_diff"),
    "diff_hash_bad_keys": """WITH s AS (SELECT * FROM lineitem), t AS (SELECT * FROM lineitem WHERE l_orderkey % 97 <> 0),
        n AS (SELECT (SELECT COUNT(*) FROM s) AS sc, (SELECT COUNT(*) FROM t) AS tc,
          (SELECT COUNT(DISTINCT (l_orderkey, l_linenumber)) FROM s) AS sd, (SELECT COUNT(DISTINCT (l_orderkey, l_linenumber)) FROM t) AS td)
        SELECT 'hash' AS comparison_mode, sc AS source_count, tc AS target_count, CAST(NULL AS BOOLEAN) AS count_match,
          CAST(NULL AS BIGINT) AS rows_only_in_source, CAST(NULL AS BIGINT) AS rows_only_in_target, CAST(NULL AS BIGINT) AS rows_with_mismatches,
          'DATA_QUALITY_ERROR' AS raw_status,
          'target: ' || (tc - td) || ' duplicate PK rows; source: ' || (sc - sd) || ' duplicate PK rows' AS error_message FROM n""",
    "diff_columns": _keyed_outcome_sql("advanced", _VALUED, "value_diff", "col_diff"),
    "tolerant_diff": f"""WITH {ORDERS_PAIR_SQL}, d AS (SELECT s.o_orderkey, CAST({_STATUS_DIFFERS} AS INT) + CAST({_PRICE_DIFFERS} AS INT) AS n_columns
        FROM s JOIN t USING (o_orderkey)) SELECT * FROM d WHERE n_columns > 0""",
    "value_diffs": f"WITH {ORDERS_PAIR_SQL}, {_VALUE_DIFFS_SQL} SELECT * FROM vd",
    "value_diffs_by_column": f"WITH {ORDERS_PAIR_SQL}, {_VALUE_DIFFS_SQL} SELECT column_name, COUNT(*) AS n FROM vd GROUP BY 1",
    "mismatch_samples": f"WITH {ORDERS_PAIR_SQL}, {_SAMPLES_SQL} SELECT * FROM samples",
    "samples_audit": f"""WITH {ORDERS_PAIR_SQL}, {_SAMPLES_SQL},
        numbered AS (SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY CASE mismatch_type WHEN 'only_in_target' THEN 1 WHEN 'only_in_source' THEN 2 ELSE 4 END,
          pk_values, column_name NULLS FIRST) AS BIGINT) AS sample_seq FROM samples)
        SELECT 'run_1' AS run_id, 'orders' AS table_name, sample_seq, mismatch_type, pk_values, column_name, source_value, target_value,
          TIMESTAMP '2000-01-01 00:30:00' AS captured_at FROM numbered""",
}
