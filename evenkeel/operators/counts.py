"""Row-count comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_delta(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: both counts, whether they match, and source minus target."""
    sides = source.selectExpr("1 AS __s", "0 AS __t").unionByName(target.selectExpr("0 AS __s", "1 AS __t"))
    return sides.agg(
        F.expr("CAST(coalesce(sum(__s), 0) AS BIGINT) AS source_count"),
        F.expr("CAST(coalesce(sum(__t), 0) AS BIGINT) AS target_count"),
    ).selectExpr("source_count", "target_count", "source_count = target_count AS count_match", "source_count - target_count AS delta")


def diff_basic(source: DataFrame, target: DataFrame) -> DataFrame:
    """The outcome row of mode ``basic``: equal counts or not."""
    return count_delta(source, target).selectExpr(
        "'basic' AS comparison_mode",
        "source_count",
        "target_count",
        "count_match",
        "CAST(NULL AS BIGINT) AS rows_only_in_source",
        "CAST(NULL AS BIGINT) AS rows_only_in_target",
        "CAST(NULL AS BIGINT) AS rows_with_mismatches",
        "if(count_match, 'PASS', 'FAIL') AS raw_status",
        "if(count_match, NULL, concat('Count mismatch: target=', target_count, ', source=', source_count)) AS error_message",
    )
