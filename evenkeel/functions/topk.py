"""Ordered picks of a few rows per group that stay parallel however large a group is."""

from __future__ import annotations

from pyspark.sql import DataFrame

_LANES = 64


def top_per_group(df: DataFrame, groups, order, k: int, rank: str = "", lanes: int | None = None) -> DataFrame:
    """The first ``k`` rows of each group by ``order`` (SQL expressions), with their place if ``rank``
    names a column for it.

    Each input task belongs to one of ``lanes``, as many as there are shuffle partitions, 64 at least. The first window ranks inside (group, lane), where
    the planner keeps at most k rows per task before the shuffle; the second merges at most
    lanes * k rows per group. So no task ever holds a whole group, and the pick is the exact one.
    """
    lanes = lanes or max(_LANES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by, how, place = ", ".join(groups), ", ".join(order), rank or "__rank"
    picked = (
        df.selectExpr("*", f"spark_partition_id() % {lanes} AS __lane")
        .selectExpr("*", f"row_number() OVER (PARTITION BY {by}, __lane ORDER BY {how}) AS __rank_in_lane")
        .filter(f"__rank_in_lane <= {k}")
        .selectExpr("*", f"row_number() OVER (PARTITION BY {by} ORDER BY {how}) AS {place}")
        .filter(f"{place} <= {k}")
    )
    return picked.drop("__lane", "__rank_in_lane", "__rank")
