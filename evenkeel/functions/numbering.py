"""Row numbers over a whole group without one task that sorts it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.sources.tables import snapshot


def number_rows(df: DataFrame, groups, order, column: str) -> DataFrame:
    """Number the rows of each group from 1 by ``order`` (ascending SQL expressions, nulls first).

    The rows are cut into ranges of groups and order and written, so that every later look finds the same
    ranges. A row's number is its place in its range plus the rows of the ranges before it, of which there
    are as many as partitions.
    """
    ranks = [f"__order_{i}" for i in range(len(order))]
    keyed = df.selectExpr("*", *[f"{e} AS {r}" for e, r in zip(order, ranks)])
    ranged = snapshot(keyed.repartitionByRange(*groups, *ranks).withColumn("__range", F.spark_partition_id()), "ranges")
    by = ", ".join(groups)
    sizes = ranged.groupBy(*groups, "__range").agg(F.expr("count(1) AS __rows"))
    before = sizes.selectExpr(
        *groups, "__range",
        f"coalesce(sum(__rows) OVER (PARTITION BY {by} ORDER BY __range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS __before",
    )
    placed = ranged.selectExpr("*", f"row_number() OVER (PARTITION BY {by}, __range ORDER BY {', '.join(ranks)}) AS __place")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*groups, "__range")]
    joined = placed.alias("a").join(before.alias("b"), same)
    return joined.selectExpr(*[f"a.`{c}`" for c in df.columns], f"CAST(b.__before + a.__place AS BIGINT) AS {column}")
