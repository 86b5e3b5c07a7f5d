"""Which columns were renamed: columns of one side only are matched with those of the other by what they hold.

One aggregate per side gives for each such column its rows, nulls, an order-free sum of the digests of its values and a
distinct-count sketch; a few numbers per column are all that is moved. Columns whose sums agree hold the same values as
often. Where rows have been lost or changed too, the sketches tell how many distinct values two columns share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions import sqltext
from evenkeel.functions.canonical import canonical
from evenkeel.functions.literals import literal_frame
from evenkeel.functions.sqltext import name
from evenkeel.functions.types import type_of
from evenkeel.sources.tables import snapshot

#: Share of distinct values that two columns have in common from which one may be the other renamed.
SHARED = 0.8
RENAMES_SCHEMA = T.StructType([
    T.StructField("source_column", T.StringType()), T.StructField("target_column", T.StringType()),
    T.StructField("match", T.StringType()), T.StructField("shared", T.DoubleType()), T.StructField("unique", T.BooleanType()),
])


def column_facts(df: DataFrame, columns) -> DataFrame:
    """One row per column: rows, nulls, two halves of the sum of its digests, and a sketch of its distinct values."""
    facts = []
    for c in columns:
        value = canonical(name(c), type_of(df, c))
        digest = f"xxhash64({value})"
        facts.append(sqltext.struct({
            "column": sqltext.text(c), "n": "count(1)", "nulls": f"count_if({name(c)} IS NULL)",
            "low": f"coalesce(sum(if({name(c)} IS NULL, 0L, {digest} & 4294967295L)), 0L)",
            "high": f"coalesce(sum(if({name(c)} IS NULL, 0L, shiftrightunsigned({digest}, 32))), 0L)",
            "sketch": f"hll_sketch_agg({value})",
        }))
    one = df.agg(F.expr(f"array({', '.join(facts)})").alias("facts"))
    return one.select(F.inline("facts"))


def column_renames(source: DataFrame, target: DataFrame, shared: float = SHARED) -> DataFrame:
    """One row per pair of columns that may be one column renamed: source_column, target_column, match (``identical`` or
    ``similar``), shared (the estimated share of common distinct values) and unique (whether neither has another match as
    good). A column of nulls alone matches nothing. Pairs are those of columns, of which a table has few."""
    lone = [c for c in source.columns if c not in set(target.columns)], [c for c in target.columns if c not in set(source.columns)]
    if not all(lone):
        return literal_frame(source.sparkSession, [], RENAMES_SCHEMA)
    s, t = (snapshot(column_facts(df, sorted(cs)).filter("nulls < n"), "columns") for df, cs in zip((source, target), lone))
    # all columns of both sides are one row with two short arrays
    sides = s.withColumn("side", F.lit("s")).unionByName(t.withColumn("side", F.lit("t")))
    fact = "named_struct('column', column, 'n', n, 'nulls', nulls, 'low', low, 'high', high, 'sketch', sketch)"
    both = sides.agg(*[F.expr(f"collect_list(if(side = '{x}', {fact}, NULL)) AS {x}") for x in "st"])
    sizes = "hll_sketch_estimate(s.sketch) AS a", "hll_sketch_estimate(t.sketch) AS b", "hll_sketch_estimate(hll_union(s.sketch, t.sketch)) AS both"
    same = " AND ".join(f"s.{c} = t.{c}" for c in ("n", "nulls", "low", "high"))
    pairs = both.selectExpr("explode(s) AS s", "t").selectExpr("s", "explode(t) AS t").selectExpr(
        "s.column AS source_column", "t.column AS target_column", f"{same} AS same", *sizes,
    ).selectExpr("source_column", "target_column", "same", "greatest(0D, least(1D, (a + b - both) / CAST(both AS DOUBLE))) AS shared")
    found = pairs.filter(f"same OR shared >= {float(shared)!r}D").selectExpr(
        "source_column", "target_column", "if(same, 'identical', 'similar') AS match", "if(same, 1D, shared) AS shared"
    )
    best = "count_if(match = 'identical') OVER (PARTITION BY {0}) AS identical_{0}, count(1) OVER (PARTITION BY {0}) AS any_{0}"
    ranked = found.selectExpr("*", *best.format("source_column").split(", "), *best.format("target_column").split(", "))
    # a similar column is no rival of an identical one
    rivals = [f"if(match = 'identical', identical_{c}, any_{c}) = 1" for c in ("source_column", "target_column")]
    kept = ranked.filter("match = 'identical' OR (identical_source_column = 0 AND identical_target_column = 0)")
    return kept.selectExpr("source_column", "target_column", "match", "shared", f"{' AND '.join(rivals)} AS unique")
