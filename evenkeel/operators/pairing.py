"""Which column changed, without a key: surplus rows of both sides are paired if they agree in all columns but one.

A keyless diff says which rows one side has too many of. For each such row and each column, a digest of all other columns
is made; a row of either side under the same column and digest is a change of that column. Pairs are one to one, copies by
their count: a round gives every row its first column under which there are rows of both sides, pairs those that chose the
same, in order of the values, and goes on with what is left over of the rows that had a choice until no pair is found; a row
without one gets none later, as partners only become fewer. Only surplus rows are handled, so the work is that of the damage; a digest under which very many rows meet is dealt into lanes first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions import sqltext
from evenkeel.functions.canonical import canonical_columns
from evenkeel.operators import multiset
from evenkeel.operators.segments import digest_of
from evenkeel.sources.tables import snapshot

#: Rows of one side under a digest up to which they are ordered in one task.
LANE_ROWS = 100_000


def _surplus(source: DataFrame, target: DataFrame, columns, form) -> DataFrame:
    """Surplus rows with their columns' texts: mark (of the digest), side, n and texts (by column, in order). A digest is two
    64-bit words of the values as they are; texts are made of surplus rows alone."""
    sides = dict(zip("st", multiset.aligned(source, target, columns, form)))
    words = {k: [f"{digest_of(df, [], columns, seed, form)} AS __w{seed}" for seed in (0, 1)] for k, df in sides.items()}
    tagged = [sides[k].selectExpr(*words[k], f"{n}L AS __n") for k, n in (("s", 1), ("t", -1))]
    # like rows of both sides cancel each other
    counted = tagged[0].unionByName(tagged[1]).groupBy("__w0", "__w1").agg(F.expr("sum(__n) AS n")).filter("n <> 0")
    picked = snapshot(counted.selectExpr("__w0", "__w1", "if(n > 0, 's', 't') AS side", "abs(n) AS n"), "buckets")
    picks = picked.count()

    def content(side: str) -> DataFrame:
        df = sides[side]
        rows, own = df.selectExpr("*", *words[side]), picked.filter(f"side = '{side}'").withColumnsRenamed({"side": "__side", "n": "__n"})
        if picks * 64 <= multiset._BROADCAST_BYTES:
            own = F.broadcast(own)
        else:
            rows = multiset.sieved(rows, "__w0", own, "__w0", picks)
        texts = canonical_columns(df, columns, **form)
        return rows.join(own, ["__w0", "__w1"]).selectExpr(
            "concat(CAST(__w0 AS STRING), ' ', CAST(__w1 AS STRING)) AS mark", "__side AS side", "__n AS n", f"array({', '.join(texts.values())}) AS texts")

    # every copy of a row brings its content; one is enough
    return content("s").unionByName(content("t")).groupBy("mark", "side", "n").agg(F.expr("max(texts) AS texts"))


def _choices(rows: DataFrame, columns, turn: int) -> DataFrame:
    """The rows that have a partner under some column, each under the first such: column, digest and lane."""
    others = [f"xxhash64({k}, " + ", ".join(f"texts[{j}] IS NULL, texts[{j}]" for j in range(len(columns)) if j != k) + ")" for k in range(len(columns))]
    if len(columns) == 1:
        others = ["0L"]
    left_out = rows.selectExpr("mark", "side", "n", f"posexplode(array({', '.join(others)})) AS (place, rest)")
    sizes = left_out.groupBy("place", "rest").agg(F.expr("count_if(side = 's') AS n_s"), F.expr("count_if(side = 't') AS n_t")).filter("n_s > 0 AND n_t > 0")
    first = left_out.join(sizes, ["place", "rest"]).groupBy("mark", "side").agg(F.expr("min(struct(place, rest, n_s, n_t)) AS c"))
    lanes = f"CAST(ceil(greatest(c.n_s, c.n_t) / {LANE_ROWS}D) AS BIGINT)"
    chosen = first.selectExpr("mark", "side", "c.place", "c.rest", f"pmod(xxhash64(mark, {turn}), {lanes}) AS lane")
    return rows.join(chosen, ["mark", "side"])


def _paired(chosen: DataFrame) -> DataFrame:
    """Pair the rows of a group in order of the changed value: copies are runs of places, and a pair is where a run of
    either side overlaps. Each row of a group is met once, at the place where its run begins."""
    value = "texts[place]"
    begun = chosen.selectExpr(
        "place", "rest", "lane", "side", "mark", f"{value} AS value",
        f"sum(n) OVER (PARTITION BY place, rest, lane, side ORDER BY {value}, mark ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS begin", "n",
    )
    struct = "named_struct('mark', mark, 'value', value, 'end', begin + n)"
    runs = begun.selectExpr("place", "rest", "lane", "begin", f"if(side = 's', {struct}, NULL) AS s", f"if(side = 't', {struct}, NULL) AS t")
    starts = runs.groupBy("place", "rest", "lane", "begin").agg(F.expr("max(s) AS s"), F.expr("max(t) AS t"))
    by = "(PARTITION BY place, rest, lane ORDER BY begin"
    met = starts.selectExpr(
        "place", "begin", f"last_value(s) IGNORE NULLS OVER {by} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s",
        f"last_value(t) IGNORE NULLS OVER {by} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS t",
    )
    return met.selectExpr("place", "s", "t", "least(s.end, t.end) - begin AS n").filter("s IS NOT NULL AND t IS NOT NULL AND n > 0").selectExpr(
        "place", "s.mark AS source_mark", "t.mark AS target_mark", "s.value AS source_value", "t.value AS target_value", "n"
    )


def _left_over(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows with the copies that are in no pair."""
    used = pairs.selectExpr("source_mark AS mark", "'s' AS side", "n AS used").unionByName(pairs.selectExpr("target_mark AS mark", "'t' AS side", "n AS used"))
    used = used.groupBy("mark", "side").agg(F.sum("used").alias("used"))
    return rows.join(used, ["mark", "side"], "left").selectExpr("mark", "side", "n - coalesce(used, 0) AS n", "texts").filter("n > 0")


def pair_changes(source: DataFrame, target: DataFrame, columns, **form) -> DataFrame:
    """One row per pair of surplus rows that differ in one column: change (``changed``), column_name, source_value,
    target_value, n_rows (copies), row (JSON of the source row). Surplus rows without such a partner are rows too, as
    ``only_in_source`` or ``only_in_target``, with nulls for the column and values."""
    columns = sorted(columns)
    every = snapshot(_surplus(source, target, columns, form), "surplus")
    rows, pairs, turn = every, None, 0
    while True:
        chosen = snapshot(_choices(rows, columns, turn), "choices")
        found = snapshot(_paired(chosen), "pairs")
        if found.isEmpty():
            break
        pairs = found if pairs is None else pairs.unionByName(found)
        rows, turn = snapshot(_left_over(chosen, found), "surplus"), turn + 1
        if rows.isEmpty():
            break
    rows = every if pairs is None else _left_over(every, pairs)
    text = sqltext.json(sqltext.struct({c: f"texts[{k}]" for k, c in enumerate(columns)})) + " AS row"
    alone = rows.selectExpr(
        "if(side = 's', 'only_in_source', 'only_in_target') AS change", "CAST(NULL AS STRING) AS column_name",
        "CAST(NULL AS STRING) AS source_value", "CAST(NULL AS STRING) AS target_value", "n AS n_rows", text,
    )
    if pairs is None:
        return alone
    content = every.filter("side = 's'").selectExpr("mark AS source_mark", text)
    column = f"element_at(array({', '.join(sqltext.text(c) for c in columns)}), place + 1) AS column_name"
    return pairs.join(content, "source_mark").selectExpr("'changed' AS change", column, "source_value", "target_value", "n AS n_rows", "row").unionByName(alone)


def changes_by_column(changes: DataFrame) -> DataFrame:
    """Rows per kind of change and column."""
    return changes.groupBy("change", "column_name").agg(F.expr("CAST(sum(n_rows) AS BIGINT) AS n_rows"))
