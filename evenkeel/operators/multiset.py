"""Keyless diff: both sides as multisets of rows.

One ``groupBy`` on the row digest over the union of both tagged sides counts each distinct row on
either side. Copies collapse inside the map tasks; 32 bytes per distinct row are shuffled, however
wide the rows are. Evidence is fetched afterwards, for the few rows that are shown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.errors import ConfigError
from evenkeel.functions.canonical import canonical_rows, quick_digest, quick_words, row_digest, row_json
from evenkeel.functions.topk import top_per_group
from evenkeel.operators.columns import align
from evenkeel.operators.sieve import sieved
from evenkeel.sources.tables import snapshot


def aligned(source: DataFrame, target: DataFrame, columns, form) -> tuple[DataFrame, DataFrame]:
    """Both sides under the types in which a keyless mode compares them."""
    if not columns:
        raise ConfigError("no columns to compare after applying the skip list and the drift policy")
    return align(source, target, columns, exact=not form.get("round_decimals") or form.get("decimals") is None)


def _tagged(source: DataFrame, target: DataFrame, columns, form) -> DataFrame:
    s, t = aligned(source, target, columns, form)

    def tag(df: DataFrame, *side: str) -> DataFrame:
        return df.selectExpr(f"unhex({row_digest(df, columns, **form)}) AS __digest", *side)

    return tag(s, "1 AS __s", "0 AS __t").unionByName(tag(t, "0 AS __s", "1 AS __t"))


#: Bytes of a pick in a broadcast table, and how many of them a broadcast may have.
_PICK_BYTES, _BROADCAST_BYTES = 128, 32 * 1024 * 1024


def row_buckets(source: DataFrame, target: DataFrame, columns, **form) -> DataFrame:
    """Per distinct row: its digest and its number of copies on each side."""
    return (
        _tagged(source, target, columns, form)
        .groupBy("__digest")
        .agg(F.expr("sum(__s) AS n_source"), F.expr("sum(__t) AS n_target"))
    )


def condensed(buckets: DataFrame) -> DataFrame:
    """The diverging buckets, and one row without a digest that stands for all others."""
    equal = (
        buckets.filter("n_source = n_target")
        .agg(F.expr("coalesce(sum(n_source), 0) AS n_source"), F.expr("coalesce(sum(n_target), 0) AS n_target"))
        .selectExpr("CAST(NULL AS BINARY) AS __digest", "n_source", "n_target")
    )
    return buckets.filter("n_source <> n_target").unionByName(equal)


_BUCKET_CLASS = """CASE WHEN n_source = 0 THEN 'only_in_target_multiset' WHEN n_target = 0 THEN 'only_in_source_multiset'
    ELSE 'multiset_count_diff' END AS mismatch_type"""


def diverging_buckets(buckets: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with the class of the difference."""
    return buckets.filter("n_source <> n_target").selectExpr("lower(hex(__digest)) AS row_hash", _BUCKET_CLASS, "n_source", "n_target")


def multiset_outcome(buckets: DataFrame, mode: str) -> DataFrame:
    """The outcome row of a keyless mode. Equal totals with different content are inconclusive:
    without a key nothing says which row became which."""
    totals = {
        "source_count": "n_source",
        "target_count": "n_target",
        "rows_only_in_source": "greatest(n_source - n_target, 0)",
        "rows_only_in_target": "greatest(n_target - n_source, 0)",
        "n_buckets": "if(n_source <> n_target, 1, 0)",
    }

    def extra(side: str) -> str:
        n = f"rows_only_in_{side}"
        return f"if({n} > 0, concat({n}, if({n} = 1, ' extra row in ', ' extra rows in '), '{side}'), NULL)"

    sides = f"concat(concat_ws(', ', {extra('target')}, {extra('source')}), ' (', n_buckets, if(n_buckets = 1, ' distinct row', ' distinct rows'), ' affected; see samples)')"
    return buckets.agg(*[F.expr(f"CAST(coalesce(sum({e}), 0) AS BIGINT) AS {n}") for n, e in totals.items()]).selectExpr(
        f"'{mode}' AS comparison_mode",
        "source_count",
        "target_count",
        "source_count = target_count AS count_match",
        "rows_only_in_source",
        "rows_only_in_target",
        "CAST(0 AS BIGINT) AS rows_with_mismatches",
        "CASE WHEN n_buckets = 0 THEN 'PASS' WHEN source_count <> target_count THEN 'FAIL' ELSE 'INCONCLUSIVE' END AS raw_status",
        f"""CASE WHEN n_buckets = 0 THEN NULL WHEN source_count <> target_count THEN {sides}
            ELSE concat('contents differ while totals match: ', {sides}) END AS error_message""",
    )


def _with_evidence(picked: DataFrame, source: DataFrame, target: DataFrame, columns, form, broadcast_bytes: int, quick: bool) -> DataFrame:
    """Attach the content of each picked row. A digest finds it; its text is made after the join, for picked rows alone.
    The picks are counted first. While they are few they are broadcast; beyond, a filter of their digests keeps all but a
    few other rows from being shuffled. Each pick is one row, so a join cannot multiply, and one whose row has gone since
    is kept and says so."""
    n = picked.count()
    few = n * _PICK_BYTES <= broadcast_bytes
    marks = F.broadcast(picked.select("__digest")) if few else picked.select("__digest")
    facts = [c for c in picked.columns if c != "__digest"]
    s, t = aligned(source, target, columns, form)

    def found(df: DataFrame) -> DataFrame:
        # never null, so that the join needs no filter that would hash every row once more
        digest = quick_digest(quick_words(df, columns, **form)) if quick else f"coalesce(unhex({row_digest(df, columns, **form)}), X'')"
        rows = df.selectExpr("*", f"{digest} AS __digest")
        if not few:
            rows = sieved(rows, "__digest", marks, "__digest", n)
        return rows.join(marks, "__digest").selectExpr("__digest", f"{row_json(df, columns, **form)} AS evidence", *[f"CAST(NULL AS {picked.schema[c].dataType.simpleString()}) AS {c}" for c in facts])

    asked = picked.selectExpr("__digest", "CAST(NULL AS STRING) AS evidence", *facts)
    met = found(s).unionByName(found(t)).unionByName(asked).groupBy("__digest").agg(*[F.expr(f"max({c}) AS {c}") for c in ("evidence", *facts)])
    return met.filter(f"{facts[0]} IS NOT NULL").selectExpr("coalesce(evidence, 'row changed during the comparison') AS evidence", *facts)


def bucket_samples(
    source: DataFrame, target: DataFrame, columns, cap: int | None = None, buckets: DataFrame | None = None,
    broadcast_bytes: int = _BROADCAST_BYTES, quick: bool = False, **form
) -> DataFrame:
    """The diverging rows, or the first ``cap`` in digest order: content and copies on each side. ``buckets``
    are those of the same frames, if they are at hand; ``quick`` says that their digests are ``quick_digest``."""
    found = snapshot(condensed(row_buckets(source, target, columns, **form)), "buckets") if buckets is None else buckets
    quick = quick and buckets is not None
    picked = found.filter("n_source <> n_target")
    if cap is not None:
        picked = picked.orderBy("__digest").limit(cap)
    return _with_evidence(picked, source, target, columns, form, broadcast_bytes, quick).selectExpr(
        _BUCKET_CLASS,
        "evidence AS pk_values",
        "CAST(NULL AS STRING) AS column_name",
        "CAST(n_source AS STRING) AS source_value",
        "CAST(n_target AS STRING) AS target_value",
    )


def excess_rows(
    source: DataFrame, target: DataFrame, columns, cap: int | None = None, buckets: DataFrame | None = None,
    broadcast_bytes: int = _BROADCAST_BYTES, quick: bool = False, **form
) -> DataFrame:
    """Distinct surplus rows with their surplus; with a ``cap`` half of it for each side, in digest order."""
    found = snapshot(condensed(row_buckets(source, target, columns, **form)), "buckets") if buckets is None else buckets
    quick = quick and buckets is not None
    surplus = (
        found.filter("n_source <> n_target")
        .selectExpr("__digest", "if(n_source > n_target, 'source', 'target') AS side", "abs(n_source - n_target) AS surplus")
    )
    picked = surplus if cap is None else top_per_group(surplus, ["side"], ["__digest"], max(1, cap // 2))
    return _with_evidence(picked, source, target, columns, form, broadcast_bytes, quick).selectExpr(
        "concat('only_in_', side, '_no_pk') AS mismatch_type",
        "evidence AS pk_values",
        "CAST(NULL AS STRING) AS column_name",
        "if(side = 'source', CAST(surplus AS STRING), '0') AS source_value",
        "if(side = 'target', CAST(surplus AS STRING), '0') AS target_value",
    )


def except_all(left: DataFrame, right: DataFrame, columns, **form) -> DataFrame:
    """Canonical rows of ``left`` that ``right`` lacks, copies counted."""
    a, b = aligned(left, right, columns, form)
    return canonical_rows(a, columns, **form).exceptAll(canonical_rows(b, columns, **form))
