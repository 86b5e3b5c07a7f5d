"""Keyed diff: rows are paired by key, then compared by digest and, where asked, column by column.

The pairing is a union of both tagged sides and one ``groupBy`` on the key instead of a full outer
join. One shuffle of keys and digests then yields counts, key quality and differences together,
copies of a key are combined before they travel, and duplicate keys cannot multiply each other.
The column-by-column diff reads full rows only for the keys whose digests differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions import sqltext
from evenkeel.functions.canonical import digest_words, key_json, row_digest
from evenkeel.functions.predicates import differs
from evenkeel.functions.sqltext import any_null, name, names
from evenkeel.functions.topk import top_per_group
from evenkeel.functions.types import as_text, type_of
from evenkeel.operators.columns import align
from evenkeel.operators.keys import require_keys
from evenkeel.operators.sieve import sieved
from evenkeel.sources.tables import snapshot
from evenkeel.spec import PRESENT

# The order in which classes are stored.
DIFF_CLASSES = ("only_in_target", "only_in_source", "hash_diff", "value_diff")
_TAGS = {"source": ("1 AS __s", "0 AS __t"), "target": ("0 AS __s", "1 AS __t")}
_COUNTED = ("sum(__s) AS n_source", "sum(__t) AS n_target")
_BROADCAST_BYTES = 32 * 1024 * 1024


def _sorted_union(columns, keys) -> list[str]:
    return list(keys) + [c for c in columns if c not in set(keys)]


def _classify(changed: str, label: str, keys) -> str:
    return f"""CASE
        WHEN {any_null(keys)} THEN 'null_key'
        WHEN n_source > 1 OR n_target > 1 THEN 'duplicate_key'
        WHEN n_source = 0 THEN 'only_in_target'
        WHEN n_target = 0 THEN 'only_in_source'
        WHEN {changed} THEN '{label}'
        ELSE 'match' END AS diff_class"""


def hash_pairs(source: DataFrame, target: DataFrame, keys, columns, **form) -> DataFrame:
    """Per key: rows on each side and ``diff_class`` by digest of the non-key columns."""
    require_keys(source, keys)
    require_keys(target, keys)
    values = [c for c in columns if c not in set(keys)]
    s, t = align(source, target, _sorted_union(columns, keys))

    def narrow(df: DataFrame, side: str) -> DataFrame:
        hashed = df.selectExpr(*names(keys), f"{row_digest(df, values, **form)} AS __digest")
        w0, w1 = digest_words("__digest")
        return hashed.selectExpr(*names(keys), *_TAGS[side], f"{w0} AS __w0", f"{w1} AS __w1")

    # xor over one row per side is zero exactly when the two digests are equal
    pairs = (
        narrow(s, "source").unionByName(narrow(t, "target"))
        .groupBy(*names(keys))
        .agg(*[F.expr(e) for e in _COUNTED], F.expr("bit_xor(__w0) AS __x0"), F.expr("bit_xor(__w1) AS __x1"))
    )
    return pairs.selectExpr(*names(keys), "n_source", "n_target", _classify("__x0 <> 0 OR __x1 <> 0", "hash_diff", keys))


def condensed(pairs: DataFrame, keys) -> DataFrame:
    """The pairs that are no match, and one row with null keys that stands for all that are.

    It holds everything an outcome or a sample needs, and is as small as the damage.
    """
    nothing = [f"CAST(NULL AS {type_of(pairs, k).simpleString()}) AS {name(k)}" for k in keys]
    matched = (
        pairs.filter("diff_class = 'match'")
        .agg(F.expr("coalesce(sum(n_source), 0) AS n_source"), F.expr("coalesce(sum(n_target), 0) AS n_target"))
        .selectExpr(*nothing, "n_source", "n_target", "'match' AS diff_class")
    )
    return pairs.filter("diff_class <> 'match'").unionByName(matched)


def exact_findings(source: DataFrame, target: DataFrame, keys, columns) -> DataFrame:
    """The condensed digest pass under exact texts (no rounding, microseconds), kept in the shared
    folder. Equal texts mean equal values, so only its ``hash_diff`` keys can differ in a column."""
    pairs = hash_pairs(source, target, keys, columns, decimals=None, timestamp_unit="microsecond")
    return snapshot(condensed(pairs, keys), "pairs")


def _size(df: DataFrame) -> int:
    """Bytes of a frame of scalar columns, measured on its text, plus a fixed cost per value."""
    each = " + ".join(f"coalesce(octet_length(CAST({name(c)} AS STRING)), 0) + 16" for c in df.columns)
    return df.agg(F.expr(f"coalesce(sum({each}), 0) AS n")).first()["n"]


def column_findings(
    source: DataFrame, target: DataFrame, keys, columns, tolerance: float = 0.0, digests: DataFrame | None = None,
    broadcast_bytes: int = _BROADCAST_BYTES,
) -> DataFrame:
    """Condensed pairs under the tolerance: ``diff_class`` (``value_diff`` in place of ``hash_diff``)
    and ``diffs``, an array with one (column_name, source_value, target_value) per differing column.

    Two passes: digests find the keys that may differ, then full rows are fetched for these alone.
    The first pass runs at once, because the size of these keys decides how they are joined: up to
    ``broadcast_bytes`` they are broadcast and no other row is shuffled; beyond, a filter of the keys keeps all but a
    few other rows from that. Both sides' rows and the suspects themselves then meet in one ``groupBy`` on the key, so the
    counts are those of the first pass, and a row that has gone since is reported as a difference.
    """
    found = exact_findings(source, target, keys, columns) if digests is None else digests
    suspects = found.filter("diff_class = 'hash_diff'").select(*names(keys))
    known, n_many = suspects, 0
    if _size(suspects) <= broadcast_bytes:
        suspects = F.broadcast(suspects)
    else:
        n_many = max(1, suspects.count())
    values = sorted(c for c in columns if c not in set(keys))
    s, t = align(source, target, _sorted_union(columns, keys), exact=tolerance <= 0)

    row = sqltext.struct({c: name(c) for c in values}) if values else "named_struct('none', 1)"
    kind = s.selectExpr(f"{row} AS r").schema["r"].dataType.simpleString()

    key_hash = f"xxhash64({', '.join(names(keys))})"  # suspects have no nulls in their keys

    def rows(df: DataFrame, side: str) -> DataFrame:
        sides = [f"{row if x == side else f'CAST(NULL AS {kind})'} AS __{x}" for x in ("source", "target")]
        if n_many:
            df = sieved(df, key_hash, known, key_hash, n_many)
        return df.join(suspects, list(keys), "left_semi").selectExpr(*names(keys), *sides, "false AS __asked")

    asked = known.selectExpr(*names(keys), *[f"CAST(NULL AS {kind}) AS __{x}" for x in ("source", "target")], "true AS __asked")

    checks = []
    for c in values:
        dtype = type_of(s, c)
        a, b = f"__source.{name(c)}", f"__target.{name(c)}"
        detail = sqltext.struct({"column_name": sqltext.text(c), "source_value": as_text(a, dtype), "target_value": as_text(b, dtype)})
        checks.append(f"if({differs(a, b, dtype, tolerance)}, {detail}, NULL)")
    none = "CAST(array() AS ARRAY<STRUCT<column_name: STRING, source_value: STRING, target_value: STRING>>)"
    gone = sqltext.struct({"column_name": "CAST(NULL AS STRING)", **{
        f"{x}_value": f"if(__{x} IS NULL, 'row changed during the comparison', '{PRESENT}')" for x in ("source", "target")}})
    compared = f"array_compact(array({', '.join(checks)}))" if checks else none
    detailed = (
        rows(s, "source").unionByName(rows(t, "target")).unionByName(asked)
        .groupBy(*names(keys))
        .agg(*[F.expr(f"any_value(__{x}, true) AS __{x}") for x in ("source", "target")], F.expr("bool_or(__asked) AS __asked"))
        .filter("__asked")
        .selectExpr(*names(keys), f"if(__source IS NULL OR __target IS NULL, array({gone}), {compared}) AS diffs")
        .selectExpr(
            *names(keys), "CAST(1 AS BIGINT) AS n_source", "CAST(1 AS BIGINT) AS n_target",
            "if(size(diffs) > 0, 'value_diff', 'match') AS diff_class", "diffs",
        )
    )
    return found.filter("diff_class <> 'hash_diff'").selectExpr("*", f"{none} AS diffs").unionByName(detailed)


def class_counts(pairs: DataFrame) -> DataFrame:
    """Number of keys per diff class."""
    return pairs.groupBy("diff_class").agg(F.expr("count(1) AS n"))


def value_diffs(pairs: DataFrame, keys) -> DataFrame:
    """One row per (key, column) that differs, with both values as text."""
    return (
        pairs.filter("diff_class = 'value_diff'")
        .selectExpr(*names(keys), "explode(diffs) AS d")
        .selectExpr(*names(keys), "d.column_name", "d.source_value", "d.target_value")
    )


def value_diffs_by_column(pairs: DataFrame, keys) -> DataFrame:
    return value_diffs(pairs, keys).groupBy("column_name").agg(F.expr("count(1) AS n"))


def keyed_outcome(pairs: DataFrame, mode: str, label: str) -> DataFrame:
    """The outcome row of a keyed mode, from pairs or from their condensed form: counts and
    differences, or the key-quality error."""
    totals = {
        "source_count": "n_source",
        "target_count": "n_target",
        "null_source": "if(diff_class = 'null_key', n_source, 0)",
        "null_target": "if(diff_class = 'null_key', n_target, 0)",
        "dup_source": "if(diff_class = 'match', 0, greatest(n_source - 1, 0))",
        "dup_target": "if(diff_class = 'match', 0, greatest(n_target - 1, 0))",
        "only_source": "if(diff_class = 'only_in_source', 1, 0)",
        "only_target": "if(diff_class = 'only_in_target', 1, 0)",
        "changed": f"if(diff_class = '{label}', 1, 0)",
    }
    what = {"hash_diff": "hash_diff", "value_diff": "col_diff"}[label]
    return (
        pairs.agg(*[F.expr(f"CAST(coalesce(sum({e}), 0) AS BIGINT) AS {n}") for n, e in totals.items()])
        .selectExpr(
            "*",
            """concat_ws('; ',
                if(null_target > 0, concat('target: ', null_target, ' rows with NULL PK values'), NULL),
                if(dup_target > 0, concat('target: ', dup_target, ' duplicate PK rows'), NULL),
                if(null_source > 0, concat('source: ', null_source, ' rows with NULL PK values'), NULL),
                if(dup_source > 0, concat('source: ', dup_source, ' duplicate PK rows'), NULL)) AS issues""",
            "only_source + only_target + changed = 0 AS clean",
        )
        .selectExpr(
            f"'{mode}' AS comparison_mode",
            "source_count",
            "target_count",
            "if(issues = '', source_count = target_count, NULL) AS count_match",
            "if(issues = '', only_source, NULL) AS rows_only_in_source",
            "if(issues = '', only_target, NULL) AS rows_only_in_target",
            "if(issues = '', changed, NULL) AS rows_with_mismatches",
            "CASE WHEN issues <> '' THEN 'DATA_QUALITY_ERROR' WHEN clean THEN 'PASS' ELSE 'FAIL' END AS raw_status",
            f"""CASE WHEN issues <> '' THEN issues WHEN NOT clean THEN concat('Mismatches: ', only_target, ' only_in_target, ',
                only_source, ' only_in_source, ', changed, ' {what}') END AS error_message""",
        )
    )


def keyed_samples(pairs: DataFrame, keys, cap: int | None = None) -> DataFrame:
    """All keys of each mismatch class as evidence rows; with a ``cap`` the first so many keys of a class."""
    detailed = "diffs" in pairs.columns
    shown = ", ".join(sqltext.text(c) for c in DIFF_CLASSES)
    picked = pairs.filter(f"diff_class IN ({shown})")
    if cap is not None:
        picked = top_per_group(picked, ["diff_class"], names(keys), cap)
    if detailed:
        picked = picked.selectExpr("*", "explode_outer(diffs) AS d")
    value = "CASE WHEN diff_class = 'value_diff' THEN d.{0}_value" if detailed else "CASE"
    marker = value + f" WHEN diff_class = 'only_in_{{0}}' THEN '{PRESENT}' END AS {{0}}_value"
    return picked.selectExpr(
        "diff_class AS mismatch_type",
        f"{key_json(keys, pairs)} AS pk_values",
        "d.column_name" if detailed else "CAST(NULL AS STRING) AS column_name",
        marker.format("source"),
        marker.format("target"),
    )
