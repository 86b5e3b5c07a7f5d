"""One table pair to one verdict, and many pairs to a run."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.errors import ConfigError, SchemaDrift
from evenkeel.functions.canonical import decimals_for
from evenkeel.functions.literals import literal_frame
from evenkeel.functions.normal import normalised
from evenkeel.functions.sqltext import any_null
from evenkeel.operators import counts, keyed, keys as key_ops, many, multiset, segments, tolerant
from evenkeel.operators.columns import resolve_columns
from evenkeel.plans.config import missing_keys_message, route
from evenkeel.plans.verdict import append_run, as_result, samples_audit
from evenkeel.sources.tables import snapshot
from evenkeel.sources.window import scan, use_utc, window_bounds
from evenkeel.spec import OUTCOME_SCHEMA, RESULT_SCHEMA, SAMPLE_SCHEMA, TableSpec


@dataclass(frozen=True)
class Comparison:
    """``outcome`` is one row (``OUTCOME_SCHEMA``); ``samples`` (``SAMPLE_SCHEMA``) are the evidence for
    a raw status of FAIL or INCONCLUSIVE."""

    mode: str
    outcome: DataFrame
    evidence: Callable[[], DataFrame]

    @property
    def samples(self) -> DataFrame:
        return self.evidence()


def _failed(spark: SparkSession, mode: str, raw_status: str, message: str) -> Comparison:
    row = [(mode, None, None, None, None, None, None, raw_status, message)]
    return Comparison(mode, literal_frame(spark, row, OUTCOME_SCHEMA), lambda: literal_frame(spark, [], SAMPLE_SCHEMA))


def _basic_samples(source: DataFrame, target: DataFrame, spec: TableSpec, keep: bool) -> DataFrame:
    """Keys without a partner; one with a null has none on either side. With ``keep`` they are written to the shared folder,
    so that putting them in order does not count all keys once more."""
    null = any_null(spec.keys)
    lone = key_ops.key_counts(source, target, spec.keys).selectExpr(
        "*",
        f"""explode(array_compact(array(
            if(n_source > 0 AND (n_target = 0 OR {null}), 'only_in_source', NULL),
            if(n_target > 0 AND (n_source = 0 OR {null}), 'only_in_target', NULL)))) AS diff_class""",
    )
    return keyed.keyed_samples(snapshot(lone, "lone") if keep else lone, spec.keys, spec.sample_cap)


def compare(source: DataFrame, target: DataFrame, spec: TableSpec, keep: bool = False) -> Comparison:
    """Plan the comparison of two frames. Schema drift raises; every other finding is in the outcome.

    With ``keep`` the findings are written to the shared folder first, so that outcome and samples come
    from one pass. Without it nothing runs here, except for ``advanced``, whose digest pass decides for which
    keys the columns are compared one by one, for diffs by segments, whose sums decide which rows are, and for
    ``advanced_no_pk`` under a tolerance, which matches the rows that differ.
    """
    spark = source.sparkSession
    use_utc(spark)
    source, target = (normalised(df, spec.json_columns, spec.collations) for df in (source, target))
    try:
        mode = route(spec.mode, bool(spec.keys), spec.pk_fallback_strategy)
    except ConfigError as unknown:
        return _failed(spark, spec.mode, "ERROR", str(unknown))
    if mode is None:
        return _failed(spark, spec.mode, "DATA_QUALITY_ERROR", missing_keys_message(spec.mode, spec.name))

    if mode == "basic":
        return Comparison(
            mode, counts.diff_basic(source, target),
            lambda: _basic_samples(source, target, spec, keep) if spec.keys else literal_frame(spark, [], SAMPLE_SCHEMA),
        )

    columns = resolve_columns(source, target, spec.skip, spec.drift_policy)
    form = {"timestamp_unit": spec.timestamp_unit or "second"}
    if mode in ("hash_no_pk", "advanced_no_pk"):
        if not columns:
            return _failed(spark, mode, "DATA_QUALITY_ERROR", f"{mode}: no columns to compare for '{spec.name}'; "
                           "shorten its skip list or change its drift policy")
        pick, kept, quick = multiset.bucket_samples, False, False
        if mode == "advanced_no_pk":
            pick, form = multiset.excess_rows, form | {"decimals": decimals_for(spec.effective_tolerance), "round_decimals": True}
        if mode == "advanced_no_pk" and spec.effective_tolerance > 0:
            source, target = tolerant.aligned(source, target, columns)
            form, kept = {"timestamp_unit": form["timestamp_unit"], "decimals": None}, True
            quick = spec.sample_cap is None and bool(tolerant.tolerant_columns(source, columns, spec.effective_tolerance))  # a cap picks by SHA-256
            buckets = tolerant.tolerant_buckets(source, target, columns, spec.effective_tolerance, quick, timestamp_unit=form["timestamp_unit"])
        elif spec.by_segments:
            buckets, kept = segments.keyless_segments(source, target, columns, **form), True
        else:
            buckets = multiset.row_buckets(source, target, columns, **form)
        if keep and not kept:
            buckets = snapshot(multiset.condensed(buckets), "buckets")
        return Comparison(
            mode, multiset.multiset_outcome(buckets, mode),
            lambda: pick(source, target, columns, spec.sample_cap, buckets=buckets, quick=quick, **form),
        )

    absent = [k for k in spec.keys if k not in columns]
    if absent:
        text = "; ".join(f"PK column '{k}' missing in compared columns" for k in absent)
        return _failed(spark, mode, "DATA_QUALITY_ERROR", text)

    label = "hash_diff" if mode == "hash" else "value_diff"
    if mode == "advanced":
        findings = keyed.column_findings(source, target, spec.keys, columns, spec.effective_tolerance)
    elif spec.by_segments:
        findings = segments.keyed_segments(source, target, spec.keys, columns, spec.unique_keys, **form)
    else:
        findings = keyed.hash_pairs(source, target, spec.keys, columns, **form)
        if keep:
            findings = keyed.condensed(findings, spec.keys)
    if keep and not (spec.by_segments and mode == "hash"):
        findings = snapshot(findings, "findings")
    return Comparison(
        mode, keyed.keyed_outcome(findings, mode, label),
        lambda: keyed.keyed_samples(findings, spec.keys, spec.sample_cap),
    )


def _shape(source: DataFrame, target: DataFrame, spec: TableSpec) -> tuple | None:
    """What copies must have in common to be compared with one source at a time; ``None`` for one that is compared alone."""
    mode = route(spec.mode, bool(spec.keys), spec.pk_fallback_strategy)
    if mode not in ("hash", "hash_no_pk", "advanced") or spec.by_segments or spec.json_columns or spec.collations:
        return None
    columns = tuple(resolve_columns(source, target, spec.skip, spec.drift_policy))
    if not columns or not set(spec.keys) <= set(columns) or not many.alike(source, target, columns):
        return None
    return mode, () if mode == "hash_no_pk" else tuple(spec.keys), columns, spec.timestamp_unit or "second"


def compare_many(source: DataFrame, copies: dict[str, tuple[DataFrame, TableSpec]]) -> dict[str, Comparison]:
    """Compare several copies with one source, which is read and hashed once for all that are compared alike. Copies that
    cannot be compared this way are left out of the result; compare these one by one."""
    use_utc(source.sparkSession)
    groups: dict[tuple, list[str]] = {}
    for label, (target, spec) in copies.items():
        try:
            shape = _shape(source, target, spec)
        except (ConfigError, SchemaDrift):
            continue  # a finding of that copy alone
        if shape is not None:
            groups.setdefault(shape, []).append(label)
    out: dict[str, Comparison] = {}

    def planned(label: str, mode: str, findings: DataFrame, kind: str) -> Comparison:
        spec = copies[label][1]
        return Comparison(mode, keyed.keyed_outcome(findings, mode, kind), lambda: keyed.keyed_samples(findings, spec.keys, spec.sample_cap))

    for (mode, keys, columns, unit), every in groups.items():
        for first in range(0, len(every), many.MOST_KEYED):
            labels = every[first : first + many.MOST_KEYED]
            if len(labels) < 2:
                continue
            targets = {x: copies[x][0] for x in labels}
            if mode == "hash_no_pk":
                form = {"quick": all(copies[x][1].sample_cap is None for x in labels), "timestamp_unit": unit}  # a cap picks by SHA-256
                for x, buckets in many.keyless_many(source, targets, columns, **form).items():
                    out[x] = Comparison(
                        mode, multiset.multiset_outcome(buckets, mode),
                        lambda x=x, buckets=buckets, targets=targets, columns=columns, form=form: multiset.bucket_samples(
                            source, targets[x], columns, copies[x][1].sample_cap, buckets=buckets, **form),
                    )
            elif mode == "hash":
                for x, findings in many.keyed_many(source, targets, keys, columns, timestamp_unit=unit).items():
                    out[x] = planned(x, mode, findings, "hash_diff")
            else:
                for x, digests in many.keyed_many(source, targets, keys, columns, decimals=None, timestamp_unit="microsecond").items():
                    findings = keyed.column_findings(source, targets[x], keys, columns, copies[x][1].effective_tolerance, digests)
                    out[x] = planned(x, mode, snapshot(findings, "findings"), "value_diff")
    return out


@dataclass(frozen=True)
class TablePair:
    """Where the two sides of a spec come from; read when the table's turn comes. Pairs of one ``source_name`` have the
    same source, and those of them with one window are compared with it together."""

    spec: TableSpec
    source: Callable[[], DataFrame]
    target: Callable[[], DataFrame]
    source_name: str | None = None


def _source(pair: TablePair, now: datetime, trusted: bool) -> DataFrame:
    spec = pair.spec
    return scan(pair.source(), spec.filter_column_source or spec.filter_column, *window_bounds(now, spec.effective_days, spec.effective_lag), trusted)


def _target(pair: TablePair, now: datetime, trusted: bool) -> DataFrame:
    spec = pair.spec
    return scan(pair.target(), spec.filter_column, *window_bounds(now, spec.effective_days, spec.effective_lag), trusted)


def _groups_by_source(pairs) -> list[list[int]]:
    """Places in the list of pairs that share a source and a window; pairs that share it with none are left out."""
    groups: dict[tuple, list[int]] = {}
    for k, pair in enumerate(pairs):
        if pair.source_name is not None:
            spec = pair.spec
            groups.setdefault((pair.source_name, spec.filter_column_source or spec.filter_column, spec.effective_days, spec.effective_lag), []).append(k)
    return [places for places in groups.values() if len(places) > 1]


def _together(pairs, places: list[int], now: datetime, trusted: bool) -> dict[int, Comparison]:
    """Comparisons of pairs that share a source, by their places in the list."""
    copies = {}
    for k in places:
        try:
            copies[str(k)] = (_target(pairs[k], now, trusted), pairs[k].spec)
        except Exception:  # noqa: BLE001 - is found again, and told, when the pair is compared alone
            continue
    try:
        return {int(k): plan for k, plan in compare_many(_source(pairs[places[0]], now, trusted), copies).items()}
    except Exception:  # noqa: BLE001 - the same
        return {}


def _compared(
    spark: SparkSession, pair: TablePair, run_id: str, now: datetime, trusted: bool, by_column: bool, plan: Comparison | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Result row and samples of one pair; a failure is a result. ``plan`` is its comparison, if it is at hand."""
    spec, began, samples = pair.spec, time.monotonic(), None
    start, end = window_bounds(now, spec.effective_days, spec.effective_lag)
    meta = {"run_id": run_id, "table_name": spec.name, "window_start": start, "window_end": end,
            "safety_lag_minutes": spec.effective_lag, "executed_at": now}
    try:
        if plan is None:
            plan = compare(_source(pair, now, trusted), _target(pair, now, trusted), spec, keep=True)
        row = plan.outcome.first().asDict()
        if row["raw_status"] in ("FAIL", "INCONCLUSIVE"):
            samples = snapshot(samples_audit(plan.samples, run_id, spec.name, now, spec.sample_cap), "samples")
    except SchemaDrift as drift:
        row = {"comparison_mode": spec.mode, "raw_status": "SCHEMA_DRIFT", "error_message": str(drift)}
    except Exception as failure:  # noqa: BLE001 - one table must not stop the run
        row = {"comparison_mode": spec.mode, "raw_status": "ERROR", "error_message": str(failure)}
    outcome = literal_frame(spark, [[row.get(f.name) for f in OUTCOME_SCHEMA]], OUTCOME_SCHEMA)
    return as_result(outcome, meta, time.monotonic() - began, by_column), samples


def _union(frames) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def run_tables(
    spark: SparkSession,
    pairs,
    run_id: str,
    now: datetime,
    result_path: str,
    sample_path: str,
    trusted_expressions: bool = False,
    distinct_column_status: bool = False,
    parallel: int = 4,
    run_path: str | None = None,
) -> DataFrame:
    """Compare each pair inside its window, append results and samples as parquet, and return the
    results of the run. A table that fails becomes a result row; the others still run.

    ``parallel`` tables are compared at a time. Results and samples are written once per batch of four
    times as many, so a crash loses the batch at work and no more. With ``run_path`` the run itself is
    a row there, written before the first table and once more at the end.
    """
    use_utc(spark)
    pairs, size = list(pairs), max(1, parallel) * 4
    if run_path is not None:
        append_run(spark, run_path, run_id, now)
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        for k in range(0, len(pairs), size):
            batch = pairs[k : k + size]
            # groups come before all pairs, so that a pair that waits for its group never keeps that from a thread
            plans = {}
            for places in _groups_by_source(batch):
                plans |= dict.fromkeys(places, pool.submit(_together, batch, places, now, trusted_expressions))
            done = {
                i: pool.submit(lambda i: _compared(
                    spark, batch[i], run_id, now, trusted_expressions, distinct_column_status, plans[i].result().get(i) if i in plans else None), i)
                for i in sorted(range(len(batch)), key=lambda i: i in plans)
            }
            done = [done[i].result() for i in range(len(batch))]
            if samples := [s for _, s in done if s is not None]:
                _union(samples).write.mode("append").parquet(sample_path)
            _union([r for r, _ in done]).coalesce(1).write.mode("append").parquet(result_path)
    results = spark.read.schema(RESULT_SCHEMA).parquet(result_path).filter(F.col("run_id") == run_id)
    if run_path is not None:
        append_run(spark, run_path, run_id, now, results)
    return results
