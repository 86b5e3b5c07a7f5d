"""Self-test scenarios: does a known kind of damage lead to the status and evidence it must lead to?

Everything is a join of frames (scenarios, configs, results, samples), so one scenario and a million
of them are judged by the same plan.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.errors import ConfigError
from evenkeel.operators import drift
from evenkeel.spec import MUTATIONS

PARAMS = "count int, column string, column_name string, mutate boolean, expected_error_substring string"
_COLUMN_MUTATIONS = ("add_extra_column", "drop_column")
_DEFAULT_COUNTS = {"delete_rows_no_pk": 1, "insert_extra_rows_no_pk": 1}


def apply_mutation(
    df: DataFrame, mutation: str, params: dict, keys, at: datetime, scenario_id: str, filter_column: str | None = None
) -> DataFrame:
    """The damaged copy for one scenario. ``clear_key_cols`` damages the config, not the table."""
    if mutation not in MUTATIONS:
        raise ConfigError(f"unknown mutation {mutation!r}; known: {', '.join(MUTATIONS)}")
    count = {"count": int(params["count"])} if "count" in params else {}
    if mutation == "delete_rows":
        return drift.delete_rows(df, keys, filter_column=filter_column, **count)
    if mutation == "insert_extra_rows":
        return drift.insert_extra_rows(df, keys, at, filter_column=filter_column, **count)
    if mutation == "update_column":
        return drift.update_column(df, keys, params["column"], F.lit(f"SCENARIO_{scenario_id}"), at, filter_column=filter_column, **count)
    if mutation == "add_extra_column":
        return drift.add_extra_column(df, params.get("column_name", "scenario_extra"))
    if mutation == "drop_column":
        return drift.drop_column(df, params["column_name"], (*keys, filter_column))
    if mutation == "null_out_pk":
        return drift.null_out_key(df, keys, **count)
    if mutation == "delete_rows_no_pk":
        return drift.delete_rows_keyless(df, filter_column=filter_column, **count)
    if mutation == "insert_extra_rows_no_pk":
        mutate = bool(params.get("mutate", False))
        return drift.insert_extra_rows_keyless(df, at if mutate else None, mutate=mutate, suffix=f"_scn_{scenario_id}", filter_column=filter_column, **count)
    if mutation == "content_swap_no_pk":
        return drift.content_swap_keyless(df, suffix=f"_swap_{scenario_id}", filter_column=filter_column)
    return drift.noop(df)


def _all_of(notes) -> Column:
    """Notes joined in order; null if there are none."""
    text = F.concat_ws("; ", *notes)
    return F.when(text != "", text)


def applicability(scenarios: DataFrame, routed: DataFrame) -> DataFrame:
    """Per scenario: whether it can run against its table's config (the output of ``mode_routing``,
    enabled or not), and if not, why. Keyless fallbacks count as the mode that really runs."""
    config = routed.select(
        F.col("table_name").alias("target_table"),
        F.coalesce("effective_mode", "comparison_mode").alias("active_mode"),
        "schema_drift_policy",
        F.col("enabled").alias("config_enabled"),
        F.lit(True).alias("configured"),
    )
    modes = F.filter(F.transform(F.split(F.coalesce("valid_comparison_modes", F.lit("")), ","), lambda m: F.trim(m)), lambda m: m != "")
    reason = (
        F.when(F.col("configured").isNull(), "table has no config")
        .when(~F.col("config_enabled"), "table is disabled")
        .when((F.size(modes) > 0) & ~F.array_contains(modes, F.col("active_mode")), F.concat(F.lit("mode "), F.col("active_mode"), F.lit(" not listed")))
        .when(
            F.col("mutation_type").isin(*_COLUMN_MUTATIONS) & (F.col("schema_drift_policy") != "fail"),
            F.concat(F.lit("drift policy is "), F.col("schema_drift_policy")),
        )
    )
    return scenarios.join(config, "target_table", "left").select(
        "scenario_id", "target_table", "mutation_type", "active_mode",
        reason.isNull().alias("applicable"), reason.alias("reason"),
    )


def scenario_lint(scenarios: DataFrame, loaded: DataFrame) -> DataFrame:
    """Scenarios whose mutation touches a column that must stay: a key, a skipped or the filter column."""
    params = F.from_json("mutation_params", PARAMS)
    config = loaded.select(F.col("table_name").alias("target_table"), "key_cols", "skip_cols", "filter_column")
    column = F.when(F.col("mutation_type") == "update_column", params["column"]).when(
        F.col("mutation_type") == "drop_column", params["column_name"]
    )
    finding = (
        F.when(F.array_contains("key_cols", F.col("column")), "key_column")
        .when(F.array_contains("skip_cols", F.col("column")), "skipped_column")
        .when(F.col("filter_column") == F.col("column"), "filter_column")
    )
    return (
        scenarios.withColumn("column", column).filter("column is not null")
        .join(config, "target_table")
        .select("scenario_id", "target_table", "mutation_type", "column", finding.alias("finding"))
        .filter("finding is not null")
    )


MISMATCH_TYPES = (
    "hash_diff", "value_diff", "only_in_source", "only_in_target", "only_in_source_multiset", "only_in_target_multiset",
    "only_in_source_no_pk", "only_in_target_no_pk", "multiset_count_diff",
)


def sample_kinds(samples: DataFrame) -> DataFrame:
    """Per (run, table): a flag for each mismatch type that its samples show, and the columns that differ.
    One shuffle of flags, combined in the map task; the set is bounded by the table's columns."""
    flags = [F.bool_or(F.col("mismatch_type") == t).alias(f"has_{t}") for t in MISMATCH_TYPES]
    columns = F.collect_set(F.when(F.col("mismatch_type") == "value_diff", F.col("column_name"))).alias("diff_columns")
    return samples.groupBy("run_id", "table_name").agg(F.lit(True).alias("sampled"), *flags, columns)


def _evidence() -> tuple[Column, Column]:
    """(hard, note): texts that fail a scenario, and texts that are only recorded."""
    count, column, mutate = F.col("p.count"), F.col("p.column"), F.coalesce("p.mutate", F.lit(False))
    surplus = F.col("source_count") - F.col("target_count")
    error = F.coalesce("error_message", F.lit(""))
    sampled = F.coalesce("sampled", F.lit(False))

    def shown(*types: str) -> Column:
        return F.coalesce(F.greatest(*[F.coalesce(f"has_{t}", F.lit(False)) for t in (*types, types[0])]), F.lit(False))

    def text_of(number: Column) -> Column:
        return number.cast("string")

    both = F.concat(F.lit("; got source="), text_of(F.col("source_count")), F.lit(" target="), text_of(F.col("target_count")))
    no_counts = F.when(surplus.isNull(), "counts missing")

    def must(condition: Column, text: str) -> Column:
        return F.coalesce(no_counts, F.when(~condition, F.concat(F.lit(text), both)))

    def without(types, text: str) -> Column:
        return F.when(sampled & ~shown(*types), text)

    def off(share: float) -> Column:
        wanted = F.coalesce(count, F.lit(0))
        return F.when(
            (surplus >= 1) & (F.abs(surplus - wanted) > F.greatest(F.lit(2.0), wanted * share)),
            F.concat(F.lit("delta "), text_of(surplus), F.lit(" differs from requested "), text_of(wanted)),
        )

    column_diff = F.coalesce(F.array_contains("diff_columns", column), F.lit(False))
    needle = F.coalesce("p.expected_error_substring", F.lit(""))
    named = F.coalesce("p.column_name", F.lit(""))
    only_target = ("only_in_target_multiset", "only_in_target_no_pk")
    only_source = ("only_in_source_multiset", "only_in_source_no_pk")
    hard = {
        "delete_rows": must(surplus >= 1, "expected more source rows"),
        "insert_extra_rows": must(surplus <= -1, "expected more target rows"),
        "update_column": F.when(~(shown("hash_diff") | column_diff), "no hash_diff or value_diff sample for the column"),
        "clear_key_cols": F.when(~F.contains(error, needle), "error message lacks the expected text"),
        "delete_rows_no_pk": must(surplus >= 1, "expected more source rows"),
        "insert_extra_rows_no_pk": must(surplus <= -1, "expected more target rows"),
        "content_swap_no_pk": must(surplus == 0, "expected equal counts"),
    }
    unnamed = F.when((named != "") & ~F.contains(error, named), "error message does not name the column")
    note = {
        "delete_rows": _all_of([off(0.1), without(["only_in_source"], "no only_in_source samples")]),
        "insert_extra_rows": without(["only_in_target"], "no only_in_target samples"),
        "add_extra_column": unnamed,
        "drop_column": unnamed,
        "null_out_pk": F.when(~F.lower(error).rlike("null|pk"), "error message does not speak of a null key"),
        "delete_rows_no_pk": _all_of([off(0.5), without([*only_source, "multiset_count_diff"], "no source-side samples")]),
        "insert_extra_rows_no_pk": F.when(mutate, without(only_target, "no target-side samples")).otherwise(
            without(["multiset_count_diff", "only_in_target_no_pk"], "no duplicate samples")
        ),
        "content_swap_no_pk": F.when(sampled & ~(shown(*only_target) & shown(*only_source)), "samples of one side only"),
    }

    def choose(rules) -> Column:
        out = F.lit(None).cast("string")
        for mutation, rule in rules.items():
            out = F.when(F.col("mutation_type") == mutation, rule).otherwise(out)
        return out

    return choose(hard), choose(note)


def scenario_verdicts(runs: DataFrame, results: DataFrame, samples: DataFrame) -> DataFrame:
    """Judge scenario runs: expected against actual status, and the evidence of the mutation.

    ``runs`` is a scenario row plus ``run_id`` (null if the run produced none) and ``seeder_status``.
    """
    found = results.select(
        "run_id", F.col("table_name").alias("target_table"), F.col("status").alias("actual_status"),
        "source_count", "target_count", "error_message",
    )
    kinds = sample_kinds(samples).withColumnRenamed("table_name", "target_table")
    joined = (
        runs.join(found, ["run_id", "target_table"], "left")
        .join(kinds, ["run_id", "target_table"], "left")
        .withColumn("p", F.from_json(F.coalesce("mutation_params", F.lit("{}")), PARAMS))
    )
    for mutation, default in _DEFAULT_COUNTS.items():
        filled = F.coalesce(F.col("p.count"), F.lit(default))
        joined = joined.withColumn("p", F.when(F.col("mutation_type") == mutation, F.col("p").withField("count", filled)).otherwise(F.col("p")))
    hard, note = _evidence()
    skipped = F.col("seeder_status") == "not_applicable"
    absent = F.col("actual_status").isNull()
    same = F.col("actual_status") == F.col("expected_status")
    evidenced = F.col("hard").isNull()
    lead = F.when(~same, F.concat(F.lit("status mismatch: expected="), F.col("expected_status"), F.lit(" actual="), F.col("actual_status"))).when(
        ~evidenced, "status matched but evidence missing"
    )
    notes = (
        F.when(skipped, "scenario does not apply to this table")
        .when(F.col("run_id").isNull(), "run produced no id")
        .when(absent, "no result row for this run and table")
        .otherwise(_all_of([lead, F.col("hard"), F.col("note")]))
    )
    verdict = F.when(skipped, "not_applicable").when(absent, "inconclusive").when(same & evidenced, "pass").otherwise("fail")
    clean = ~F.coalesce(F.col("notes").rlike("missing|mismatch"), F.lit(False))
    return (
        joined.withColumns({"hard": hard, "note": note})
        .withColumns({"notes": notes, "verdict": verdict})
        .select(
            "scenario_id", "target_table", "mutation_type", F.col("run_id").alias("engine_run_id"), "expected_status",
            F.when(~skipped, F.col("actual_status")).alias("actual_status"),
            F.when(skipped, F.lit(None).cast("boolean")).when(absent, False).otherwise(evidenced & clean).alias("evidence_ok"),
            "verdict", "notes",
        )
    )
