"""A self-test from end to end: gate each scenario, damage a copy, compare, judge, store the verdicts."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.literals import literal_frame
from evenkeel.plans.compare import TablePair, run_tables
from evenkeel.plans.config import load_config, mode_routing, to_specs
from evenkeel.plans.scenario import applicability, apply_mutation, scenario_verdicts
from evenkeel.sources.window import window_bounds
from evenkeel.spec import SAMPLE_SCHEMA

STORED_SAMPLE_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("table_name", T.StringType()), T.StructField("sample_seq", T.LongType()),
    *[SAMPLE_SCHEMA[c] for c in ("mismatch_type", "column_name", "pk_values", "source_value", "target_value")],
    T.StructField("captured_at", T.TimestampNTZType()),
])


def run_scenarios(
    spark: SparkSession,
    scenarios: DataFrame,
    configs: DataFrame,
    key_columns: DataFrame,
    skip_columns: DataFrame,
    read: Callable[[str], DataFrame],
    run_id: str,
    now: datetime,
    folder: str,
    parallel: int = 4,
) -> DataFrame:
    """Run the enabled scenarios and return one verdict each, which is also appended to
    ``folder/scenario_results``; results, samples and the run's own row are stored beside it.

    ``read`` gives a compared table by name. Every scenario is compared as a table of its own, named by
    its id. What a scenario does to a table is a plan over it, so nothing is copied or restored; scenarios of one table are
    compared with it together, so it is read as a source once for them.
    """
    loaded = load_config(configs, key_columns, skip_columns, disabled=True)
    gate = applicability(scenarios, mode_routing(loaded)).select("scenario_id", "applicable")
    listed = scenarios.filter("enabled").join(gate, "scenario_id")
    specs = {s.name: s for s in to_specs(loaded)}

    def pair(row) -> TablePair:
        spec, params = specs[row.target_table], json.loads(row.mutation_params or "{}")
        at = window_bounds(now, spec.effective_days, spec.effective_lag)[1] - timedelta(hours=1)
        keys = () if row.mutation_type == "clear_key_cols" else spec.keys
        return TablePair(
            replace(spec, name=row.scenario_id, keys=keys), lambda: read(row.target_table),
            lambda: apply_mutation(read(row.target_table), row.mutation_type, params, spec.keys, at, row.scenario_id, spec.filter_column),
            row.target_table,
        )

    pairs = [pair(r) for r in listed.filter("applicable").orderBy("scenario_id").toLocalIterator()]
    literal_frame(spark, [], STORED_SAMPLE_SCHEMA).write.mode("append").parquet(f"{folder}/samples")
    results = run_tables(spark, pairs, run_id, now, f"{folder}/results", f"{folder}/samples", parallel=parallel, run_path=f"{folder}/runs")
    samples = spark.read.schema(STORED_SAMPLE_SCHEMA).parquet(f"{folder}/samples").filter(F.col("run_id") == run_id)
    runs = listed.withColumns({
        "compared_table": F.col("target_table"), "target_table": F.col("scenario_id"), "run_id": F.lit(run_id),
        "seeder_status": F.when(F.col("applicable"), "applied").otherwise("not_applicable"),
    })
    tables = runs.select("scenario_id", "compared_table")
    verdicts = scenario_verdicts(runs, results, samples).drop("target_table").join(tables, "scenario_id").withColumnRenamed("compared_table", "target_table")
    verdicts.write.mode("append").parquet(f"{folder}/scenario_results")
    return spark.read.schema(verdicts.schema).parquet(f"{folder}/scenario_results").filter(F.col("engine_run_id") == run_id)
