"""A corpus from raw documents to packed bins: toxicity, exact copies, near copies, test passages, packing.

Each stage takes what its predecessor kept, as a table. All but the last return the columns of ``documents`` and leave
kept documents as they are.

Defined results: documents without an id go through (no stage can name them), null and empty texts are equal to each other
and end before packing, as they have no words; repeated rows are equal texts, of which one stays; very long texts are read
whole by every stage; empty tables give empty results; columns beside those of ``documents`` are kept until packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm import decontamination, jaccard, packing, recipes, toxicity
from evenkeel.sources.tables import delete_path, scratch_path, scratch_scope


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network scores below the threshold; it learns from the labels of the documents it is given."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return recipes.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links connect, the one with the smallest id: 5-word shingles, a similarity of 0.8."""
    return jaccard.keep_first(docs, length=5, percent=80)


def without_test_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which fewer than one word in 20 belongs to a window of a benchmark item."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of 2,048 words, without two documents of a source or two equal texts in one."""
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("decontamination", without_test_passages),
    ("packing", packed),
]

#: A trained network and best-fit packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``. What a stage writes on its way is deleted when its result is
    written, and that result when the next one is; only the last stage's findings stay, as its rows are read from them."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch_scope(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before is not None:
            delete_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
