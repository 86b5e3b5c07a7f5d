"""Exact copies by content-defined chunk recipes, with DataFrame functions only.

Each text is cut where its content says so: at the first sentence or line end after ``least`` characters, or
after ``most`` where there is none. A chunk is known by a 64-bit key that is verified by its SHA-256: where two
different chunks share a key, each gets an ordinal. A text is then the ordered list of its chunk identifiers,
and two texts are equal when their lists are. The text is read once; what moves afterwards is about 2 % of it.

Defined results: a null text counts as empty, empty texts are copies of each other, rows that are repeated with
their id count as copies (one row stays), a null id sorts below all others, an empty table gives an empty
result, and other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.sources.tables import snapshot

LEAST, MOST = 512, 4096


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The text as an array of chunks, in order and without gaps."""
    cut = rf"(?s).{{{least},{most - 1}}}?[.\n]|(?s).{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(cut), 0)


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, most: int = MOST) -> DataFrame:
    """One row per row of ``docs``: doc_id, row (a number of its own), text_sha256 and parts, the array of
    chunk keys and digests. Written to the shared folder, so that the texts are read once."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    part = lambda c: F.struct(F.xxhash64(c).alias("key"), F.unhex(F.sha2(c, 256)).alias("digest"))
    return snapshot(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            F.sha2(text, 256).alias("text_sha256"),
            F.transform(chunks(text, least, most), part).alias("parts"),
        ),
        "recipes",
    )


def chunk_index(parts: DataFrame) -> DataFrame:
    """One row per different chunk: key, digest, n_uses. Counted in the map task first, so a chunk that most
    texts hold is a row per task in the shuffle."""
    used = parts.select(F.explode("parts").alias("part")).select("part.key", "part.digest")
    return used.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("n_uses"))


def _collisions(parts: DataFrame) -> DataFrame:
    """key, digest and ordinal of chunks that share their key with another one; hardly ever a row."""
    index = chunk_index(parts)
    shared = index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    several = index.join(shared, "key").groupBy("key").agg(F.array_sort(F.collect_list("digest")).alias("digests"))
    return several.select("key", F.posexplode("digests").alias("ordinal", "digest"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, most: int = MOST) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_chunks.

    Of equal texts the row with the largest id stays. A group of copies of any size is counted in the map
    tasks first; the join that brings the count back meets one row per different text.
    """
    parts = recipes(docs, id_col, text_col, least, most)
    part = parts.select("row", F.posexplode("parts").alias("pos", "part")).select("row", "pos", "part.key", "part.digest")
    named = part.join(_collisions(parts), ["key", "digest"], "left").select(
        "row", F.struct("pos", "key", F.coalesce("ordinal", F.lit(0)).alias("ordinal")).alias("entry")
    )
    lists = named.groupBy("row").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    lists = lists.select("row", F.transform("entries", lambda e: F.struct(e["key"], e["ordinal"])).alias("recipe"))
    texts = parts.select("doc_id", "row", "text_sha256", F.size("parts").alias("n_chunks")).join(lists, "row", "left")
    nothing = F.array().cast("array<struct<key:bigint,ordinal:int>>")
    texts = snapshot(texts.withColumn("recipe", F.coalesce("recipe", nothing)), "recipe-lists")
    groups = texts.groupBy("recipe").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    groups = snapshot(groups, "groups")  # a join of two plain exchanges, which adaptive execution can split
    return texts.join(groups, "recipe").select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
        F.col("n_chunks").cast("long").alias("n_chunks"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    found = snapshot(copies(docs, id_col, text_col), "copies")
    kept = found.filter("kept").select(F.col("doc_id").alias("keep"), F.col("text_sha256").alias("keep_sha"))
    whole = docs.select(F.struct("*").alias("whole"), F.col(id_col).alias("id"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("sha"))
    out = whole.join(kept, F.col("id").eqNullSafe(F.col("keep")) & (F.col("sha") == F.col("keep_sha")), "left_semi")
    repeated = found.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").take(1)
    return (out.dropDuplicates(["id", "sha"]) if repeated else out).select("whole.*")


def op3_chunk_recipes(spark, d: str) -> DataFrame:
    return copies(spark.read.parquet(f"{d}/documents.parquet")).drop("n_chunks")


QUERIES = {"op3_chunk_recipes": op3_chunk_recipes}
ORACLES = {
    "op3_chunk_recipes": r"""
WITH t AS (SELECT doc_id, COALESCE(text, '') AS text FROM documents)
SELECT doc_id, MAX(doc_id) OVER w AS keep_id, COUNT(*) OVER w AS group_size, doc_id = MAX(doc_id) OVER w AS kept,
  sha256(text) AS text_sha256
FROM t WINDOW w AS (PARTITION BY text)"""
}
