"""Token counts of documents in flat token files, by a scan for their separators.

A token file is a stream of token ids with an end-of-document id after each document and no index, kept in blocks of
any size, which end where they are full: a document may begin in one block, run through others and end in a later one.
Each block is searched for separators by itself, as an array. What a block cannot know, the number of separators and
the place of the last one before it, a prefix scan over the blocks of its file adds. So blocks are read in any order by
any number of tasks, and only a few numbers per block are moved.

Tokens here are the bytes of the text, shifted by 3, with 1 for the end of a document (16-bit ids); the scan itself
takes any file of 16- or 32-bit ids and any separator.

Defined results: null and empty texts are documents of no tokens, tokens after the last separator of a file are not a
document, rows that share an id are counted each for itself, and an empty table gives none.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.words import pieces, text_bytes
from evenkeel.sources.tables import scratch_path

# The ids of a byte vocabulary.
END_OF_DOCUMENT, FIRST_BYTE = 1, 3
BLOCK_TOKENS = 1 << 16
#: Blocks in a file; bounds the rows of a prefix scan.
FILE_BLOCKS = 1024
#: How blocks are written: Parquet would first look at the size of a page or row group, which are held whole, after 100 rows.
LAYOUT = {"compression": "zstd", "parquet.block.size": 4 << 20, "parquet.block.size.row.check.min": 8, "parquet.page.size.row.check.min": 4}


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> None:
    """Write a table of blocks: file, block, tokens (little-endian 16-bit ids) and, apart from the tokens, ended: the
    ids of the documents that end in the block, in order."""

    def row(file: int, number: int, tokens: np.ndarray, ids: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([file]), pa.array([number]), pa.array([tokens.astype("<u2").tobytes()], pa.binary()), pa.array([ids], pa.list_(pa.int64()))],
            ["file", "block", "tokens", "ended"],
        )

    def encode(batches) -> Iterator[pa.RecordBatch]:
        file, count = TaskContext.get().partitionId() << 24, 0
        held, ends, ids = np.empty(0, np.uint16), [], []  # tokens not yet written, and the places of ends and ids of the documents in them
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            names = batch.column(0).cast(pa.int64()).to_pylist()
            for a, b in pieces(offsets, 1 << 20):
                part = data[offsets[a] : offsets[b]].astype(np.uint16) + np.uint16(FIRST_BYTE)
                part = np.insert(part, offsets[a + 1 : b + 1] - offsets[a], END_OF_DOCUMENT)
                ends += (offsets[a + 1 : b + 1] - offsets[a] + np.arange(b - a) + len(held)).tolist()
                ids += names[a:b]
                held = np.concatenate([held, part])
                first, done = 0, 0  # tokens and documents of these that are written
                while len(held) - first >= block_tokens:
                    last = bisect_left(ends, first + block_tokens, done)
                    full = count + 1 >= FILE_BLOCKS and last > done
                    size = ends[last - 1] + 1 - first if full else block_tokens
                    yield row(file, count, held[first : first + size], ids[done:last])
                    first, done, count = first + size, last, count + 1
                    if full:  # a file ends with a document, so its scan needs no other file
                        file, count = file + 1, 0
                held, ends, ids = held[first:].copy(), [end - first for end in ends[done:]], ids[done:]
        if len(held):
            yield row(file, count, held, ids)

    blocks = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        encode, "file long, block long, tokens binary, ended array<long>"
    )
    blocks.write.options(**LAYOUT).parquet(path)


def scan(blocks: DataFrame, separator: int = END_OF_DOCUMENT, token_bytes: int = 2, carry: list[str] | None = None) -> DataFrame:
    """One row per block of (file, block, tokens): n_tokens, n_ends, head (tokens before the first separator), tail (after
    the last), inner (the lengths between separators), places (where each document begins that ends in the block, the
    first one as far as the block knows), and the carried columns."""
    carry = carry or []

    def search(batches):
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            sizes, counts, heads, tails, inners, places = [], [], [], [], [], []
            for tokens in column("tokens"):
                ids = np.frombuffer(tokens.as_buffer(), f"<u{token_bytes}")
                ends = np.flatnonzero(ids == separator)
                sizes.append(len(ids))
                counts.append(len(ends))
                heads.append(int(ends[0]) if len(ends) else len(ids))
                tails.append(len(ids) - int(ends[-1]) - 1 if len(ends) else len(ids))
                inners.append(np.diff(ends) - 1)
                places.append(np.append(0, ends + 1)[: len(ends)])
            yield pa.RecordBatch.from_arrays(
                [column("file"), column("block"), *(pa.array(x, pa.int64()) for x in (sizes, counts, heads, tails)),
                 pa.array(inners, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int64())), *(column(c) for c in carry)],
                ["file", "block", "n_tokens", "n_ends", "head", "tail", "inner", "places", *carry],
            )

    kinds = "".join(f", {c} {blocks.schema[c].dataType.simpleString()}" for c in carry)
    return blocks.select("file", "block", "tokens", *carry).mapInArrow(
        search, f"file long, block long, n_tokens long, n_ends long, head long, tail long, inner array<long>, places array<long>{kinds}"
    )


def documents(found: DataFrame) -> DataFrame:
    """One row per document of scanned blocks that carry ``ended``: file, ordinal in the file, first_token, n_tokens, doc_id."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda f, c, none=0: F.coalesce(f(c).over(before), F.lit(none))
    placed = found.withColumn("start", so_far(F.sum, "n_tokens")).withColumn("ordinal", so_far(F.sum, "n_ends"))
    # Where the document opened that ends at the block's first separator: after the last separator of the blocks before.
    placed = placed.withColumn("after", F.when(F.col("n_ends") > 0, F.col("start") + F.col("n_tokens") - F.col("tail")))
    placed = placed.withColumn("opened", so_far(F.max, "after")).filter("n_ends > 0")
    lengths = F.concat(F.array(F.col("start") + F.col("head") - F.col("opened")), F.col("inner"))
    each = placed.select("file", "ordinal", "opened", F.posexplode(F.arrays_zip(lengths.alias("n"), F.col("places").alias("place"), F.col("ended").alias("id"))).alias("k", "d"), "start")
    first = F.when(F.col("k") == 0, F.col("opened")).otherwise(F.col("start") + F.col("d.place"))
    return each.select("file", (F.col("ordinal") + F.col("k")).alias("ordinal"), first.alias("first_token"), F.col("d.n").alias("n_tokens"), F.col("d.id").alias("doc_id"))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Token counts of ``docs`` by way of flat files in the shared folder."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, id_col, text_col, block_tokens)
    return documents(scan(docs.sparkSession.read.parquet(path), carry=["ended"]))


def op9_separator_scan(spark, d: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{d}/documents.parquet")).select("doc_id", "n_tokens")


QUERIES = {"op9_separator_scan": op9_separator_scan}
ORACLES = {"op9_separator_scan": "SELECT doc_id, CAST(strlen(COALESCE(text, '')) AS BIGINT) AS n_tokens FROM documents"}
