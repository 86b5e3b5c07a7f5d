"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own.

A conversation is rendered once, turn by turn; an example is the rendered text up to and with its assistant turn. All
turns before are its context, and the loss mask covers that reply's text alone. ``expanded`` writes each example out from
the one rendered text, row after row, so that a task holds a conversation and one of its examples however many it has;
nothing of an example is shuffled before it is used. What follows the last reply is in no example: it is a row of its own
without a target. ``examples`` gives the same as places in the rendered conversation.

A turn is rendered as ``### role: text</turn>`` and a line end. In roles and texts every backslash, ``#``, ``<`` and
(in roles) ``:`` is preceded by a backslash, so no text can hold a mark, and removing one backslash before any
character gives the text back.

Defined results: a null text is empty, a null role is an empty role, turns are ordered by number, then role and text (a
null number first), repeated rows are turns of their own, null conversation ids are one conversation, a conversation
without an assistant has turns but no example, and an empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", "</turn>\n"
TARGET = "assistant"


def escaped(text: Column, also: str = "") -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"([\\#<{also}])", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def rendered(turns: DataFrame) -> DataFrame:
    """One row per turn of (conv_id, turn, role, text): conv_id, place (from 0), segment, start and end of the segment in
    the rendered conversation, and reply_start and reply_end of the text that an assistant turn trains (else null).
    Offsets are code points."""
    head = F.concat(F.lit(OPEN), escaped(F.col("role"), ":"), F.lit(": "))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = placed.withColumn("head", head).withColumn("segment", F.concat("head", escaped(F.col("text")), F.lit(CLOSE)))
    placed = placed.withColumn("place", F.row_number().over(order) - 1)
    end = F.sum(F.length("segment").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = placed.withColumn("end", end).withColumn("start", F.col("end") - F.length("segment"))
    target = F.col("role") == TARGET
    return placed.select(
        "conv_id", F.col("place").cast("long").alias("place"), "segment", "start", "end",
        F.when(target, F.col("start") + F.length("head")).alias("reply_start"), F.when(target, F.col("end") - len(CLOSE)).alias("reply_end"),
    )


def examples(segments: DataFrame) -> DataFrame:
    """One row per assistant turn: conv_id, example (its place), n_chars of the example's text, which is the rendered
    conversation up to there, and the trained span in it."""
    return segments.filter("reply_start IS NOT NULL").select(
        "conv_id", F.col("place").alias("example"), F.col("end").alias("n_chars"), "reply_start", "reply_end"
    )


def expanded(segments: DataFrame) -> DataFrame:
    """The examples with their texts, and what they leave out: conv_id, example (null for the turns after the last reply),
    begin (where the text begins in the rendered conversation: 0 for examples), n_chars, reply_start and reply_end (in the
    text), last (whether no later row holds these turns) and text."""
    parts = F.array_sort(F.collect_list(F.struct("place", "segment", "end", "reply_start", "reply_end")))
    held = segments.groupBy("conv_id").agg(parts.alias("parts")).select(
        "conv_id", F.concat_ws("", "parts.segment").alias("whole"), F.expr("transform(parts, p -> struct(p.place, p.end, p.reply_start, p.reply_end))").alias("parts"))
    told = held.withColumn("replies", F.expr("filter(parts, p -> p.reply_start IS NOT NULL)")).withColumns({
        "cut": F.expr("coalesce(array_max(replies.end), 0L)"), "size": F.expr("array_max(parts.end)")})
    row = "named_struct('example', {}, 'begin', {}, 'end', {}, 'reply_start', {}, 'reply_end', {}, 'last', {})"
    own = f"transform(replies, r -> {row.format('r.place', '0L', 'r.end', 'r.reply_start', 'r.reply_end', 'r.end = cut')})"
    rest = f"if(cut < size, array({row.format('CAST(NULL AS BIGINT)', 'cut', 'size', 'CAST(NULL AS BIGINT)', 'CAST(NULL AS BIGINT)', 'true')}), array())"
    each = told.select("conv_id", "whole", F.expr(f"inline(concat({own}, {rest}))"))
    return each.selectExpr(
        "conv_id", "example", "begin", "end - begin AS n_chars", "reply_start", "reply_end", "last",
        "substring(whole, CAST(begin + 1 AS INT), CAST(end - begin AS INT)) AS text")


def example_texts(segments: DataFrame) -> DataFrame:
    """The examples with their texts: every turn is repeated in each example after it."""
    return expanded(segments).filter("example IS NOT NULL").select("conv_id", "example", "n_chars", "reply_start", "reply_end", "text")


def read_examples(texts: DataFrame) -> DataFrame:
    """What the texts of ``expanded`` hold: conv_id, example, begin, trained (the text under the loss mask, null without a
    target), n_chars, and of the last ones roles and texts of their turns (of others null, as a later one has them too)."""
    role, text = (rf"([^\\#<{also}]*+(?:\\.[^\\#<{also}]*+)*+)" for also in (":", ""))
    turn = F.lit(rf"(?s){OPEN}{role}: {text}{CLOSE}")
    said = lambda k: F.when(F.col("last"), F.transform(F.regexp_extract_all("text", turn, F.lit(k)), unescaped))
    trained = F.substring("text", F.col("reply_start") + 1, F.col("reply_end") - F.col("reply_start"))
    return texts.select(
        "conv_id", "example", "begin", unescaped(trained).alias("trained"), F.length("text").cast("long").alias("n_chars"),
        said(1).alias("roles"), said(2).alias("texts"), "last")


def read_back(segments: DataFrame) -> DataFrame:
    """One row per turn of rendered segments: conv_id, place, role, text and trained (the text under the loss mask)."""
    body = rf"(?s)^{OPEN}((?:[^\\:]|\\.)*+): (.*){CLOSE}$"
    trained = F.substring("segment", F.col("reply_start") - F.col("start") + 1, F.col("reply_end") - F.col("reply_start"))
    return segments.select(
        "conv_id", "place", unescaped(F.regexp_extract("segment", body, 1)).alias("role"), unescaped(F.regexp_extract("segment", body, 2)).alias("text"),
        unescaped(trained).alias("trained"), F.length("segment").cast("long").alias("n_chars"),
    )


def op4_prefix_target(spark, d: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(TARGET).alias("role"), F.lit(said).alias("text"))
    turns = spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    read = read_examples(expanded(rendered(turns.unionByName(extra))))
    read = read.withColumn("turns", F.concat_ws("", F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n")))))
    in_order = lambda place, value: F.transform(F.array_sort(F.collect_list(F.when(F.col(place).isNotNull(), F.struct(place, value)))), lambda s: s[value])
    whole = read.withColumn("begun", F.when(F.col("last"), F.col("begin"))).groupBy("conv_id").agg(
        F.sum(F.when(F.col("last"), F.size("roles"))).cast("long").alias("n_turns"), in_order("begun", "turns").alias("turns"),
        in_order("example", "trained").alias("trained"), F.sum(F.when(F.col("last"), F.col("n_chars"))).alias("formatted_chars"),
    )
    loss = F.concat_ws("", "trained")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.concat_ws("", "turns"), 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )


QUERIES = {"op4_prefix_target": op4_prefix_target}
_COST = r"length(regexp_replace({}, '[\\#<{}]', '..', 'g'))"
ORACLES = {
    "op4_prefix_target": rf"""
WITH t AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
g AS (SELECT conv_id, COUNT(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
  COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
  CAST(SUM(4 + {_COST.format('role', ':')} + 2 + {_COST.format('text', '')} + 8) AS BIGINT) AS formatted_chars FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g"""
}
