"""Repair of conversation structure by weighted CYK parsing of intervals.

A conversation is well formed when its turns are an optional system turn and then pairs of user and assistant, or when it
is empty. Each turn may be kept, given the role user or assistant, or deleted, and empty turns may be inserted anywhere;
blank turns and repeats must go, and a truncated turn costs more unless it goes. The cheapest edits are found by parsing.

The grammar is in Chomsky normal form over spans of turns. Its eight symbols are the shapes that a piece of a well-formed
conversation can have (nothing, a system turn, user to user, assistant to assistant, user to assistant, ...), and its
rules say which two shapes side by side make a third. A cell holds for each symbol the least (cost, audit) of its span,
the audit being the initials of the edits in order. Cells of single turns are closed under insertion: inserted turns are
symbols over the empty span, joined on either side until nothing gets cheaper. As every inserted turn stands next to some
turn, longer spans need no closure of their own.

Spans are combined bottom-up by their length. In a block of ``BLOCK`` turns, which is mostly a whole conversation, the
chart of all spans and all their splits is filled. The symbols are closed under cutting - whatever piece of a derivation
a span holds, both sides of any split are symbols too - so one split of a longer span gives the same cell as all of them:
blocks are parsed apart from each other and their cells are joined in rounds, ``BLOCK`` neighbours to one. Thus a
conversation of any length is parsed by many tasks, none of which holds more than ``BLOCK`` turns or cells of it.

No two audits of one span and one cost begin with each other, as they differ in inserted turns alone then, which cost; so
the least audits of two parts make the least audit of both.

Turns are ordered by number (nulls first), then role, the first 64 characters of the text and its digest; turns that are
alike in these are copies. A digest of a repaired conversation is a hash over all its text in order, so this last step
reads a conversation in one task, turn by turn, and holds one turn of it at a time besides its audit.

Defined results: a null role or text is one space, a null number is a turn before the others and counts for no gap, turns
with a null conversation id are one conversation, a conversation without turns has no edits, and an empty table gives
none. A role counts by its first letter. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.numbering import number_rows
from evenkeel.llm.resampling import CRC_SQL
from evenkeel.sources.tables import snapshot

# What edits cost, and the two roles that they can give.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = ("user", "assistant")
#: Turns of a chart, and cells that are joined to one in a round.
BLOCK = 16
#: White space of which a blank turn consists.
SPACE = " \t\n\x0b\x0c\r"

# Symbols: nothing; s; u..u; a..a; u..a; a..u; s..u; s..a.
NOTHING, S, UU, AA, UA, AU, SU, SA = range(8)
#: Rules: a span of the first symbol may consist of a span of the second and one of the third.
RULES = (
    (NOTHING, NOTHING, NOTHING),
    *((x, x, NOTHING) for x in range(1, 8)),
    *((x, NOTHING, x) for x in range(1, 8)),
    (UA, UU, AA), (AU, AA, UU),
    (UU, UA, UU), (UU, UU, AU), (AA, AU, AA), (AA, AA, UA), (UA, UA, UA), (AU, AU, AU),
    (SU, S, UU), (SU, SU, AU), (SU, SA, UU), (SA, S, UA), (SA, SU, AA), (SA, SA, UA),
)
WELL_FORMED = (NOTHING, UA, SA)
#: Inserted turns: symbols over the empty span.
INSERTED = ((0, ""), None, (INSERT, "I"), (INSERT, "I"), (2 * INSERT, "II"), (2 * INSERT, "II"), None, None)

Cell = tuple[tuple[int, str] | None, ...]


def joined(left: Cell, right: Cell, into: list) -> None:
    """Put the ways to split a span here into its cell."""
    for x, y, z in RULES:
        a, b = left[y], right[z]
        if a is None or b is None:
            continue
        cost, best = a[0] + b[0], into[x]
        if best is None or cost < best[0] or (cost == best[0] and a[1] + b[1] < best[1]):
            into[x] = (cost, a[1] + b[1])


@lru_cache(maxsize=64)
def turn_cell(code: str) -> Cell:
    """The cell of one turn. Codes: s, u, a or o (other) by the role's initial, in capitals if truncated; 1 to 4 stand
    for the same initials of a turn that must be deleted."""
    cell: list = [None] * 8
    cell[NOTHING] = (DELETE, "D")
    if not code.isdigit():
        extra = TRUNCATED if code.isupper() else 0
        cell[UU] = cell[AA] = (RENAME + extra, "R")
        if code.lower() != "o":
            cell[{"s": S, "u": UU, "a": AA}[code.lower()]] = (extra, "K")
    while True:
        closed = list(cell)
        joined(INSERTED, cell, closed)
        joined(cell, INSERTED, closed)
        if closed == cell:
            return tuple(cell)
        cell = closed


@lru_cache(maxsize=1 << 14)
def chart(codes: str) -> Cell:
    """The cell of a block of turns, from the cells of all its spans."""
    n = len(codes)
    cells: dict[tuple[int, int], Cell] = {(i, i + 1): turn_cell(c) for i, c in enumerate(codes)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell: list = [None] * 8
            for k in range(i + 1, i + length):
                joined(cells[i, k], cells[k, i + length], cell)
            cells[i, i + length] = tuple(cell)
    return cells[0, n]


def neighbours(cells: list[Cell]) -> Cell:
    """The cell of spans side by side, from spans of twice the length each time."""
    while len(cells) > 1:
        pairs = []
        for left, right in zip(cells[::2], cells[1::2]):
            cell: list = [None] * 8
            joined(left, right, cell)
            pairs.append(tuple(cell))
        cells = pairs + cells[len(cells) // 2 * 2 :]
    return cells[0]


def _clashes(initials: str) -> int:
    """Neighbouring initials that no well-formed conversation has."""
    return sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(initials, initials[1:])))


def _initials(codes: str) -> str:
    return codes.lower().translate(str.maketrans("1234", "suao"))


_CELL = "costs array<long>, audits array<string>"
_NODE = f"conv_id long, block long, first string, last string, illegal long, {_CELL}"
_KINDS = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()))


def _nodes(rows: list) -> pa.RecordBatch:
    """Rows (conv_id, block, first, last, illegal, cell) as a batch; symbols that a span cannot be have null costs."""
    parts = [list(c) for c in zip(*rows)] or [[] for _ in range(6)]
    cells = parts.pop()
    parts += [[[e and e[0] for e in c] for c in cells], [[e and e[1] for e in c] for c in cells]]
    return pa.RecordBatch.from_arrays([pa.array(p, k) for p, k in zip(parts, _KINDS)], ["conv_id", "block", "first", "last", "illegal", "costs", "audits"])


def _parse(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv, block, codes in zip(*[c.to_pylist() for c in batch.columns]):
            roles = _initials(codes)
            rows.append((conv, block, roles[0], roles[-1], _clashes(roles), chart(codes)))
        yield _nodes(rows)


def _join(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv, block, parts in zip(*[c.to_pylist() for c in batch.columns]):
            cells = [tuple(None if c is None else (c, a) for c, a in zip(p["costs"], p["audits"])) for p in parts]
            between = sum(_clashes(p["last"] + q["first"]) for p, q in zip(parts, parts[1:]))
            illegal = sum(p["illegal"] for p in parts) + between
            rows.append((conv, block, parts[0]["first"], parts[-1]["last"], illegal, neighbours(cells)))
        yield _nodes(rows)


_ORDER = ["turn", "role", "head", "digest"]


def _read(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role and text without nulls in the latter two, with the columns that order turns."""
    own = turns.selectExpr("CAST(conv_id AS BIGINT) AS conv_id", "CAST(turn AS BIGINT) AS turn", "coalesce(role, ' ') AS role", "coalesce(text, ' ') AS text")
    return own.selectExpr("*", "substring(text, 1, 64) AS head", "unhex(sha2(concat(length(role), ':', role, text), 256)) AS digest")


def placed(turns: DataFrame) -> DataFrame:
    """One narrow row per turn: conv_id, turn, place (from 1), initial, and its first fault: blank, duplicate, truncated."""
    space = "'" + SPACE.encode("unicode_escape").decode().replace(r"\x0b", r"\u000b").replace(r"\x0c", r"\u000c") + "'"
    facts = _read(turns).selectExpr("conv_id", *_ORDER, "substring(role, 1, 1) AS initial", f"trim(TRAILING {space} FROM text) AS trimmed").selectExpr(
        "conv_id", *_ORDER, "initial", "trimmed = '' AS blank", "substring(trimmed, -1, 1) NOT IN ('.', '!', '?') AS truncated"
    )
    # copies get numbers in some order of their own, so that many of them are not one range
    rows = number_rows(facts, ["conv_id"], [*_ORDER, "monotonically_increasing_id()"], "place").drop("role", "head")
    repeats = rows.filter("NOT blank").groupBy("conv_id", "digest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    same = F.col("t.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("t.digest") == F.col("r.digest"))
    joined_ = rows.alias("t").join(repeats.alias("r"), same, "left").selectExpr("t.*", "coalesce(NOT t.blank AND t.place > r.first, false) AS duplicate")
    return joined_.selectExpr("conv_id", "turn", "place", "initial", "blank", "duplicate", "NOT blank AND NOT duplicate AND truncated AS truncated")


def parsed(rows: DataFrame) -> DataFrame:
    """conv_id, illegal, cost and audit of each conversation of placed turns."""
    kind = "if(initial IN ('s', 'u', 'a'), initial, 'o')"
    code = f"CASE WHEN blank OR duplicate THEN translate({kind}, 'suao', '1234') WHEN truncated THEN upper({kind}) ELSE {kind} END"
    blocks = rows.selectExpr("conv_id", "place", f"(place - 1) DIV {BLOCK} AS block", f"{code} AS code").groupBy("conv_id", "block").agg(
        F.expr("array_join(transform(array_sort(collect_list(struct(place, code))), x -> x.code), '') AS codes")  # BLOCK turns at most
    )
    nodes = snapshot(blocks.select("conv_id", "block", "codes").mapInArrow(_parse, _NODE), "charts")
    while (nodes.agg(F.max("block")).first()[0] or 0) > 0:
        parts = nodes.selectExpr("conv_id", f"block DIV {BLOCK} AS up", "struct(block, first, last, illegal, costs, audits) AS part")
        parts = parts.groupBy("conv_id", "up").agg(F.array_sort(F.collect_list("part")).alias("parts"))  # BLOCK cells at most
        nodes = snapshot(parts.mapInArrow(_join, _NODE), "charts")
    ends = F.expr(f"array_min(filter(array({', '.join(f'named_struct("cost", costs[{x}], "audit", audits[{x}])' for x in WELL_FORMED)}), x -> x.cost IS NOT NULL))")
    return nodes.select("conv_id", "illegal", ends.alias("best")).select("conv_id", "illegal", "best.cost", "best.audit")


def _edited(rows, inserted):
    """Apply audits to a stream of rows (conv_id, audit, role, text), a conversation's audit before its turns; yields
    (conv_id, role, text, new) with ``new`` at the first row of a conversation, which has no turn of its own."""
    audit, at, kept, system = "", 0, 0, 0

    def next_role() -> str:
        return ROLES[(kept - system) % 2]

    for conv, said, role, text in rows:
        if said is not None:
            audit, at, kept, system = said, 0, 0, 0
            yield conv, None, None
        else:
            edit, at = audit[at], at + 1
            if edit != "D":
                if edit == "R":
                    role = next_role()
                elif kept == 0:
                    system = int(role[:1] == "s")
                kept += 1
                yield conv, role, text
        while audit[at : at + 1] == "I":
            yield conv, next_role(), inserted
            kept, at = kept + 1, at + 1


def _stream(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """Audits and turns, a conversation's one after another, for ``_edited``."""
    said = audits.selectExpr("conv_id", "audit", "CAST(NULL AS BIGINT) AS turn", "'' AS role", "'' AS text", "'' AS head", "X'' AS digest")
    own = _read(turns).selectExpr("conv_id", "CAST(NULL AS STRING) AS audit", "turn", "role", "text", "head", "digest")
    ordered = said.unionByName(own).repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *_ORDER)
    return ordered.select("conv_id", "audit", "role", "text")


def _lists(batches):
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def repaired_turns(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 1), role and text."""

    def edit(batches) -> Iterator[pa.RecordBatch]:
        held, place = [], 0
        for conv, role, text in _edited(_lists(batches), ""):
            place = 0 if role is None else place + 1
            if role is not None:
                held.append((conv, place, role, text))
            if len(held) >= 1000:
                yield batch(held)
                held = []
        yield batch(held)

    def batch(rows: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["conv_id", "place", "role", "text"])

    return _stream(turns, audits).mapInArrow(edit, "conv_id long, place long, role string, text string")


def repaired_digests(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256, over ``role:text`` of all repaired turns, joined by line ends."""

    def digest(batches) -> Iterator[pa.RecordBatch]:
        whole, n, convs, found = None, 0, [], []
        for conv, role, text in _edited(_lists(batches), ""):
            if role is None:
                if whole is not None:
                    found.append(whole.hexdigest())
                whole, n = hashlib.sha256(), 0
                convs.append(conv)
                continue
            whole.update(("\n" if n else "").encode() + role.encode() + b":" + text.encode())
            n += 1
        if whole is not None:
            found.append(whole.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(convs, pa.int64()), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"])

    return _stream(turns, audits).mapInArrow(digest, "conv_id long, repaired_sha256 string")


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation that has turns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256."""
    rows = snapshot(placed(turns), "placed")
    audits = snapshot(parsed(rows), "audits")
    counts = [f"count_if({c}) AS {c}" for c in ("blank", "duplicate", "truncated")]
    per_turn = rows.groupBy("conv_id", "turn").agg(*[F.expr(c) for c in counts])
    facts = per_turn.groupBy("conv_id").agg(
        F.expr("coalesce(max(turn) - min(turn) + 1 - count(turn), 0) AS gaps"), *[F.expr(f"sum({c}) AS {c}") for c in ("blank", "duplicate", "truncated")]
    )
    digests = repaired_digests(turns, audits)
    same = [F.col(f"{x}.conv_id").eqNullSafe(F.col("f.conv_id")) for x in "ad"]
    return facts.alias("f").join(audits.alias("a"), same[0]).join(digests.alias("d"), same[1]).selectExpr(
        "f.*", "illegal", "cost", "audit", "repaired_sha256"
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults: by a checksum of conversation and number some are dropped, emptied, cut, repeated or renamed."""
    number = lambda c: f"coalesce(CAST({c} AS STRING), ' ')"
    own = turns.selectExpr("conv_id", "turn", "coalesce(role, ' ') AS role", "coalesce(text, ' ') AS text",
                           f"crc32(encode(concat({number('conv_id')}, ':', {number('turn')}), 'UTF-8')) % 20 AS fault")
    return own.filter("fault <> 0").selectExpr(
        "conv_id", "turn", "if(fault = 4, 'user', role) AS role",
        "CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '') ELSE text END AS text",
        "explode(if(fault = 3, array(1, 2), array(1))) AS __copy",
    ).drop("__copy")


def op13_interval_parse(spark, d: str) -> DataFrame:
    turns = spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = repair(damaged(turns)).alias("f")
    every = turns.selectExpr("CAST(conv_id AS BIGINT) AS conv_id").distinct().alias("e")
    numbers = [f"CAST(coalesce(f.{c}, 0) AS BIGINT) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("e.conv_id").eqNullSafe(F.col("f.conv_id")), "left").selectExpr(
        "e.conv_id", *numbers, "coalesce(audit, '') AS audit", "coalesce(repaired_sha256, sha2('', 256)) AS repaired_sha256"
    )


QUERIES = {"op13_interval_parse": op13_interval_parse}


def _after(cell: str, cost: str, edit: str) -> str:
    return f"CASE WHEN {cell} IS NOT NULL THEN {{'c': {cell}.c + {cost}, 'a': {cell}.a || {edit}}} END"


def _least(*cells: str) -> str:
    return f"list_min([{', '.join(cells)}])"


_KEEP_OR_NAME = [f"CASE WHEN NOT gone AND {{}} IS NOT NULL THEN {{{{'c': {{}}.c + t + CASE WHEN i = '{i}' THEN 0 ELSE 1 END, 'a': {{}}.a || CASE WHEN i = '{i}' THEN 'K' ELSE 'R' END}}}} END" for i in "ua"]


def _turn(cell: str, role: int) -> str:
    return _KEEP_OR_NAME[role].format(cell, cell, cell)


#: Turn by turn from left to right over the states of the pattern, instead of by spans.
ORACLES = {
    "op13_interval_parse": f"""
WITH RECURSIVE b AS (SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
    COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' ') AS f FROM conversations),
k AS (SELECT *, {CRC_SQL} % 20 AS fault FROM b),
x AS (SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE fault WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k WHERE fault <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS p,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS e, substr(role, 1, 1) AS i FROM x),
d AS (SELECT *, e = '' AS blank, e <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS duplicate,
    lag(i) OVER (PARTITION BY conv_id ORDER BY p) || i AS pair FROM o),
r AS (SELECT *, blank OR duplicate AS gone, CASE WHEN e <> '' AND NOT duplicate AND right(e, 1) NOT IN ('.', '!', '?') THEN 5 ELSE 0 END AS t FROM d),
facts AS (SELECT conv_id, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT(*) FILTER (blank) AS blank,
    COUNT(*) FILTER (duplicate) AS duplicate, COUNT(*) FILTER (t = 5) AS truncated, COUNT(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, MAX(p) AS n
  FROM r GROUP BY conv_id),
step AS (
  SELECT conv_id, 0::BIGINT AS p, {{'c': 0, 'a': ''}} AS c0, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR)) AS c1, {{'c': 5, 'a': 'I'}} AS c2, {{'c': 10, 'a': 'II'}} AS c3 FROM facts
  UNION ALL
  SELECT conv_id, p, c0, c1, m2 AS c2, {_least('c3', _after('m2', '5', "'I'"))} AS c3 FROM (
    SELECT *, {_least('c2', _after('c0', '5', "'I'"), _after('c1', '5', "'I'"), _after('c3', '5', "'I'"))} AS m2 FROM (
      SELECT s.conv_id, r.p, {_after('c0', '2', "'D'")} AS c0,
        {_least(_after('c1', '2', "'D'"), "CASE WHEN NOT gone AND i = 's' THEN {'c': c0.c + t, 'a': c0.a || 'K'} END")} AS c1,
        {_least(_after('c2', '2', "'D'"), _turn('c0', 0), _turn('c1', 0), _turn('c3', 0))} AS c2,
        {_least(_after('c3', '2', "'D'"), _turn('c2', 1))} AS c3
      FROM step s JOIN r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.p = s.p + 1))),
best AS (SELECT s.conv_id, {_least('c0', 'c3')} AS v FROM step s JOIN facts f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND s.p = f.n),
edits AS (SELECT conv_id, j, substr(v.a, j, 1) AS edit, length(replace(substr(v.a, 1, j), 'I', '')) AS p
  FROM (SELECT *, unnest(range(1, length(v.a) + 1)) AS j FROM best)),
kept AS (SELECT e.*, r.role, r.text, r.i, row_number() OVER (PARTITION BY e.conv_id ORDER BY j) - 1 AS q
  FROM edits e LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.p = e.p WHERE edit <> 'D'),
named AS (SELECT *, MAX(CASE WHEN q = 0 AND edit = 'K' AND i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS sys FROM kept),
whole AS (SELECT conv_id, string_agg(CASE edit WHEN 'K' THEN role ELSE CASE WHEN (q - sys) % 2 = 0 THEN 'user' ELSE 'assistant' END END || ':'
    || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS w FROM named GROUP BY conv_id),
a AS (SELECT DISTINCT conv_id FROM conversations)
SELECT a.conv_id, CAST(COALESCE(gaps, 0) AS BIGINT) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate, COALESCE(truncated, 0) AS truncated,
  COALESCE(illegal, 0) AS illegal, CAST(COALESCE(v.c, 0) AS BIGINT) AS cost, COALESCE(v.a, '') AS audit, sha256(COALESCE(w, '')) AS repaired_sha256
FROM a LEFT JOIN facts f ON a.conv_id IS NOT DISTINCT FROM f.conv_id LEFT JOIN best ON a.conv_id IS NOT DISTINCT FROM best.conv_id
  LEFT JOIN whole ON a.conv_id IS NOT DISTINCT FROM whole.conv_id"""
}
