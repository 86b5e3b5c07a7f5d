"""Conversation repair against a search of all edits, and against a left-to-right form."""

import hashlib
import itertools
import random
import re

import brute
import pytest
from pyspark.sql import functions as F

from evenkeel.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
INITIAL = {"1": "s", "2": "u", "3": "a", "4": "o"}


def edits_of(code):
    """(cost, edit, role initial or '') of what may become of a turn."""
    yield 2, "D", ""
    if not code.isdigit():
        extra = 5 if code.isupper() else 0
        yield extra, "K", code.lower()
        yield 1 + extra, "R", "u"
        yield 1 + extra, "R", "a"


def searched(codes, inserts=2):
    """The least (cost, audit) over all edits with up to so many inserted turns at each place."""
    best = None
    gaps = [[(5 * k, "I" * k, roles) for k in range(inserts + 1) for roles in map("".join, itertools.product("ua", repeat=k))]] * (len(codes) + 1)
    choices = [g for pair in itertools.zip_longest(gaps, [list(edits_of(c)) for c in codes]) for g in pair if g]
    for way in itertools.product(*choices):
        if re.fullmatch("(s?(ua)+)?", "".join(r for *_, r in way)):
            found = sum(c for c, *_ in way), "".join(e for _, e, _ in way)
            best = found if best is None else min(best, found)
    return best


def left_to_right(codes):
    """The same by the states of the pattern, turn by turn."""
    def close(s):
        s[2] = min(x for x in (s[2], *[(s[k][0] + 5, s[k][1] + "I") if s[k] else None for k in (0, 1, 3)]) if x)
        s[3] = min(x for x in (s[3], (s[2][0] + 5, s[2][1] + "I")) if x)
        return s

    states = close([(0, ""), None, None, None])
    for code in codes:
        new = [None] * 4
        for cost, edit, role in edits_of(code):
            for k, s in enumerate(states):
                to = {"": k, "s": 1 if k == 0 else None, "u": {0: 2, 1: 2, 3: 2}.get(k), "a": 3 if k == 2 else None}.get(role)
                if s and to is not None:
                    way = s[0] + cost, s[1] + edit
                    new[to] = way if new[to] is None else min(new[to], way)
        states = close(new)
    return min(s for s in (states[0], states[3]) if s)


def best(cell):
    return min(e for e in (cell[x] for x in repair.WELL_FORMED) if e)


def test_the_chart_finds_the_least_of_all_edits():
    for n in range(1, 3):
        for codes in itertools.product("suaoSUAO1234", repeat=n):
            assert best(repair.chart("".join(codes))) == searched(codes), codes
    for codes in ("aus", "sau", "sss", "UAu", "2ua", "oOa", "aaa", "suS"):
        assert best(repair.chart(codes)) == searched(codes, 1), codes


@pytest.mark.parametrize("block", [1, 2, 5, 16])
def test_blocks_side_by_side_give_the_cell_of_the_whole(block):
    rng = random.Random(block)
    for _ in range(60):
        codes = "".join(rng.choice("suauauauaoSUAO1234") for _ in range(rng.randint(1, 40)))
        cell = repair.neighbours([repair.chart(codes[k : k + block]) for k in range(0, len(codes), block)])
        assert best(cell) == left_to_right(codes), codes
        if len(codes) < 17:
            assert cell == repair.chart(codes)


def plain(turns):
    """conv -> (gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of (conv, turn, role, text) rows."""
    out = {}
    for conv in {r[0] for r in turns}:
        rows = sorted(((t is not None, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in turns if c == conv), key=lambda r: (r[0], r[1] or 0, r[2], r[3]))
        numbers, seen, codes, faults = [r[1] for r in rows if r[0]], set(), "", []
        for _, _, role, text in rows:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            codes += initial.upper() if fault == "truncated" else {"s": "1", "u": "2", "a": "3", "o": "4"}[initial] if fault else initial
        cost, audit = left_to_right(codes)
        kept, at = [], 0
        for e in audit:
            if e in "KR":
                kept.append((rows[at][2] if e == "K" else None, rows[at][3]))
            elif e == "I":
                kept.append((None, ""))
            at += e != "I"
        first = int(bool(kept) and kept[0][0] is not None and kept[0][0][:1] == "s")
        lines = [f"{r if r is not None else ('user', 'assistant')[(k - first) % 2]}:{x}" for k, (r, x) in enumerate(kept)]
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, brute.sha("\n".join(lines)))
    return out


def answered(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


@pytest.fixture(scope="module")
def turns():
    """Conversations of all lengths, one of them long, with null, empty, repeated, cut and very long turns."""
    rng, rows = random.Random(7), []
    for conv in [None, *range(40)]:
        for turn in range(rng.choice([1, 2, 5, 9, 16, 17, 33, 120]) if conv != 5 else 700):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "User", "usher"]) if conv != 6 else "user"
            text = rng.choice([f"text {turn}.", f"said {turn % 3}!", "cut", "cut ", "", " \n\t", None, "why?\x0b", "é" * 80 + str(turn), "x. " * 30000 if conv == 7 and turn == 0 else "ok."])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn // 2, 10 * turn]), role, text))
    return rows + rows[:9] + [(90, None, None, None), (91, None, "user", "hi."), (92, 4, "assistant", "")]


def test_repair_matches_plain_python(spark, turns):
    df = spark.createDataFrame(turns, SCHEMA).repartition(4)
    got, want = answered(repair.repair(df)), plain(turns)
    assert got == want
    assert sum(v[5] > 0 for v in want.values()) > 20


def test_repaired_turns_are_well_formed_and_need_no_edit(spark, turns):
    df = spark.createDataFrame(turns, SCHEMA).repartition(4)
    audits = repair.parsed(repair.placed(df))
    fixed = repair.repaired_turns(df, audits).collect()
    for conv in {r.conv_id for r in fixed}:
        own = sorted((r for r in fixed if r.conv_id == conv), key=lambda r: r.place)
        assert [r.place for r in own] == list(range(1, len(own) + 1))
        assert re.fullmatch("s?(ua)+", "".join(r.role[0] for r in own))
    assert {r.conv_id for r in fixed} == {c for c, v in plain(turns).items() if set(v[6]) - {"D"}}


def test_odd_tables(spark, turns):
    df = spark.createDataFrame(turns[:50], SCHEMA)
    clashing = df.withColumns({c: F.lit(None) for c in ("place", "block", "codes", "audit", "cost", "digest", "head", "fault", "blank", "first", "n")})
    assert answered(repair.repair(clashing)) == plain(turns[:50])
    assert repair.repair(df.filter("false")).collect() == []


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(30) for t in range(6)] + [(None, None, "assistant", "One."), (7, 50, None, None)]
    got = sorted((tuple(r) for r in repair.damaged(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    want = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if fault == 4 else role or " ", "" if fault == 1 else re.sub("[.!?]", "", text or " ") if fault == 2 else text or " ")
        want += [] if fault == 0 else [row] * (2 if fault == 3 else 1)
    assert got == sorted(want, key=str)
    assert hashlib.sha256(b"").hexdigest() == brute.sha("")
