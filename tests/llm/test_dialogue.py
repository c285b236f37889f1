"""Conversation repair against enumeration of all edits, a plain walk over the turns, and all splits of all spans."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import dialogue

LEGAL = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def by_enumeration(kinds):
    """Least (cost, audit) over every choice of an edit per turn and up to two insertions between turns."""
    options = []
    for kind in kinds:
        extra = 3 if kind.isupper() else 0
        own = [("D", "", 4)]
        if kind != "x":
            own += [("K", kind.lower(), extra), ("R", "u", 3 + extra), ("R", "a", 3 + extra)]
        options.append(own)
    added = [[], ["u"], ["a"], ["u", "a"], ["a", "u"]]
    best = None
    for edits in itertools.product(*options):
        for inserted in itertools.product(added, repeat=len(kinds) + 1):
            cost = sum(c for *_, c in edits) + 3 * sum(map(len, inserted))
            if best is not None and cost > best[0]:
                continue
            initials, audit = "".join(inserted[0]), "I" * len(inserted[0])
            for (edit, initial, _), more in zip(edits, inserted[1:]):
                initials += initial + "".join(more)
                audit += edit + "I" * len(more)
            if LEGAL.fullmatch(initials) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=dialogue.KINDS, max_size=3))
def test_cells_equal_enumeration(kinds):
    assert dialogue.answer(dialogue.parse(kinds, {})) == by_enumeration(kinds)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=dialogue.KINDS, min_size=1, max_size=9))
def test_all_splits_of_all_spans_agree(kinds):
    n = len(kinds)
    chart = {(i, i + 1): dialogue.LEAVES[k] for i, k in enumerate(kinds)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            cells = {dialogue.combined(chart[i, k], chart[k, i + size]) for k in range(i + 1, i + size)}
            assert len(cells) == 1
            chart[i, i + size] = cells.pop()
    assert dialogue.parse(kinds, {}) == chart[0, n]


def walked(kinds):
    """Least (cost, audit) turn by turn: for every state after a prefix the least so far."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def insert(states):
        for _ in range(2):
            for (q, r), to in step.items():
                if r != "s" and q in states:
                    cost, audit = states[q]
                    states[to] = min(states.get(to, (99**9, "")), (cost + 3, audit + "I"))
        return states

    states = insert({0: (0, "")})
    for kind in kinds:
        extra, after = 3 if kind.isupper() else 0, {}

        def put(q, cost, audit):
            after[q] = min(after.get(q, (99**9, "")), (cost, audit))

        for q, (cost, audit) in states.items():
            put(q, cost + 4, audit + "D")
            for (p, r), to in step.items():
                if p == q and kind != "x":
                    if r == kind.lower():
                        put(to, cost + extra, audit + "K")
                    if r != "s":
                        put(to, cost + extra + 3, audit + "R")
        states = insert(after)
    return min(states[q] for q in (0, 3) if q in states)


def plainly(rows):
    """Every row of op13, from (conv_id, turn, role, text) rows."""
    blanks = " \t\n\x0b\x0c\r"
    convs = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        convs[conv] += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    out = []
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        kinds, seen, counts = "", set(), [0, 0, 0]
        for _, role, text in turns:
            end = text.rstrip(blanks)[-1:]
            kind = role[:1] if role[:1] and role[:1] in "sua" else "o"
            if not end:
                counts[0] += 1
                kind = "x"
            elif (role, text) in seen:
                counts[1] += 1
                kind = "x"
            elif end not in ".!?":
                counts[2] += 1
                kind = kind.upper()
            seen.add((role, text))
            kinds += kind
        numbers = [t for t, *_ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = walked(kinds)
        repaired, place, said = [], iter(turns), ""
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(place)[1:]
            if edit == "D":
                continue
            if edit != "K":
                said_next = "a" if said.endswith("u") else "u"
                role = {"u": "user", "a": "assistant"}[said_next]
            said += role[:1]
            repaired.append(f"{role}:{text}")
        assert LEGAL.fullmatch(said)
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest()))
    return out


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def sorted_rows(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def found(df):
    assert df.columns == NAMES
    return sorted_rows([tuple(r) for r in df.collect()])


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_plain_version(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet")
    assert found(dialogue.op13(table)) == sorted_rows(plainly([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]))


def awkward(seed=7):
    random.seed(seed)
    texts = ["Hi.", "No end", "What?", "", " \t\n", "a. b ", "x ", "Yes!\n", None, "long. " * 2000, "é", " ."]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "sys"]
    rows = [(c % 7 if c % 11 else None, random.choice([None, *range(9)]), random.choice(roles), random.choice(texts)) for c in range(400)]
    return rows + [(100, t, random.choice(roles[:3]), random.choice(texts)) for t in range(600)] + [(101, 5, "user", "same.")] * 40 + [(None, None, None, None)]


@pytest.mark.parametrize("most", [1, 3, 1024])
def test_awkward_rows_whole_or_in_pieces(spark, monkeypatch, most):
    rows = awkward()
    table = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit("clash") for c in ("conv", "cost", "lines", "key")})
    monkeypatch.setattr(dialogue.repair, "__defaults__", (most,))
    monkeypatch.setattr(dialogue, "FAN", 2 if most == 3 else 32)
    assert found(dialogue.op13(table)) == sorted_rows(plainly(rows))


def test_empty_tables_and_conversations_that_lose_all_rows(spark):
    assert dialogue.op13(spark.createDataFrame([], SCHEMA)).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(dialogue.op13(spark.createDataFrame([(gone, 0, "user", "x.")], SCHEMA))) == [(gone, 0, 0, 0, 0, 0, 0, "", empty)]


def test_repaired_turns_are_whole(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "assistant", "hello."), (1, 2, "assistant", "hello."), (1, 3, "tool", "t.")]
    table = spark.createDataFrame(rows, SCHEMA).select(F.lit("=1").alias("conv"), "turn", "role", "text")
    reports, lines = dialogue.repair(table)
    assert [tuple(r) for r in reports.select("cost", "audit").collect()] == [(10, "KRDR")]
    turns = [(x.edit, x.role, x.text) for r in lines.orderBy("key").collect() for x in r.lines]
    assert turns == [("K", "system", "s."), ("R", "user", "hello."), ("R", "assistant", "t.")]
