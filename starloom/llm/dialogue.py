"""Repair of conversation structure by weighted CYK parsing over spans of turns."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.staging import stage

# Blanks, ends of sentences, faults by remainder, costs of edits.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
FAULTS = 20
DROP, EMPTY, CUT, REPEAT, RENAME = range(5)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NAMES = {"u": "user", "a": "assistant"}

BLOCK_ROWS, BLOCK_BYTES = 1024, 1 << 22  # of one conversation that a task holds at once
FAN = 32  # spans that are combined at once

# The grammar (s?(ua)+)? as an automaton: nothing yet, after s, after u, after a. It ends in 0 or 3.
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_STARTS, _FINAL = 0, (0, 3)

Entry = tuple[int, str] | None  # cost and audit, or underivable
Cell = tuple[Entry, ...]

# Nonterminal XY of the repair grammar: a span whose edited turns lead from state X to state Y. Chomsky normal form:
# XZ -> XY YZ for two spans, and XY -> turn for one, by each edit that allows it.
NONTERMINALS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]
_AT = {pair: k for k, pair in enumerate(NONTERMINALS)}
_RULES = [[(_AT[x, y], _AT[y, z]) for y in range(4) if (x, y) in _AT and (y, z) in _AT] for x, z in NONTERMINALS]


def _least(entries: Iterator[Entry]) -> Entry:
    return min((e for e in entries if e is not None), default=None)


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of two spans in a row: for each nonterminal the least (cost, audit) over its binary rules.

    Two edits of one span at one cost are never prefixes of each other (the longer one would have paid for more insertions), so
    the order of audits survives concatenation, and the least of the whole is made of the least of the parts.
    """
    found = []
    for rules in _RULES:
        best = None
        for a, b in rules:
            x, y = left[a], right[b]
            if x is not None and y is not None:
                cost = x[0] + y[0]
                if best is None or cost < best[0] or cost == best[0] and x[1] + y[1] < best[1]:
                    best = cost, x[1] + y[1]
        found.append(best)
    return tuple(found)


def _closure() -> Cell:
    """The cell of a span without turns: nothing, or any number of insertions."""
    cell = tuple((0, "") if x == y else (INSERT, "I") if y in (_STEP.get((x, "u")), _STEP.get((x, "a"))) else None for x, y in NONTERMINALS)
    while (more := tuple(_least(iter(p)) for p in zip(cell, combined(cell, cell)))) != cell:
        cell = more
    return cell


INSERTED = _closure()

# Kinds of turns: the role's initial (o: any other), in upper case if truncated; x must go (blank or duplicate).
KINDS = "suaoSUAOx"


def _leaf(kind: str) -> Cell:
    """The cell of one turn: each edit by the state it starts from, closed under insertions on both sides."""
    extra = TRUNCATED if kind.isupper() else 0
    initial = kind.lower()
    found = []
    for x, y in NONTERMINALS:
        options = [(DELETE, "D")] if x == y else []
        if kind != "x":
            options += [(extra, "K")] if _STEP.get((x, initial)) == y else []
            options += [(REROLE + extra, "R")] if y in (_STEP.get((x, r)) for r in NAMES) else []
        found.append(_least(iter(options)))
    return combined(combined(INSERTED, tuple(found)), INSERTED)


LEAVES = {kind: _leaf(kind) for kind in KINDS}
_MEMO = 8  # turns of the longest span whose cells a task keeps
_KEPT = 100_000


def parse(kinds: str, kept: dict[str, Cell]) -> Cell:
    """The cell of a span of turns, bottom-up by span length: 1, 2, 4 and so on.

    A span's nonterminals name the states at both its ends, so every split of a span derives the same: one split for each
    span is enough, and no span but these is needed. Cells of short spans are kept in `kept`, as they recur.
    """
    spans = [(k, LEAVES[k]) for k in kinds] or [("", INSERTED)]
    while len(spans) > 1:
        paired = []
        for n in range(0, len(spans) - 1, 2):
            (a, left), (b, right) = spans[n], spans[n + 1]
            if len(a) + len(b) > _MEMO:
                paired.append((a + b, combined(left, right)))
                continue
            if a + b not in kept:
                if len(kept) >= _KEPT:
                    kept.clear()
                kept[a + b] = combined(left, right)
            paired.append((a + b, kept[a + b]))
        spans = paired + spans[len(spans) & ~1 :]
    return spans[0][1]


def answer(cell: Cell) -> tuple[int, str]:
    """Least (cost, audit) of a whole conversation."""
    return _least(cell[_AT[_STARTS, q]] for q in _FINAL)


def applied(audit: str, turns: Sequence[tuple[str, str]], before: int, lead: bool) -> list[tuple[str, str, str]]:
    """Repaired turns (edit, role, text) of a piece of an audit; `before` turns come out ahead of it, `lead` says that the first is s."""
    out, place = [], iter(turns)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(place)
        if edit == "D":
            continue
        if edit != "K":
            role = NAMES["ua"[(before - lead) % 2]]
        out.append((edit, role, text))
        before += 1
    return out


def leads(audit: str) -> bool:
    """Whether the repaired conversation starts with s: then its number of turns is odd."""
    return (len(audit) - audit.count("D")) % 2 == 1


@dataclass(frozen=True)
class Span:
    """What is known of consecutive turns of a conversation; `joined` makes it of two."""

    n: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    first: str
    last: str
    least: int | None
    most: int | None
    numbers: int
    cell: Cell

    def joined(self, other: Span) -> Span:
        same = self.most is not None and self.most == other.least
        return Span(
            self.n + other.n,
            self.blank + other.blank,
            self.duplicate + other.duplicate,
            self.truncated + other.truncated,
            self.illegal + other.illegal + (self.last + other.first not in ("su", "ua", "au")),
            self.first,
            other.last,
            other.least if self.least is None else self.least,
            self.most if other.most is None else other.most,
            self.numbers + other.numbers - same,
            combined(self.cell, other.cell),
        )

    @property
    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.numbers


Turn = tuple[int | None, str, str]


def kinds_of(turns: Sequence[Turn], new: Sequence[bool]) -> str:
    """The kind of each turn; `new` says that its role and text were not seen before. x is blank, X duplicate."""
    kinds = []
    for (_, role, text), first in zip(turns, new):
        end = text.rstrip(BLANKS)[-1:]
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        kinds.append("x" if not end else "X" if not first else initial if end in ENDS else initial.upper())
    return "".join(kinds)


def span_of(turns: Sequence[Turn], kinds: str, kept: dict[str, Cell]) -> Span:
    initials = [role[:1] for _, role, _ in turns]
    numbers = [t for t, _, _ in turns if t is not None]
    return Span(
        len(turns),
        kinds.count("x"),
        kinds.count("X"),
        sum(k in "SUAO" for k in kinds),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        initials[0],
        initials[-1],
        numbers[0] if numbers else None,
        numbers[-1] if numbers else None,
        len(set(numbers)),
        parse(kinds.replace("X", "x"), kept),
    )


def damage(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text): the rows with the faults that their checksums ask for. Nulls are one blank, but for the order of turns."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % FAULTS
    rows = conversations.select(
        _conv().alias("conv"), F.col("turn").cast("bigint").alias("turn"), known("role").alias("role"), known("text").alias("text"), fault.alias("fault")
    )
    text = F.when(F.col("fault") == EMPTY, "").when(F.col("fault") == CUT, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == RENAME, NAMES["u"]).otherwise(F.col("role"))
    times = F.when(F.col("fault") == REPEAT, 2).otherwise(1)
    rows = rows.filter(F.col("fault") != DROP).select("conv", "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), times)).alias("copy"))
    return rows.drop("copy")


def _conv() -> Column:
    """A conversation's id as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


_LINE = "array<struct<turn:bigint,edit:string,role:string,text:string>>"
_REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_NAMES = [f.split()[0] for f in _REPORT.split(", ")]


def _report(span: Span) -> list:
    return [span.gaps, span.blank, span.duplicate, span.truncated, span.illegal, *answer(span.cell)]


def _lines(turns: Sequence[tuple]) -> list[dict]:
    return [dict(zip(("turn", "edit", "role", "text"), t)) for t in turns]


def _first_pass(rows: DataFrame, most_rows: int) -> DataFrame:
    """One row for every conversation that a range of sorted rows holds as a whole: its report and repaired turns. The rest, at
    the ends of ranges or beyond the size that a task should hold, comes in pieces as it is, with its place (part, number)."""

    def walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, kept = TaskContext.get().partitionId(), 0, {}
        out: list[list] = []
        turns: list[Turn] = []
        conv, size, whole = None, 0, False  # the range's first conversation may have begun before it

        def closed() -> list:
            seen: set[tuple[str, str]] = set()
            new = [not (t[1:] in seen or seen.add(t[1:])) for t in turns]
            span = span_of(turns, kinds_of(turns, new), kept)
            audit = answer(span.cell)[1]
            repaired = applied(audit, [t[1:] for t in turns], 0, leads(audit))
            return [conv, False, None, None, _lines([(None, *t) for t in repaired]), *_report(span)]

        def piece() -> list:
            nonlocal number
            number += 1
            return [conv, True, part, number - 1, _lines([(t, None, role, text) for t, role, text in turns]), *[None] * len(_NAMES)]

        for batch in batches:
            for other, turn, role, text in zip(batch["conv"], batch["turn"], batch["role"], batch["text"]):
                if other != conv:
                    if turns:
                        out.append(closed() if whole else piece())
                    whole, turns, size = conv is not None, [], 0
                    conv = other
                elif len(turns) >= most_rows or size >= BLOCK_BYTES:
                    out.append(piece())
                    whole, turns, size = False, [], 0
                turns.append((None if pd.isna(turn) else int(turn), role, text))
                size += len(role) + len(text)
            if out:
                yield pd.DataFrame(out, columns=names)
                out = []
        if turns:
            out.append(piece())  # may go on in the next range
        yield pd.DataFrame(out, columns=names)

    names = ["conv", "open", "part", "number", "lines", *_NAMES]
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.monotonically_increasing_id()]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order[:-1])
    return sorted_rows.mapInPandas(walked, f"conv string, open boolean, part bigint, number bigint, lines {_LINE}, {_REPORT}")


_SPAN = (
    "conv string, key bigint, n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string,"
    " least bigint, most bigint, numbers bigint, costs array<bigint>, audits array<string>"
)
_FIELDS = [f.split()[0] for f in _SPAN.split(", ")]


def _to_row(span: Span) -> list:
    cell = [e or (-1, "") for e in span.cell]
    return [getattr(span, f) for f in _FIELDS[2:12]] + [[c for c, _ in cell], [a for _, a in cell]]


def _from_row(row) -> Span:
    whole = lambda v: None if v is None or pd.isna(v) else int(v)
    cell = tuple(None if c < 0 else (int(c), a) for c, a in zip(row["costs"], row["audits"]))
    values = [row[f] if f in ("first", "last") else whole(row[f]) for f in _FIELDS[2:12]]
    return Span(*values, cell)


def _leaves(pieces: DataFrame) -> DataFrame:
    """A span for every piece of an open conversation, and its kinds. A turn is new if no earlier one has its role and text:
    the least place of each is found by a digest, which hot conversations and frequent turns do not gather in one task."""
    digest = F.md5(F.concat(F.length("line.role"), F.lit(":"), F.col("line.role"), F.col("line.text")))
    turns = pieces.select("conv", "key", F.posexplode("lines").alias("place", "line")).select("conv", "key", "place", digest.alias("digest"))
    firsts = turns.groupBy("conv", "digest").agg(F.min(F.struct("key", "place")).alias("at"))
    firsts = firsts.groupBy("conv", F.col("at.key").alias("key")).agg(F.collect_list("at.place").alias("new"))

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[str, Cell] = {}
        for batch in batches:
            rows = []
            for conv, key, lines, new in zip(batch["conv"], batch["key"], batch["lines"], batch["new"]):
                turns = [(None if pd.isna(x["turn"]) else int(x["turn"]), x["role"], x["text"]) for x in lines]
                at = set() if new is None else set(new)
                kinds = kinds_of(turns, [n in at for n in range(len(turns))])
                rows.append([conv, key, *_to_row(span_of(turns, kinds, kept))])
            yield pd.DataFrame(rows, columns=_FIELDS)

    return pieces.join(firsts, ["conv", "key"], "left").select("conv", "key", "lines", "new").mapInPandas(leaves, _SPAN)


def _merged(spans: DataFrame) -> DataFrame:
    """Spans of up to 32 consecutive keys combined, with the keys and lengths of their parts."""
    parts = F.sort_array(F.collect_list(F.struct("key", *_FIELDS[2:]))).alias("parts")
    grouped = spans.groupBy("conv", F.expr(f"key div {FAN}").alias("key")).agg(parts)

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for conv, key, parts in zip(batch["conv"], batch["key"], batch["parts"]):
                span = reduce(Span.joined, map(_from_row, parts))
                rows.append([conv, key, *_to_row(span), [{"key": p["key"], "n": p["n"]} for p in parts]])
            yield pd.DataFrame(rows, columns=[*_FIELDS, "parts"])

    return grouped.mapInPandas(merge, f"{_SPAN}, parts array<struct<key:bigint,n:bigint>>")


_PIECE = "conv string, key bigint, audit string, before bigint, lead boolean"


def _split(pieces: DataFrame, merged: DataFrame) -> DataFrame:
    """Audits of spans, cut into those of their parts."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for conv, audit, before, lead, parts in zip(*[batch[c] for c in ("conv", "audit", "before", "lead", "parts")]):
                at = 0
                for part in parts:
                    end, left = at, part["n"]
                    while left or (part is parts[-1] and end < len(audit)):
                        left -= audit[end] != "I"
                        end += 1
                    rows.append([conv, part["key"], audit[at:end], before, lead])
                    before += end - at - audit.count("D", at, end)
                    at = end
            yield pd.DataFrame(rows, columns=["conv", "key", "audit", "before", "lead"])

    return pieces.join(merged.select("conv", "key", "parts"), ["conv", "key"]).mapInPandas(cut, _PIECE)


def _open(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reports of the conversations that came in pieces, and their repaired turns piece by piece.

    Cells go up a tree of spans, 32 to a step; the audit goes down again, cut at every step into those of the parts. No step
    gathers more than 32 cells of a conversation.
    """
    height = max(1, math.ceil(math.log(1 + (pieces.agg(F.max("key")).first()[0] or 0), FAN) + 1e-9))
    levels = [stage(_leaves(pieces), "leaves")]
    for _ in range(height):
        levels.append(stage(_merged(levels[-1].select(*_FIELDS)), "spans"))

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [[row["conv"], *_report(_from_row(row))] for row in batch.to_dict("records")]
            out = pd.DataFrame(rows, columns=["conv", *_NAMES])
            yield out.assign(key=0, before=0, lead=[leads(a) for a in out["audit"]])

    roots = stage(levels[-1].select(*_FIELDS).mapInPandas(finish, f"conv string, {_REPORT}, key bigint, before bigint, lead boolean"), "reports")
    down = roots.select("conv", "key", "audit", "before", "lead")
    for merged in levels[:0:-1]:
        down = _split(down, merged)

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for audit, before, lead, lines in zip(batch["audit"], batch["before"], batch["lead"], batch["lines"]):
                out.append(_lines([(None, *t) for t in applied(audit, [(x["role"], x["text"]) for x in lines], before, lead)]))
            yield batch[["conv", "key"]].assign(lines=out)

    both = down.join(pieces.select("conv", "key", "lines"), ["conv", "key"])
    return roots.select("conv", *_NAMES), both.mapInPandas(apply, f"conv string, key bigint, lines {_LINE}")


def repair(conversations: DataFrame, most_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Reports (conv, gaps, blank, duplicate, truncated, illegal, cost, audit) and repaired turns (conv, key, lines) of
    (conv, turn, role, text) rows: turns in order of key and of their place in `lines`, each an (edit, role, text).

    Rows are in order of turn, nulls first, then of role and text; `edit` is K, R or I. The edits are the cheapest, and of
    those the ones with the least audit, that give role initials of (s?(ua)+)?, found by CYK over spans of turns. Roles
    other than s..., u..., a... (an empty one too) fit nowhere and are renamed or deleted. Repeated rows are duplicates.

    Rows are ranged by conversation and turn, so that one conversation, however large, is spread over tasks. One that lies within a
    range is parsed there; others are parsed in pieces of up to `most_rows` turns and combined as a tree of spans.
    """
    passed = stage(_first_pass(conversations, most_rows), "passed")
    closed, pieces = passed.filter("not open"), passed.filter("open")
    longest = F.max("number")
    step = 1 + (pieces.agg(longest).first()[0] or 0)
    pieces = pieces.select("conv", (F.col("part") * step + F.col("number")).alias("key"), "lines")
    reports, lines = _open(pieces)
    lines = closed.select("conv", F.lit(0).cast("bigint").alias("key"), "lines").unionByName(lines)
    return closed.select("conv", *_NAMES).unionByName(reports), lines


def digests(lines: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): of the `role:text` lines of each conversation, joined by line breaks.

    A conversation's pieces go to one task in order, one after the other: a digest cannot be put together from parts, but
    no more than a batch of pieces is held at once.
    """
    text = F.array_join(F.transform("lines", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
    chunks = lines.filter(F.size("lines") > 0).select("conv", "key", text.alias("text"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, digest = None, None
        for batch in batches:
            out = []
            for other, text in zip(batch["conv"], batch["text"]):
                coded = text.encode("utf-8")
                if other == conv:
                    digest.update(b"\n" + coded)
                    continue
                if conv is not None:
                    out.append((conv, digest.hexdigest()))
                conv, digest = other, hashlib.sha256(coded)
            yield pd.DataFrame(out, columns=["conv", "repaired_sha256"])
        if conv is not None:
            yield pd.DataFrame([(conv, digest.hexdigest())], columns=["conv", "repaired_sha256"])

    return chunks.repartition("conv").sortWithinPartitions("conv", "key").mapInPandas(hashed, "conv string, repaired_sha256 string")


def op13(conversations: DataFrame) -> DataFrame:
    """Damages the rows, repairs them, and reports on every conversation; one that loses all rows has zeros."""
    conversations = conversations.select("conv_id", "turn", "role", "text")
    reports, lines = repair(damage(conversations))
    reports = reports.withColumnRenamed("conv", "__conv")
    hashes = digests(lines).withColumnRenamed("conv", "__lines")
    ids = conversations.select("conv_id", _conv().alias("conv")).distinct()
    both = ids.join(reports, F.col("conv") == F.col("__conv"), "left").join(hashes, F.col("conv") == F.col("__lines"), "left")
    numbers = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in _NAMES[:-1]]
    empty = F.sha2(F.lit(b""), 256)
    return both.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
