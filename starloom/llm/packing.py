"""Best-fit decreasing packing of token sequences."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.staging import stage
from .ranks import positions

CAPACITY = 2048
END_ID = 0
# Fixed value: how byte-level BPE splits a text before it merges.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LONG_BLANK = re.compile(r"\s{1000}")
_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Coder:
    """Ids of texts under a byte-level BPE tokenizer file.

    tiktoken gives the ids of `tokenizers` at four times its speed, with ranks taken from the same file. A text that holds
    a special token's string goes to `tokenizers` itself, which reads such strings as that token, and so does one with a very
    long run of blanks, at which the former's pattern runs out of stack.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.special = [t["content"] for t in parts["added_tokens"]]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # these bytes stand for themselves, the rest in turn
        others = [b for b in range(256) if b not in set(printable)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in parts["model"]["vocab"].items() if t not in self.special}
        self.plain = tiktoken.Encoding("byte_bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_file(path)

    def ids(self, text: str) -> list[int]:
        if any(s in text for s in self.special) or _LONG_BLANK.search(text):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.plain.encode_ordinary(text)


def bounds(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """Cut a sequence: whole pieces at its end, what remains in front."""
    first = tokens % capacity or min(tokens, capacity)
    cuts = [0, *range(first, tokens + 1, capacity)] if tokens else []
    return list(zip(cuts, cuts[1:]))


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Tokenise whole texts, end each with id 0 and cut those longer than `capacity`: one row per piece.

    Null texts are empty and give one piece of length 1. `with_ids` adds the ids themselves. `tokenizer` is a path that
    every executor can read.
    """
    path = tokenizer or default_tokenizer()

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.array([*coder.ids(text), END_ID], dtype="<u4")
                for piece, (a, b) in enumerate(bounds(len(ids), capacity)):
                    row = (doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                    rows.append((*row, ids[a:b].astype("int64")) if with_ids else row)
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    schema = _PIECES + (", ids array<bigint>" if with_ids else "")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInPandas(cut, schema)


class Capacities:
    """A segment tree over remaining capacities: which of them have open bins."""

    def __init__(self, most: int):
        self.leaves = 1
        while self.leaves <= most:
            self.leaves *= 2
        self.open = [False] * (2 * self.leaves)

    def set(self, capacity: int, is_open: bool) -> None:
        node = capacity + self.leaves
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, least: int) -> int:
        """The smallest capacity with an open bin that is at least this, or -1."""
        node = least + self.leaves
        if self.open[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return -1


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Pack items given as counts per length; exact best-fit decreasing, whatever the number of items.

    Items of one length are alike and so are bins that have the same content, so bins are kept as runs of numbers. An item
    goes to the tightest open bin. A bin of remaining capacity r that was the tightest for length s stays so until less than
    s remains, hence it takes r // s items in a row and the bins of its run follow one by one.

    Returns rows (length, first item, end item, first bin, items per bin, offset): item i of that length, counted from 0,
    lies in bin `first bin + (i - first) // per bin`, at `offset + (i - first) % per bin * length`. There are at most
    three runs per length, so the rows do not grow with the items.
    """
    tree = Capacities(capacity)
    runs: dict[int, list[tuple[int, int]]] = {}
    bins = 0
    rows = []

    def put(left: int, first: int, n: int) -> None:
        if n and left:
            runs.setdefault(left, []).append((first, n))
            tree.set(left, True)

    for length in sorted(counts, reverse=True):
        item, end = 0, counts[length]
        while item < end:
            left = tree.tightest(length)
            if left < 0:
                per = capacity // length
                first, n, left = bins, -(-(end - item) // per), capacity
                bins += n
            else:
                first, n = runs[left].pop()
                if not runs[left]:
                    tree.set(left, False)
            per = left // length
            placed = min(end - item, n * per)
            rows.append((length, item, item + placed, first, per, capacity - left))
            full, rest = divmod(placed, per)
            put(left - per * length, first, full)
            if rest:
                put(left - rest * length, first + full, 1)
            used = full + (rest > 0)
            put(left, first + used, n - used)
            item += placed
    return rows


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, start, length, ...).

    The driver gets only the number of pieces per length (at most `capacity` rows). Which item of its length a piece is
    follows from counts (`positions`), so no length, however common, meets in one task. Repeated rows are packed each.
    `pieces` is read three times: stage them.
    """
    kept = [f"`{c}`" for c in pieces.columns]
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    schema = "__length bigint, __lo bigint, __hi bigint, __bin bigint, __per bigint, __offset bigint"
    rows = pieces.sparkSession.createDataFrame(best_fit_decreasing(counts, capacity), schema)
    placed = positions(pieces, ["length"], [], ["doc_id", "piece", "ids_crc32"], "__at")
    at = F.col("__at") - F.col("__lo")
    on = (F.col("length") == F.col("__length")) & (at >= 0) & (F.col("__at") < F.col("__hi"))
    found = placed.join(F.broadcast(rows), on)  # bounded by the capacity, whatever the data
    return found.select(
        *kept,
        (F.col("__bin") + F.floor(at / F.col("__per")).cast("bigint")).alias("sequence_id"),
        (F.col("__offset") + at % F.col("__per") * F.col("length")).alias("offset"),
    )


def op10(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    return place(stage(token_pieces(docs, capacity, tokenizer), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """Token sequences of placed pieces that carry `ids`: sequence_id, ids in order of offset."""
    parts = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))


