"""Spelling variants: words one edit apart, found through one-edit neighbourhoods over a reduced alphabet."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup
from ..operators.staging import stage
from .bits import bitmap, held

# The letters, and how runs are damaged and words are chosen.
LETTERS = "[A-Za-zÀ-ÿ]+"
DAMAGE = 97
SHORTEST = 5
FEWEST = 3

SYMBOLS = 16  # of the reduced alphabet: a letter's symbol is its code point modulo so many
_BASE = 0x9E3779B97F4A7C15  # of the polynomial that keys reduced words; odd, so it has an inverse
_KNOWN = 500_000  # runs that a task counts before it sends them on
_AT_ONCE = 500_000  # occurrences, or keys, that a task works on at once
_BYTES = 64  # of a run, up to which its checksum is taken from a table

_RUN = re.compile(LETTERS)
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def runs_of(text: str) -> list[str]:
    """Maximal runs of letters; only A to Z are lower-cased."""
    return _RUN.findall(text.lower() if text.isascii() else text.translate(_LOWER))


def _zero_bytes(most: int) -> np.ndarray:
    """tables[n, k, b]: what the checksum b << 8 k becomes by n zero bytes. A checksum's bytes can be taken on their own."""
    ends = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], dtype=np.uint32)
    tables = np.empty((most + 1, 4, 256), dtype=np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(most):
        tables[n + 1] = (tables[n] >> 8) ^ ends[tables[n] & 255]
    return tables


class _Index(dict):
    """Numbers runs as they come, and keeps their checksums and lengths."""

    def __init__(self) -> None:
        self.runs: list[str] = []
        self.checks: list[int] = []
        self.sizes: list[int] = []

    def __missing__(self, run: str) -> int:
        self[run] = number = len(self.runs)
        coded = run.encode("utf-8")
        self.runs.append(run)
        self.checks.append(zlib.crc32(coded))
        self.sizes.append(len(coded))
        return number


class Tally:
    """Occurrences of damaged runs: crc32 of `<doc_id>:<run>` says whether a run loses a letter, and which."""

    def __init__(self) -> None:
        self.index, self.counts = _Index(), Counter()
        self.numbers: list[np.ndarray] = []
        self.prefixes: list[int] = []
        self.waiting = 0
        self.tables = _zero_bytes(_BYTES)

    def add(self, doc_id: int | None, text: str) -> None:
        runs = runs_of(text)
        self.numbers.append(np.fromiter(map(self.index.__getitem__, runs), dtype=np.int64, count=len(runs)))
        self.prefixes.append(zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()))
        self.waiting += len(runs)
        if self.waiting > _AT_ONCE:
            self.count()

    def count(self) -> None:
        if not self.waiting:
            return
        index = self.index
        numbers = np.concatenate(self.numbers)
        prefix = np.repeat(np.array(self.prefixes, dtype=np.uint32), [len(n) for n in self.numbers])
        sizes = np.array(index.sizes)[numbers]
        tables, short = self.tables, np.minimum(sizes, _BYTES)
        moved = np.zeros(len(numbers), dtype=np.uint32)
        for k in range(4):
            moved ^= tables[short, k, (prefix >> np.uint32(8 * k)) & np.uint32(255)]
        check = moved ^ np.array(index.checks, dtype=np.uint32)[numbers]
        for at in np.flatnonzero(sizes > _BYTES):
            check[at] = zlib.crc32(index.runs[numbers[at]].encode(), int(prefix[at]))
        hit = check % np.uint32(DAMAGE) == 0
        whole = np.bincount(numbers[~hit], minlength=len(index.runs))
        for number in np.flatnonzero(whole):
            self.counts[index.runs[number]] += int(whole[number])
        for number, h in zip(numbers[hit].tolist(), check[hit].tolist()):
            run = index.runs[number]
            at = h % len(run)
            self.counts[run[:at] + run[at + 1 :]] += 1
        self.numbers, self.prefixes, self.waiting = [], [], 0

    def take(self) -> pd.DataFrame:
        """The counted words that are long enough; starts anew."""
        self.count()
        found = [(w, n) for w, n in self.counts.items() if len(w) >= SHORTEST]
        self.index, self.counts = _Index(), Counter()
        return pd.DataFrame(found, columns=["word", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): the damaged runs of at least 5 letters that occur 3 times or more in all documents."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tally = Tally()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                tally.add(None if doc_id == "" else doc_id, text)
                if len(tally.index) + len(tally.counts) > _KNOWN:
                    yield tally.take()
        yield tally.take()

    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id")
    texts = docs.filter("text is not null").select(doc_id, "text")
    found = texts.mapInPandas(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return found.filter(F.col("n") >= FEWEST)


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return keys ^ (keys >> np.uint64(29))


def _reduced(words: Sequence[str]) -> np.ndarray:
    """Symbols, from 1, of words of one length: a row each."""
    letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), -1)
    return (letters % SYMBOLS + 1).astype(np.uint64)


def _powers(count: int) -> np.ndarray:
    factors = np.full(count + 1, _BASE, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def own_keys(words: Sequence[str]) -> np.ndarray:
    """The keys of the reduced words, of one length."""
    symbols = _reduced(words)
    return _mixed((symbols * _powers(symbols.shape[1])[:-1]).sum(axis=1, dtype=np.uint64))


def neighbourhood(words: Sequence[str]) -> Iterator[np.ndarray]:
    """Keys of the reduced words, of one length, and of everything one edit away from them over the symbols: arrays with a row per word.

    A key is a polynomial of the symbols, so an edit's key follows from the sums before and behind its place, in constant
    time. Word by word this is the whole one-edit neighbourhood; keys may occur more than once.
    """
    symbols = _reduced(words)
    size = symbols.shape[1]
    powers = _powers(size)
    base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    before = np.zeros((len(words), size + 1), dtype=np.uint64)
    np.cumsum(symbols * powers[:-1], axis=1, dtype=np.uint64, out=before[:, 1:])
    whole = before[:, -1:]
    yield _mixed(before[:, :-1] + (whole - before[:, 1:]) * inverse)  # a symbol less
    longer = before + (whole - before) * base
    for symbol in range(1, SYMBOLS + 1):
        symbol = np.uint64(symbol)
        yield _mixed(longer + symbol * powers)  # a symbol more
        yield _mixed(whole + (symbol - symbols) * powers[:-1])  # another symbol, or the same


def _by_length(words: Sequence[str]) -> Iterator[np.ndarray]:
    """Places of words of one length each, as many at once as make a bounded number of letters."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        step = max(1, _AT_ONCE // int(size))
        for start in range(0, len(places), step):
            yield places[start : start + step]


def _numbered(counts: DataFrame) -> DataFrame:
    """Counted words with the key of their reduced form and an id, written once."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words, keys = batch["word"].tolist(), np.zeros(len(batch), dtype=np.uint64)
            for places in _by_length(words):
                keys[places] = own_keys([words[p] for p in places])
            yield batch.assign(key=keys.view(np.int64))

    found = counts.mapInPandas(keyed, "word string, n bigint, key bigint")
    return stage(found.withColumn("id", F.monotonically_increasing_id()), "words")


def _candidates(words: DataFrame) -> DataFrame:
    """(id, key): for every word the keys of its reduced neighbourhood that the vocabulary may have."""
    bits = bitmap(words, "key")

    def generated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids = batch["word"].tolist(), batch["id"].to_numpy(np.int64)
            for places in _by_length(texts):
                rows, keys = [], []
                for found in neighbourhood([texts[p] for p in places]):
                    row, column = np.nonzero(held(bits.value, found))
                    rows.append(row)
                    keys.append(found[row, column])
                out = pd.DataFrame({"id": ids[places][np.concatenate(rows)], "key": np.concatenate(keys).view(np.int64)})
                yield out.drop_duplicates()

    return words.select("id", "word").mapInPandas(generated, "id bigint, key bigint")


def _near(words: DataFrame) -> DataFrame:
    """(id, n_near, best): near words of every word that has any, and the most frequent of them.

    The generated keys are joined with the vocabulary by its own keys; what meets is checked on the words themselves.
    """
    other = words.select(F.col("key").alias("__key"), F.col("id").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = _candidates(words).join(other, F.col("key") == F.col("__key")).filter("id <> other").select("id", "other", "near", "near_n")
    own = words.select(F.col("id").alias("__id"), "word")
    one_edit = F.levenshtein("word", "near", 1) == 1
    pairs = met.join(own, (F.col("id") == F.col("__id")) & one_edit)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near", "other")).alias("best")
    return pairs.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best)


def _roots(links: DataFrame) -> DataFrame:
    """(id, root) for links (id, root) that each lead on to at most one: the last of every chain, found by doubling the steps.

    A form is at least twice as frequent as its word, so a chain has at most 62 links, and there are at most 6 rounds.
    """
    while True:
        ahead = links.select(F.col("id").alias("from"), F.col("root").alias("ahead"))
        moved = stage(lookup(links, ahead, {"root": "from"}, ["ahead"]), "roots")
        if moved.filter("ahead is not null").isEmpty():
            return moved.select("id", "root")
        links = moved.select("id", F.coalesce("ahead", "root").alias("root"))


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word: its most frequent near word where that is at least twice as
    frequent, the last such form that it leads to, and how many words are near.

    Letters are hashed to a few symbols. Of every reduced word the whole one-edit neighbourhood is generated and joined with
    the reduced vocabulary, and what meets is verified on the words. Keys that no word can have are left out before the join by a
    bitmap of fixed size; a full one lets all through, so the result does not depend on it. Words of any length are
    handled: a neighbourhood's keys take constant time each, and no neighbour is ever written out.

    Null and empty texts have no words. A null doc_id is empty text before the colon. Repeated rows count each. Other columns are not used.
    """
    words = _numbered(word_counts(docs.select("doc_id", "text")))
    near = _near(words).select(F.col("id").alias("__id"), "n_near", "best")
    both = words.join(near, F.col("id") == F.col("__id"), "left").drop("__id", "key")
    frequent = -F.col("best.less") >= 2 * F.col("n")
    both = both.select(
        "id",
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"),
        F.when(frequent, -F.col("best.less")).alias("form_n"),
        F.when(frequent, F.col("best.other")).alias("form_id"),
    )
    both = stage(both, "forms")
    roots = _roots(both.filter("form_id is not null").select("id", F.col("form_id").alias("root")))
    named = lookup(roots, words.select("id", "word"), {"root": "id"}, {"word": "root_word"})
    named = named.select(F.col("id").alias("__id"), "root_word")
    found = both.join(named, F.col("id") == F.col("__id"), "left")
    return found.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def op11(docs: DataFrame) -> DataFrame:
    return variants(docs)


OP11_SQL = r"""
WITH RECURSIVE bits AS (
    SELECT list(crc ORDER BY b) AS steps FROM (
        SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS crc
        FROM range(256) AS t(b)
    )
),
runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
),
grouped AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS marked, run, count(*) AS n FROM runs GROUP BY ALL),
coded AS (SELECT run, n, hex(encode(marked)) AS h FROM grouped),
bytes AS (
    SELECT run, n, list_transform(range(len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) AS b FROM coded
),
checked AS (
    SELECT run, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1])), 4294967295) AS h
    FROM bytes, bits
),
damaged AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n
    FROM checked
),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
pairs AS (
    SELECT l.word, w.word AS near, w.n AS near_n FROM less l JOIN words w ON w.word = l.rest
    UNION
    SELECT w.word, l.word, l.n FROM less l JOIN words w ON w.word = l.rest
    UNION
    SELECT a.word, b.word, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i WHERE a.word <> b.word
),
best AS (
    SELECT word, count(*) AS n_near, max(near_n) AS most, arg_min(near, struct_pack(less := -near_n, near := near)) AS near FROM pairs GROUP BY word
),
forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * w.n THEN near END AS form,
           CASE WHEN most >= 2 * w.n THEN most END AS form_n
    FROM words w LEFT JOIN best USING (word)
),
chain AS (
    SELECT word, coalesce(form, word) AS root FROM forms
    UNION
    SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
),
lasts AS (SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM forms JOIN lasts USING (word)
"""
