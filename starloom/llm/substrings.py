"""Substring dedup by relative Lempel-Ziv parsing against reference blocks of earlier documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import _repeated, _salted, lookup
from ..operators.staging import stage
from .bits import bitmap, held
from .wordarrays import Words, mixed, rolled, words_in

WINDOW = 13  # words of the shortest factor that counts
GRAM = 6  # words of an anchor
BLOCK = 64  # windows that start in a reference block
HOT = 200_000  # rows of one window in one task
_PLACE = np.uint64(0xD6E8FEB86659FD93)  # tells equal words at several places apart
_KNOWN = 1_000_000  # words whose hashes a task keeps


class _Hashes(dict):
    """64-bit hashes of words, kept while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def words_of(text: str | None) -> list[bytes]:
    """Words as they are, cut at ASCII blanks."""
    return (text or "").encode("utf-8", "replace").split()


def _hashed(words: Sequence[bytes], known: _Hashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def anchors(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """For every window the least hash of the runs of `gram` words in it: equal windows have equal anchors, and neighbours mostly share one."""
    grams = rolled(hashes, gram)
    least, covers, wanted = grams, 1, window - gram + 1
    while covers < wanted:
        step = min(covers, wanted - covers)
        least, covers = np.minimum(least[: max(0, len(least) - step)], least[step:]), covers + step
    return least


def factors(words: Sequence[bytes], blocks: Sequence[Sequence[bytes]], window: int = WINDOW) -> list[tuple[int, int]]:
    """Spans (start, end) of `words` that are found in the blocks, from a greedy parse.

    From left to right, a window that a block has grows to the longest factor there; a word that starts none is a literal.
    The next factor may start as far before the end of the last that its first window crosses that end, so windows over
    the boundary of two factors are found as well. Spans that overlap or touch are joined.
    """
    known = _Hashes()
    reference = [w for block in blocks for w in block]
    ends = np.repeat(np.cumsum([len(b) for b in blocks], dtype=np.int64), [len(b) for b in blocks])
    seeds = rolled(_hashed(reference, known), window)
    inside = np.flatnonzero(np.arange(len(seeds)) + window <= ends[: len(seeds)])
    places = inside[np.argsort(seeds[inside], kind="stable")]
    seeds, asked = seeds[places], rolled(_hashed(words, known), window)
    at = np.searchsorted(seeds, asked)
    hits = np.flatnonzero(seeds[np.minimum(at, len(seeds) - 1)] == asked) if len(seeds) else np.zeros(0, np.int64)
    spans: list[list[int]] = []
    start = 0
    while (k := int(np.searchsorted(hits, start))) < len(hits):
        start = int(hits[k])
        place = int(places[at[start]])
        end, limit = start, int(ends[place])
        while end < len(words) and place < limit and words[end] == reference[place]:
            end, place = end + 1, place + 1
        if end - start < window:  # equal hashes of other words
            start += 1
            continue
        if spans and start <= spans[-1][1]:
            spans[-1][1] = end
        else:
            spans.append([start, end])
        start = end - window + 1
    return [(a, b) for a, b in spans]


def _sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, class, n_words, whole): the class is a 128-bit hash of the words, `whole` their digest if nothing goes."""

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, counts, whole = [], [], []
            for words in words_in(batch["text"]):
                joined = words.joined()
                classes += map(xxhash.xxh3_128_digest, joined)
                whole += [hashlib.sha256(x).hexdigest() for x in joined]
                counts += words.counts.tolist()
            columns = [batch["doc_id"], pa.array(classes, pa.binary()), pa.array(counts, pa.int64()), pa.array(whole, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "class", "n_words", "whole"])

    return docs.mapInArrow(sized, "doc_id bigint, class binary, n_words bigint, whole string")


def _windows(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The text of every word, and where the windows start that lie within a text."""
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    room = words.firsts[1:][text] - np.arange(len(text))
    return text, np.flatnonzero(room >= WINDOW)


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """(anchor, class) for the anchors of every document; the class is a 64-bit hash of its words."""

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_in(batch["text"]):
                text, starts = _windows(words)
                if not len(starts):
                    continue
                hashes = words.hashes()
                found, text_of = anchors(hashes)[starts], text[starts]
                place = (np.arange(len(text)) - words.firsts[text]).astype(np.uint64)
                class_ = np.zeros(len(words.counts), dtype=np.uint64)
                with_words = np.flatnonzero(words.counts)
                class_[with_words] = np.add.reduceat(mixed(hashes + place * _PLACE), words.firsts[with_words])
                new = np.ones(len(starts), dtype=bool)  # neighbours mostly share an anchor
                new[1:] = (found[1:] != found[:-1]) | (text_of[1:] != text_of[:-1])
                columns = [found[new].view(np.int64), class_[text_of[new]].view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "class"])

    return docs.mapInArrow(anchored, "anchor bigint, class bigint")


def _window_rows(docs: DataFrame, shared: Broadcast, first: Broadcast) -> DataFrame:
    """(window, doc_id, start) for the windows whose anchor may be in several documents, of documents that may be the first of their class."""

    def windowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(held(first.value, batch["doc_id"].to_numpy().view(np.uint64))))
            ids = batch["doc_id"].to_numpy()
            for words in words_in(batch["text"]):
                text, starts = _windows(words)
                if not len(starts):
                    continue
                hashes = words.hashes()
                starts = starts[held(shared.value, anchors(hashes)[starts])]
                own = text[starts]
                columns = [rolled(hashes, WINDOW, starts).view(np.int64), ids[words.rows][own], starts - words.firsts[own]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["window", "doc_id", "start"])

    return docs.mapInArrow(windowed, "window bigint, doc_id bigint, start bigint")


def _references(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, holder, block): the reference blocks that hold the first places of a document's windows.

    A window's first place is the least (doc_id, start). The places of a window are joined with it in as many tasks as its
    count asks for, so a passage that a third of all documents have is not one task's work.
    """
    places = F.min(F.struct("doc_id", "start")).alias("first")
    firsts = rows.groupBy("window").agg(places, F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
    firsts = stage(firsts.filter("first.doc_id < last").select("window", "first.*", "n"), "firsts")
    most = max(HOT, (firsts.agg(F.sum("n")).first()[0] or 0) // 10_000)  # so at most 10,000 windows are hot, and broadcast
    hot = firsts.filter(F.col("n") > most).select(F.col("window").alias("__key0"), F.ceil(F.col("n") / most).cast("int").alias("__tasks"))
    block = F.expr(f"start div {BLOCK}").alias("block")
    one = firsts.select(F.col("window").alias("__window"), F.col("doc_id").alias("holder"), block)
    if hot.isEmpty():
        both = rows.join(one, F.col("window") == F.col("__window"))
    else:
        many, one = _salted(rows, ["window"], hot, True), _repeated(one, ["__window"], hot, True)
        both = many.join(one, (F.col("window") == F.col("__window")) & (F.col("__salt") == F.col("__other")))
    return both.filter("holder < doc_id").select("doc_id", "holder", "block").distinct()


def _blocks(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(holder, block, reference): the words of the wanted blocks, with as many behind them as their last window needs."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, text, numbers in zip(batch["doc_id"], batch["text"], batch["blocks"]):
                words = words_of(text)
                parts = [words[BLOCK * b : BLOCK * (b + 1) + WINDOW - 1] for b in numbers]
                texts = [b" ".join(p).decode("utf-8") for p in parts]
                yield pd.DataFrame({"holder": doc_id, "block": list(numbers), "reference": texts})

    needed = wanted.groupBy("holder").agg(F.collect_set("block").alias("blocks"))
    texts = docs.join(needed, F.col("doc_id") == F.col("holder")).select("doc_id", "text", "blocks")
    found = texts.mapInPandas(cut, "holder bigint, block bigint, reference string")
    return found.groupBy("holder", "block").agg(F.collect_set("reference").alias("references"))  # several, if an id has several texts


def _parsed(docs: DataFrame, references: DataFrame) -> DataFrame:
    """(doc_id, class, gone, n_removed, left): every document with references, parsed against all of them."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, blocks in zip(batch["doc_id"], batch["text"], batch["blocks"]):
                words = words_of(text)
                gone = factors(words, [words_of(b) for b in sorted(set(blocks))])
                kept = [w for a, b in zip([0, *(e for _, e in gone)], [*(s for s, _ in gone), len(words)]) for w in words[a:b]]
                spans = [{"start": a, "end": b} for a, b in gone]
                left = hashlib.sha256(b" ".join(kept)).hexdigest()
                rows.append((doc_id, xxhash.xxh3_128_digest(b" ".join(words)), spans, len(words) - len(kept), left))
            yield pd.DataFrame(rows, columns=["doc_id", "class", "gone", "n_removed", "left"])

    held_by = references.groupBy("doc_id").agg(F.flatten(F.collect_list("references")).alias("blocks"))
    both = docs.join(held_by.withColumnRenamed("doc_id", "__id"), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "blocks")
    schema = "doc_id bigint, class binary, gone array<struct<start:bigint,end:bigint>>, n_removed bigint, left string"
    return both.mapInPandas(parse, schema).dropDuplicates(["doc_id", "class"])


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, class, n_words, gone, n_removed, kept_sha256) for every document: `gone` are the spans of words, (start, end),
    that are covered by windows of 13 words which also start in a document with a smaller doc_id.

    Documents with the same words are folded first: all but those with the smallest doc_id lose everything. Of the
    others only windows are shuffled whose anchor occurs in several texts, as far as a bitmap of fixed size can tell; the least
    place of each is its place in the index. Blocks of 64 windows that hold such places are the reference, and every
    document is parsed greedily against all blocks that hold a window of it; words are compared, not hashes of them.

    Null texts are empty; a document of fewer than 13 words keeps all. Rows with a null doc_id have no place in the order: they keep all and
    take nothing from others. Rows that repeat a doc_id are no earlier than each other. Other columns are not used.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sizes = stage(_sizes(docs), "sizes")
    copies = sizes.groupBy("class").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last")).filter("least < last")
    rows = stage(lookup(sizes, copies, "class", ["least"]), "rows")
    known = docs.filter("doc_id is not null")
    several = _anchor_rows(known).groupBy("anchor").agg(F.min("class").alias("a"), F.max("class").alias("b")).filter("a <> b")
    shared = bitmap(several, "anchor")
    first = bitmap(rows.filter("least is null or least = doc_id"), "doc_id")
    references = stage(_references(known, _window_rows(known, shared, first)), "references")
    blocks = stage(_blocks(known, references.select("holder", "block").distinct()), "blocks")
    found = _parsed(known, lookup(references, blocks, ["holder", "block"], ["references"], "inner"))
    found = found.select(F.col("doc_id").alias("__id"), F.col("class").alias("__class"), "gone", "n_removed", "left")
    both = rows.join(found, (F.col("doc_id") == F.col("__id")) & (F.col("class") == F.col("__class")), "left")
    copy = (F.col("least") < F.col("doc_id")) & (F.col("n_words") >= WINDOW)
    everything = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_words").alias("end")))
    nothing = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return both.select(
        "doc_id",
        "class",
        "n_words",
        F.when(copy, everything).otherwise(F.coalesce("gone", nothing)).alias("gone"),
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("left", "whole")).alias("kept_sha256"),
    )


def dedup(docs: DataFrame) -> DataFrame:
    """Documents without the spans that `spans` finds: `text` becomes the words that are left, joined by one blank, where any
    went, and stays as it is elsewhere; n_removed follows. Other columns stay, but for one of that name."""
    found = spans(docs).filter("n_removed > 0").select(F.col("doc_id").alias("__id"), F.col("class").alias("__class"), "gone", "n_removed")
    found = found.dropDuplicates(["__id", "__class"])

    @F.pandas_udf("binary")
    def class_of(texts: pd.Series) -> pd.Series:
        return pd.Series([xxhash.xxh3_128_digest(b" ".join(words_of(t))) for t in texts], dtype=object)

    @F.pandas_udf("string")
    def left(texts: pd.Series, gone: pd.Series) -> pd.Series:
        out = []
        for text, cuts in zip(texts, gone):
            words, at = words_of(text), 0
            kept: list[bytes] = []
            for cut in cuts:
                kept, at = kept + words[at : cut["start"]], cut["end"]
            out.append(b" ".join(kept + words[at:]).decode("utf-8"))
        return pd.Series(out, dtype=object)

    names = [c for c in docs.columns if c not in ("text", "n_removed")]
    marked = docs.withColumn("__own", class_of("text"))
    both = marked.join(found.withColumnRenamed("n_removed", "__n"), (F.col("doc_id") == F.col("__id")) & (F.col("__own") == F.col("__class")), "left")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(left(F.coalesce("text", F.lit("")), F.coalesce("gone", F.array())))
    return both.select(*[f"`{c}`" for c in names], text.alias("text"), F.coalesce("__n", F.lit(0).cast("bigint")).alias("n_removed"))


def op12(docs: DataFrame) -> DataFrame:
    return spans(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP12_SQL = r"""
WITH cut AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
),
starts AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 11, 1))) AS i FROM cut),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS sequence FROM starts),
firsts AS (SELECT sequence, min(doc_id) AS least FROM windows GROUP BY sequence),
covered AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN firsts USING (sequence) WHERE least < doc_id
),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM cut),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS left_over, count(*) AS n FROM placed ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(left_over, '')) AS kept_sha256
FROM cut LEFT JOIN kept USING (doc_id)
"""
