"""Line dedup by pairwise alignment of overlapping documents."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.staging import stage

LEAST_WORDS = 50
BLANKS = " \t\x0b\x0c\r"
_LINES = "doc_id bigint, digest bigint, lines array<bigint>, words array<int>"


def line_hashes(text: str) -> tuple[list[int], list[int]]:
    """A 64-bit hash of every line, blanks at its ends left out, and the number of its words."""
    lines = [line.strip(BLANKS) for line in text.split("\n")]
    return [xxhash.xxh3_64_intdigest(x.encode("utf-8", "replace")) - (1 << 63) for x in lines], [len(x.split()) for x in lines]


def rare_runs(lines: Sequence[int], words: Sequence[int], least: int) -> list[int]:
    """For every line with words, a hash of it and the lines after it, up to the first that makes `least` words.

    Single short lines are common and say nothing of an overlap; such runs are rare. Two documents that share a block of
    `least` words share the run that starts with the block.
    """
    found, end, held = [], 0, 0
    for start in range(len(lines)):
        while end < len(lines) and held < least:
            held += words[end]
            end += 1
        if held < least:
            break
        if words[start]:
            found.append(xxhash.xxh3_64_intdigest(np.array(lines[start:end], dtype="<i8").tobytes()) - (1 << 63))
        held -= words[start]
    return sorted(set(found))


def _anchors(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Patience: lines that occur once in either, as the longest chain that ascends in both."""
    once_a, once_b = Counter(a), Counter(b)
    where = {h: i for i, h in enumerate(a) if once_a[h] == 1}
    pairs = [(where[h], j) for j, h in enumerate(b) if once_b[h] == 1 and h in where]
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for n, (i, _) in enumerate(pairs):
        pile = bisect_left(tops, i)
        back.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(i)
            piles.append(n)
        else:
            tops[pile], piles[pile] = i, n
    chain, n = [], piles[-1] if piles else -1
    while n >= 0:
        chain.append(pairs[n])
        n = back[n]
    return chain[::-1]


_PASSES = 8  # alignments of two texts
_EFFORT = 64  # lines that an alignment may look at, per line of the two texts


def _rarest(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """The occurrences, paired in order, of the common line that both texts have least often; none without a common line."""
    once_a, once_b = Counter(a), Counter(b)
    common = once_a.keys() & once_b.keys()
    if not common:
        return []
    line = min(common, key=lambda h: (once_a[h] + once_b[h], h))
    return list(zip((i for i, h in enumerate(a) if h == line), (j for j, h in enumerate(b) if h == line)))


def matches(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Pairs of equal lines of a patience diff, in ascending order.

    Where no line is unique, the rarest common line gives the anchors. Texts that repeat few lines over and over would be cut
    into ever more pieces; after a fixed effort per line the rest is left unaligned (`common_lines` does not need it).
    """
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    effort = _EFFORT * (len(a) + len(b) + 16)
    while todo:
        low_a, high_a, low_b, high_b = todo.pop()
        while low_a < high_a and low_b < high_b and a[low_a] == b[low_b]:
            found.append((low_a, low_b))
            low_a, low_b = low_a + 1, low_b + 1
        while low_a < high_a and low_b < high_b and a[high_a - 1] == b[high_b - 1]:
            high_a, high_b = high_a - 1, high_b - 1
            found.append((high_a, high_b))
        if low_a == high_a or low_b == high_b or effort < 0:
            continue
        effort -= high_a - low_a + high_b - low_b
        part_a, part_b = a[low_a:high_a], b[low_b:high_b]
        chain = [(i + low_a, j + low_b) for i, j in _anchors(part_a, part_b) or _rarest(part_a, part_b)]
        if not chain:
            continue
        found += chain
        edges = [(low_a - 1, low_b - 1), *chain, (high_a, high_b)]
        todo += [(i + 1, k, j + 1, n) for (i, j), (k, n) in zip(edges, edges[1:]) if i + 1 < k and j + 1 < n]
    return sorted(found)


def _least_runs(words: Sequence[int], least: int) -> Iterator[tuple[int, int]]:
    """The run of every line with words, forward to the first line that makes `least` words, and back to it likewise."""
    total = np.concatenate([[0], np.cumsum(words)])
    for k in range(len(words)):
        if words[k]:
            end = int(np.searchsorted(total, total[k] + least))
            if end < len(total):
                yield k, end
            start = int(np.searchsorted(total, total[k + 1] - least, side="right")) - 1
            if start >= 0:
                yield start, k + 1


def shared_lines(a: Sequence[int], b: Sequence[int], words: Sequence[int], least: int) -> set[int]:
    """Lines of b in any block of at least `least` words that a has as well, from the least runs that both have.

    Every line with words of such a block is in a least run inside it: from the line or back from it, or from before it to behind it.
    """
    n_words = dict(zip(b, words))
    bytes_a, bytes_b = (np.array(x, dtype="<i8").tobytes() for x in (a, b))
    held: set[bytes] = set()
    start = 0
    for end in [*(i for i, h in enumerate(a) if h not in n_words), len(a)]:  # a block has no line that b has not
        counts = [n_words[h] for h in a[start:end]]
        held.update(bytes_a[8 * (start + i) : 8 * (start + j)] for i, j in _least_runs(counts, least))
        start = end + 1
    return {k for i, j in _least_runs(words, least) if bytes_b[8 * i : 8 * j] in held for k in range(i, j)}


def common_lines(a: Sequence[int], b: Sequence[int], words: Sequence[int], least: int) -> list[int]:
    """Lines of b in blocks of at least `least` words that are aligned with a.

    What is left of b is aligned again until no block is found, or a few times: a block that crosses shorter ones may be on no
    chain anyway, so the lines of all blocks that both have are added from their runs.
    """
    left = list(range(len(b)))
    gone: list[int] = []
    for _ in range(_PASSES):
        pairs = matches(a, [b[k] for k in left])
        taken: list[int] = []
        block: list[int] = []
        last = None
        for i, n in [*pairs, (-9, -9)]:
            if last is not None and (i, n) == (last[0] + 1, last[1] + 1) and left[n] == left[n - 1] + 1:
                block.append(left[n])
            else:
                if sum(words[k] for k in block) >= least:
                    taken += block
                block = [left[n]] if n >= 0 else []
            last = (i, n)
        if not taken:
            break
        gone += taken
        out = set(taken)
        left = [k for k in left if k not in out]
    return sorted({*gone, *shared_lines(a, b, words, least)})


def deleted_lines(a: Sequence[int], b: Sequence[int], words_a: Sequence[int], words: Sequence[int], least: int) -> list[int]:
    """Lines of b in blocks that a has: as they stand, and with lines without words left out on both sides. Lines without words
    that stand between lines of one such block go with it."""
    found = set(common_lines(a, b, words, least))
    if not (all(words) and all(words_a)):
        at = [k for k, n in enumerate(words) if n]
        bare = [h for h, n in zip(a, words_a) if n], [b[k] for k in at]
        more = shared_lines(*bare, [words[k] for k in at], least)
        for k in more:
            found.add(at[k])
            if k + 1 in more:
                found.update(range(at[k] + 1, at[k + 1]))
    return sorted(found)


def overlaps(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """Lines to delete: (doc_id, digest, gone), for each later document that shares a block with an earlier one.

    Runs are of lines with words: blank lines between them make no difference. For each rare run the first document that holds it is compared with every other holder, so the number of pairs grows
    with the shared runs and not with the square of the holders. The first holder keeps the run: of every run, one copy
    stays. Documents are in order of doc_id, and of a digest of the text where ids repeat.
    """

    def lined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [line_hashes(t) for t in batch["text"]]
            out = batch[["doc_id", "digest"]].copy()
            out["lines"] = [x for x, _ in found]
            out["words"] = [x for _, x in found]
            yield out[[sum(x) >= least for _, x in found]]

    @F.pandas_udf("array<bigint>")
    def runs(lines: pd.Series, words: pd.Series) -> pd.Series:
        with_words = [(a[n > 0].tolist(), n[n > 0].tolist()) for a, n in zip(lines, words)]
        return pd.Series([rare_runs(a, n, least) for a, n in with_words])

    @F.pandas_udf("array<int>")
    def aligned(a: pd.Series, b: pd.Series, words_a: pd.Series, words: pd.Series) -> pd.Series:
        sides = zip(a, b, words_a, words)
        return pd.Series([deleted_lines(x.tolist(), y.tolist(), m.tolist(), n.tolist(), least) for x, y, m, n in sides])

    texts = docs.select("doc_id", F.xxhash64("text").alias("digest"), "text").filter("doc_id is not null and text is not null")
    lines = stage(texts.mapInPandas(lined, _LINES), "lines")
    held = lines.select(F.struct("doc_id", "digest").alias("doc"), F.explode(runs("lines", "words")).alias("run"))
    held = stage(held, "runs")
    firsts = held.groupBy("run").agg(F.min("doc").alias("first"), F.max("doc").alias("__last")).filter("first < __last")
    pairs = held.join(firsts.drop("__last"), "run").filter("first < doc").select("first", "doc").distinct()
    lines = lines.dropDuplicates(["doc_id", "digest"]).select(F.struct("doc_id", "digest").alias("doc"), "lines", "words")
    later = pairs.join(lines, "doc")
    before = lines.select(F.col("doc").alias("first"), F.col("lines").alias("__before"), F.col("words").alias("__words"))
    both = later.join(before, "first")
    gone = both.select("doc", F.explode(aligned("__before", "lines", "__words", "words")).alias("line")).groupBy("doc")
    return gone.agg(F.sort_array(F.collect_set("line")).alias("gone")).select("doc.doc_id", "doc.digest", "gone")


def dedup(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """Documents without the blocks that an earlier document has: text is replaced; n_lines_removed and n_words_removed follow.

    Null texts stay null, empty ones empty. Rows with a null doc_id have no place in the order and stay as they are.
    Rows that repeat id and text are one document, so neither loses its lines to the other. Other columns stay, but for
    ones named like the two added.
    """
    gone = stage(overlaps(docs, least), "gone")
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.col("gone").alias("__gone"))
    on = (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__digest"))
    marked = docs.join(gone.hint("merge"), on, "left")  # grows with the documents, so it is not broadcast at any size
    marked = marked.withColumn("__lines", F.when(F.col("__gone").isNotNull(), F.split("text", "\n", -1)))
    # what is kept are the lines between one deleted line and the next, so each line is looked at once
    before = lambda k: F.coalesce(F.get("__gone", k - 1), F.lit(-1))
    behind = lambda k: F.coalesce(F.get("__gone", k), F.size("__lines"))
    places = F.sequence(F.lit(0), F.size("__gone"))
    left = F.array_join(F.flatten(F.transform(places, lambda k: F.slice("__lines", before(k) + 2, behind(k) - before(k) - 1))), "\n")
    removed = F.array_join(F.transform("__gone", lambda n: F.get("__lines", n)), "\n")
    names = [n for n in docs.columns if n not in ("text", "n_lines_removed", "n_words_removed")]
    whole = F.col("__gone").isNull()
    return marked.select(
        *[f"`{n}`" for n in names],
        F.when(whole, F.col("text")).otherwise(left).alias("text"),
        F.when(whole, 0).otherwise(F.size("__gone")).alias("n_lines_removed"),
        F.when(whole, 0).otherwise(F.regexp_count(removed, F.lit(r"[^\x20\x09-\x0D]+"))).alias("n_words_removed"),
    )


def op5(docs: DataFrame) -> DataFrame:
    return dedup(docs.select("doc_id", "text"))
