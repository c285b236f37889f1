"""Quality from supervised subword embeddings."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, training_rows

FOLDS, HELD_OUT_FOLD = 5, 0
THRESHOLD = 0.3


@dataclass(frozen=True)
class Settings:
    """Documented bounds and shape of the model."""

    most_labelled: int = 2500  # labelled documents that the model is fitted on, at most (about)
    buckets: int = 1 << 16  # at most that many: their numbers travel as 16 bits
    shortest: int = 3  # characters of a character n-gram, with the marks of the word's ends
    longest: int = 5
    dimensions: int = 16
    epochs: int = 5
    rate: float = 0.3
    seed: int = 7


class Words:
    """Numbers words, and works out the buckets of new ones together: the word itself and its character n-grams.

    Buckets of a word are in line in `ids`, from `starts`. With `odds`, only each word's mean log-odds are kept.
    """

    LIMIT = 1_000_000  # words kept at a time; beyond, the store starts anew

    def __init__(self, settings: Settings, odds: np.ndarray | None = None):
        self.settings, self.odds = settings, odds
        self.clear()

    def clear(self) -> None:
        self.places: dict[bytes, int] = {}
        self.hashes = np.zeros(0, np.uint64)
        self.values = np.zeros(0, np.float64)
        self.ids = np.zeros(0, np.int64)
        self.starts = np.zeros(1, np.int64)

    def _buckets(self, hashes: np.ndarray) -> np.ndarray:
        mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(self.settings.buckets)).astype(np.int64)

    def _grams(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the words, the buckets of all their parts, and the word that each part is of."""
        shape = self.settings
        whole = np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))
        data = np.frombuffer(b"".join([b"<" + w + b">" for w in words]), dtype=np.uint8).astype(np.uint64)
        owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
        ids, owners = [self._buckets(whole)], [np.arange(len(words))]
        for n in range(shape.shortest, shape.longest + 1):
            m = len(data) - n + 1
            if m <= 0:
                break
            gram = np.full(m, n, dtype=np.uint64)
            for k in range(n):
                gram = gram * np.uint64(1_000_003) + data[k : k + m]
            inside = owner[:m] == owner[n - 1 :]
            ids.append(self._buckets(gram[inside]))
            owners.append(owner[:m][inside])
        return whole, np.concatenate(ids), np.concatenate(owners)

    def learn(self, texts: list[list[bytes]]) -> None:
        """Make room for the words of these texts."""
        if len(self.places) > self.LIMIT:
            self.clear()
        new = sorted({w for words in texts for w in words} - self.places.keys())
        for a in range(0, len(new), 20_000):
            words = new[a : a + 20_000]
            self.places.update(zip(words, range(len(self.hashes), len(self.hashes) + len(words))))
            hashes, ids, owners = self._grams(words)
            sizes = np.bincount(owners, minlength=len(words))
            self.hashes = np.concatenate([self.hashes, hashes])
            if self.odds is not None:
                self.values = np.concatenate([self.values, np.bincount(owners, self.odds[ids], len(words)) / sizes])
            else:
                self.ids = np.concatenate([self.ids, ids[np.argsort(owners, kind="stable")]])
                self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def text(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of a text, and the buckets of its word pairs. The words must be known."""
        places = np.fromiter(map(self.places.__getitem__, words), dtype=np.int64, count=len(words))
        hashes = self.hashes[places]
        left, right = hashes[:-1], hashes[1:]
        pairs = self._buckets(left * np.uint64(0xC2B2AE3D27D4EB4F) + right)
        return places, np.where(left == right, 0, pairs)  # a word said twice is one feature, whatever the word


def split(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").split() if text else []


def features(words: Words, text: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares: every word counts once, split among its n-grams, and so does every pair."""
    places, pairs = words.text(text)
    if not len(places):
        return np.zeros(0, np.int64), np.zeros(0)
    kinds, times = np.unique(places, return_counts=True)
    first, sizes = words.starts[kinds], words.starts[kinds + 1] - words.starts[kinds]
    inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    ids = np.concatenate([words.ids[np.repeat(first, sizes) + inner], pairs])
    shares = np.concatenate([np.repeat(times / sizes, sizes), np.ones(len(pairs))])
    kinds, inverse = np.unique(ids, return_inverse=True)
    return kinds, np.bincount(inverse, shares) / (len(places) + len(pairs))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings) -> tuple[np.ndarray, float]:
    """Train embeddings and softmax by stochastic gradient descent; returns each bucket's log-odds of label 1, and the bias.

    Rates follow the gradients seen (Adagrad). Without rows of both labels, every bucket is 0 and the bias follows the prior.
    """
    random = np.random.default_rng(settings.seed)
    labels = np.array([y for _, _, y in rows])
    prior = (labels.sum() + 1.0) / (len(labels) + 2.0)
    bias = np.log([1 - prior, prior])
    if len(set(labels.tolist())) < 2:
        return np.zeros(settings.buckets), float(bias[1] - bias[0])
    table = random.uniform(-0.5, 0.5, (settings.buckets, settings.dimensions)) / settings.dimensions
    out = random.normal(0, 0.5, (settings.dimensions, 2))
    seen_table = np.full(settings.buckets, 1e-6)
    seen_out, seen_bias = np.full_like(out, 1e-3), np.full(2, 1e-3)
    for _ in range(settings.epochs):
        for i in random.permutation(len(rows)):
            ids, shares, label = rows[i]
            shares = shares.astype(np.float64)
            mean = shares @ table[ids]
            logits = mean @ out + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            hidden = out @ p
            step = np.outer(mean, p)
            seen_out += step**2
            seen_bias += p**2
            seen_table[ids] += shares**2 * (hidden @ hidden) / settings.dimensions
            table[ids] -= np.outer(settings.rate * shares / np.sqrt(seen_table[ids]), hidden) * 0.3
            out -= settings.rate * step / np.sqrt(seen_out)
            bias -= settings.rate * 0.1 * p / np.sqrt(seen_bias)
    return table @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0])


def learn(docs: DataFrame, labels: DataFrame, settings: Settings, column: str = "quality") -> tuple[np.ndarray, float]:
    """Fit on a bounded sample of labelled rows; their features are computed on the executors."""

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words(settings)
        for batch in batches:
            texts = [split(t) for t in batch["text"]]
            words.learn(texts)
            found = [features(words, t) for t in texts]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "label": batch["label"],
                    "ids": [i.astype("<u2").tobytes() for i, _ in found],
                    "shares": [s.astype("<f2").tobytes() for _, s in found],
                }
            )

    sample = training_rows(docs, labels, column, FOLDS, HELD_OUT_FOLD, settings.most_labelled)
    found = sample.mapInPandas(featured, "doc_id bigint, label int, ids binary, shares binary").toArrow()
    order = pc.sort_indices(found, sort_keys=[("doc_id", "ascending"), ("ids", "ascending")]).to_pylist()
    ids, shares, label = found["ids"], found["shares"], found["label"].to_pylist()
    rows = [(np.frombuffer(ids[i].as_buffer(), "<u2"), np.frombuffer(shares[i].as_buffer(), "<f2"), label[i]) for i in order]
    model = fit(rows, settings)  # the arrays are views of what arrived
    del rows, ids, shares, found
    pa.default_memory_pool().release_unused()
    return model


def score(docs: DataFrame, odds: np.ndarray, bias: float, settings: Settings) -> DataFrame:
    """Add `score`, the probability of label 1, from whole texts. Texts without words (and null) score the bias alone."""
    odds = odds.astype(np.float32)

    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = Words(settings, odds)
        for batch in texts:
            found = np.empty(len(batch))
            for a in range(0, len(batch), 500):
                some = [split(t) for t in batch.iloc[a : a + 500]]
                words.learn(some)
                for i, text in enumerate(some, a):
                    places, pairs = words.text(text)
                    total = words.values[places].sum() + odds[pairs].sum(dtype=np.float64)
                    found[i] = bias + total / max(1, len(places) + len(pairs))
            yield pd.Series(1 / (1 + np.exp(-np.clip(found, -700, 700))))

    udf = F.pandas_udf(scored, "double")
    return docs.withColumn("score", udf("text"))


def classify(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add score to all documents; their own columns stay, repeated rows are scored each.

    The label of a document is read only from rows that are not held out; labels, lang, source and doc_id are no inputs.
    """
    odds, bias = learn(docs, labels, settings)
    return score(docs, odds, bias, settings)


def op9(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = classify(docs.select("doc_id", "text"), labels)
    return scored.select(
        "doc_id",
        held_out(FOLDS, HELD_OUT_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
