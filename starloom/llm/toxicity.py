"""Toxic spans and scores from a linear-chain conditional random field."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, training_rows

FOLDS, HELD_OUT_FOLD = 3, 1
THRESHOLD = 0.7
TOKEN = re.compile(r"\w+")
SPAN = "array<struct<start:int,end:int,probability:double>>"


@dataclass(frozen=True)
class Settings:
    """Documented bounds and shape of the model."""

    most_labelled: int = 4000  # labelled documents that the model is fitted on, at most (about)
    buckets: int = 1 << 20
    shortest: int = 3  # characters of a prefix or suffix
    longest: int = 8
    least_share: float = 0.6  # share of contexts in toxic documents from which a part of a word may mark toxicity
    segment: int = 200  # tokens of a training sequence; scoring always takes whole texts
    segments: int = 8_000  # training sequences, those with toxic tokens first
    rounds: int = 40
    rate: float = 0.5
    decay: float = 1e-6
    span_from: float = 0.5  # marginal probability from which a token is reported


def parts(token: str, settings: Settings) -> list[str]:
    """What is known of a token: the word, its prefixes and its suffixes, in lower case."""
    word = token.lower()
    cuts = range(settings.shortest, min(settings.longest, len(word) - 1) + 1)
    return ["=" + word, *["^" + word[:n] for n in cuts], *["$" + word[-n:] for n in cuts]]


class Tokens(dict):
    """Numbers the tokens it is asked for, and keeps the buckets of their parts."""

    def __init__(self, settings: Settings):
        super().__init__()
        self.settings = settings
        self.names: list[str] = []
        self.buckets: list[np.ndarray] = []

    def __missing__(self, token: str) -> int:
        place = self[token] = len(self.names)
        self.names.append(token)
        hashes = [zlib.crc32(p.encode("utf-8", "replace")) % self.settings.buckets for p in parts(token, self.settings)]
        self.buckets.append(np.array(hashes, dtype=np.int32))
        return place

    def text(self, text: str) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, TOKEN.findall(text)), dtype=np.int64)


@dataclass(frozen=True)
class Model:
    """Log-odds of each bucket, transition weights (from, to), start weights, and how marginals become a score."""

    odds: np.ndarray
    moves: np.ndarray
    bias: float
    scale: np.ndarray


def marginals(odds: np.ndarray, starts: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over many sequences at once.

    `odds` holds the tokens' log-odds of the toxic state, one sequence after the other. Returns each token's probability of
    that state, and the ratio of the forward sums up to each token (the gradient of the moves needs it). All sums are kept
    as ratios of the two states, so nothing overflows.
    """
    e = np.exp(moves)
    u = np.exp(np.clip(odds, -30, 30))
    forward, backward = np.empty_like(u), np.empty_like(u)
    order = np.argsort(-lengths, kind="stable")
    first, size = starts[order], lengths[order]
    longest = int(size[0]) if len(size) else 0
    active = len(size) - np.searchsorted(size[::-1], np.arange(longest), side="right")
    for t in range(longest):
        at = first[: active[t]] + t
        if t == 0:
            forward[at] = u[at]
        else:
            r = forward[at - 1]
            forward[at] = np.clip(u[at] * (e[0, 1] + e[1, 1] * r) / (e[0, 0] + e[1, 0] * r), 1e-200, 1e200)
    last = first + size - 1
    backward[last[size > 0]] = 1.0
    for t in range(longest - 2, -1, -1):
        at = first[: active[t + 1]] + t
        r = u[at + 1] * backward[at + 1]
        backward[at] = (e[1, 0] + e[1, 1] * r) / (e[0, 0] + e[0, 1] * r)
    joint = np.clip(forward, 1e-150, 1e150) * backward
    return joint / (1 + joint), forward


def mark_parts(tokens: Tokens, docs: Sequence[np.ndarray], toxic: np.ndarray, settings: Settings) -> np.ndarray:
    """Buckets of word parts that mark toxic documents: labelled tokens are those of toxic documents that have such a part.

    A part is judged by its contexts (the token before it, in lower case), counted once each on either side, so that copies
    of one text count once. It marks toxicity if most of its contexts are in toxic documents and so many cannot be chance,
    given the number of parts tried.
    """
    lower: dict[str, int] = {}
    word_of = np.array([lower.setdefault(t.lower(), len(lower)) for t in tokens.names], dtype=np.int64)
    sample_of = np.zeros(len(lower), dtype=np.int64)
    sample_of[word_of] = np.arange(len(word_of))  # one token for each word in lower case
    sides = []
    for label in (0, 1):
        chosen = [word_of[d] for d, y in zip(docs, toxic) if y == label and len(d)]
        pairs = [np.unique(np.concatenate([[len(lower)], d[:-1]]) * (len(lower) + 1) + d) for d in chosen]
        contexts = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        sides.append(np.bincount(contexts % (len(lower) + 1), minlength=len(lower)))
    marks = np.zeros(settings.buckets, dtype=bool)
    if not len(lower) or not sides[0].sum() or not sides[1].sum():
        return marks
    sizes = np.array([len(tokens.buckets[t]) for t in sample_of])
    columns = np.concatenate([tokens.buckets[t] for t in sample_of])
    clean, bad = (np.bincount(columns, np.repeat(side, sizes), settings.buckets) for side in sides)
    chance = sides[1].sum() / (sides[0].sum() + sides[1].sum())
    needed = np.log(max(int(((clean + bad) > 0).sum()), 2)) + 3.0
    share = np.divide(bad, clean + bad, out=np.zeros_like(bad), where=clean + bad > 0)
    rest = np.log(np.maximum(1 - share, 1e-12) / (1 - chance))
    gain = bad * np.log(np.maximum(share, 1e-12) / chance) + np.where(clean > 0, clean * rest, 0.0)
    return (share >= settings.least_share) & (gain >= needed)


def fit(texts: Sequence[str], toxic: Sequence[int], settings: Settings = Settings()) -> Model:
    """Train the field on labelled tokens by gradient ascent, then the score on the documents' labels."""
    tokens = Tokens(settings)
    docs = [tokens.text(t) for t in texts]
    marks = mark_parts(tokens, docs, np.array(toxic), settings)
    marked = np.array([marks[b].any() for b in tokens.buckets], dtype=bool)
    prior = (sum(toxic) + 1) / (len(toxic) + 2)
    if not len(marked) or not marked.any():
        return Model(np.zeros(settings.buckets), np.zeros((2, 2)), 0.0, np.array([np.log(prior / (1 - prior)), 0.0, 0.0]))
    segments = []
    for ids, label in zip(docs, toxic):
        hit = marked[ids]
        if label and not hit.any():
            continue  # nothing says which of its tokens are toxic
        for a in range(0, len(ids), settings.segment):
            segments.append((ids[a : a + settings.segment], hit[a : a + settings.segment] & bool(label)))
    random = np.random.default_rng(11)
    random.shuffle(segments)
    segments.sort(key=lambda s: not s[1].any())
    segments = segments[: settings.segments]
    flat = np.concatenate([s for s, _ in segments])
    truth = np.concatenate([y for _, y in segments]).astype(float)
    lengths = np.array([len(s) for s, _ in segments])
    starts = np.cumsum(lengths) - lengths
    inner = np.ones(len(flat), dtype=bool)
    inner[starts] = False
    here = np.flatnonzero(inner)
    sizes = np.array([len(b) for b in tokens.buckets])
    columns = np.concatenate(tokens.buckets)
    of_token = np.repeat(np.arange(len(sizes)), sizes)
    before, after = truth[here - 1], truth[here]
    wanted = np.array([[((1 - before) * (1 - after)).sum(), ((1 - before) * after).sum()], [(before * (1 - after)).sum(), (before * after).sum()]])
    weights, bias, moves = np.zeros(settings.buckets), 0.0, np.zeros((2, 2))
    seen_w, seen_b, seen_m = np.full(settings.buckets, 1e-8), 1e-8, np.full((2, 2), 1e-8)
    for _ in range(settings.rounds):
        by_token = np.bincount(of_token, weights[columns], len(sizes)) + bias
        odds = by_token[flat]
        p, forward = marginals(odds, starts, lengths, moves)
        error = (truth - p) / len(segments)
        per_token = np.bincount(flat, error, len(sizes))
        step = np.bincount(columns, per_token[of_token], settings.buckets) - settings.decay * weights
        # pair marginals follow from the forward ratio before a token and the probability of the token itself
        e, r = np.exp(moves), forward[here - 1]
        to_toxic, to_clean = e[1, 1] * r / (e[0, 1] + e[1, 1] * r), e[1, 0] * r / (e[0, 0] + e[1, 0] * r)
        now = p[here]
        held = np.array([[((1 - now) * (1 - to_clean)).sum(), (now * (1 - to_toxic)).sum()], [((1 - now) * to_clean).sum(), (now * to_toxic).sum()]])
        move_step, bias_step = (wanted - held) / len(segments), error.sum()
        seen_w += step**2
        seen_m += move_step**2
        seen_b += bias_step**2
        weights += settings.rate * step / np.sqrt(seen_w)
        moves += settings.rate * move_step / np.sqrt(seen_m)
        bias += settings.rate * bias_step / np.sqrt(seen_b)
    model = Model(weights, moves, float(bias), np.zeros(3))
    inputs = np.array([evidence(p) for p in probabilities(tokens, docs, model)])
    weights = weights.astype(np.float32)
    return Model(weights, moves, float(bias), _scale(inputs, np.array(toxic, dtype=float)))


def evidence(p: np.ndarray) -> tuple[float, float]:
    """What a document's marginals say: the log-odds of its most toxic token, and the log of the expected number of such."""
    if not len(p):
        return -8.0, 0.0
    most = min(max(float(p.max()), 3e-4), 1 - 3e-4)
    return float(np.log(most / (1 - most))), float(np.log1p(p[p > 0.05].sum()))


def _scale(inputs: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic regression from the evidence to the label, by Newton steps with a small ridge."""
    x = np.column_stack([np.ones(len(inputs)), inputs])
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 0.5 * np.eye(3)
        w += np.linalg.solve(hessian, x.T @ (labels - p) - 0.5 * w)
    return w


def probabilities(tokens: Tokens, docs: Sequence[np.ndarray], model: Model, values: list[float] | None = None) -> list[np.ndarray]:
    """Marginal probabilities of the tokens of each document."""
    values = [] if values is None else values
    values.extend(float(model.odds[b].sum()) + model.bias for b in tokens.buckets[len(values) :])
    lengths = np.array([len(d) for d in docs], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    flat = np.array(values)[np.concatenate(docs)] if lengths.sum() else np.zeros(0)
    p, _ = marginals(flat, starts, lengths, model.moves)
    return [p[a : a + n] for a, n in zip(starts, lengths)]


_LIMIT, _GROUP = 500_000, 2_000_000  # tokens kept at a time; characters scored together


def tag(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """Add `score` and `spans` (code points, end exclusive, probability) to documents.

    Whole texts are read. Null and empty texts have no spans and score what no evidence gives. Repeated rows are tagged each, and
    equal texts alike, whatever their id; an empty table gives no rows. Spans are in order and do not overlap, so none tie. Other
    columns stay, but for ones named like the two added.
    """

    @F.pandas_udf(f"struct<score:double,spans:{SPAN}>")
    def tagged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tokens, values = Tokens(settings), []
        for batch in batches:
            texts = ["" if t is None else t for t in batch]
            scores, spans = [], []
            a = 0
            while a < len(texts):
                b, chars = a, 0
                while b < len(texts) and (b == a or chars + len(texts[b]) <= _GROUP):
                    chars += len(texts[b])
                    b += 1
                if len(tokens.names) > _LIMIT:
                    tokens, values = Tokens(settings), []
                found = probabilities(tokens, [tokens.text(t) for t in texts[a:b]], model, values)
                for text, p in zip(texts[a:b], found):
                    x = model.scale @ np.array([1.0, *evidence(p)])
                    scores.append(1 / (1 + np.exp(-np.clip(x, -30, 30))))
                    hits = np.flatnonzero(p >= settings.span_from)
                    places = [m.span() for m in TOKEN.finditer(text)] if len(hits) else []
                    spans.append([{"start": places[h][0], "end": places[h][1], "probability": float(p[h])} for h in hits])
                a = b
            yield pd.DataFrame({"score": scores, "spans": spans})

    both = docs.withColumn("__tagged", tagged("text"))
    kept = [f"`{c}`" for c in docs.columns if c not in ("score", "spans")]
    return both.select(*kept, "__tagged.score", "__tagged.spans")


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on a bounded sample of labelled rows that are not held out."""
    sample = training_rows(docs, labels, "toxic", FOLDS, HELD_OUT_FOLD, settings.most_labelled)
    rows = sample.toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return fit(rows["text"].to_pylist(), [int(y > 0) for y in rows["label"].to_pylist()], settings)


def op8(docs: DataFrame, labels: DataFrame) -> DataFrame:
    slim = docs.select("doc_id", "text")
    scored = tag(slim, learn(slim, labels))
    places = F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return scored.select(
        "doc_id",
        held_out(FOLDS, HELD_OUT_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.concat_ws(",", places).alias("toxic_spans"),
    )
