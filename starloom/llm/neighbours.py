"""Approximate nearest neighbours over learned, balanced partitions."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.staging import stage


@dataclass(frozen=True)
class Settings:
    """Documented bounds of what is fitted, and shape of the index."""

    sample: int = 8192  # vectors that the partitions and the router are fitted on, at most (about)
    part_rows: int = 128  # rows for which one more partition pays, up to `parts`
    parts: int = 256  # partitions, at most; larger ones are searched in blocks
    neighbours: int = 10  # edges of a vector in the neighbour graph
    hidden: int = 128
    epochs: int = 20
    recall: float = 0.93  # of held-out sample queries; as many partitions are searched as that takes
    held_out: float = 0.2
    routed: int = 16  # lengths of vectors that get a router, those of most rows first; others are searched whole, in blocks
    block_rows: int = 4096  # rows and queries of one block of the search
    block_queries: int = 1024
    seed: int = 3


@dataclass(frozen=True)
class Router:
    """A small classifier: which partition holds a vector's neighbours, and how many of the likeliest to search."""

    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: np.ndarray
    probes: int

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        hidden = np.maximum(vectors @ self.first + self.first_bias, 0)
        return hidden @ self.second + self.second_bias


def nearest(vectors: np.ndarray, among: np.ndarray, k: int, own: bool) -> np.ndarray:
    """Places in `among` of the k nearest by cosine of unit vectors; `own` leaves out the place of the vector itself."""
    found = []
    for a in range(0, len(vectors), 512):
        scores = vectors[a : a + 512] @ among.T
        if own:
            scores[np.arange(len(scores)), np.arange(a, a + len(scores))] = -np.inf
        found.append(np.argpartition(-scores, k - 1, axis=1)[:, :k])
    return np.concatenate(found)


def bisect(edges: np.ndarray, n: int, random: np.random.Generator) -> np.ndarray:
    """Cut a graph into two halves, equal up to one node, with few edges between them.

    Values spread along the edges until neighbours have like values, the median splits them, and pairs of nodes that both
    gain by it change sides.
    """
    source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    degree = np.maximum(np.bincount(source, minlength=n), 1)
    values = random.normal(size=n)
    for _ in range(60):
        values = 0.3 * values + 0.7 * np.bincount(source, values[target], n) / degree
        values -= values.mean()
        values /= np.abs(values).max() + 1e-12
    side = np.zeros(n, dtype=bool)
    side[np.argsort(values, kind="stable")[n // 2 :]] = True
    for _ in range(12):
        across = side[source] != side[target]
        gain = np.bincount(source, np.where(across, 1.0, -1.0), n)
        left, right = np.flatnonzero(~side & (gain > 0)), np.flatnonzero(side & (gain > 0))
        m = min(len(left), len(right))
        if not m:
            break
        m = max(1, m // 2)  # neighbours that change sides together gain nothing
        moved = np.concatenate([left[np.argsort(-gain[left], kind="stable")[:m]], right[np.argsort(-gain[right], kind="stable")[:m]]])
        changed = side.copy()
        changed[moved] ^= True
        if (changed[source] != changed[target]).sum() >= across.sum():
            break
        side = changed
    return side


def balanced_parts(graph: np.ndarray, parts: int, random: np.random.Generator) -> np.ndarray:
    """Partition a neighbour graph (a row of neighbours per node) into equal parts, a power of two, by bisection."""
    label = np.zeros(len(graph), dtype=np.int64)
    edges = np.column_stack([np.repeat(np.arange(len(graph)), graph.shape[1]), graph.ravel()])
    for _ in range(int(math.log2(parts))):
        inside = edges[label[edges[:, 0]] == label[edges[:, 1]]]
        of_edge = label[inside[:, 0]]
        halves = np.zeros(len(graph), dtype=np.int64)
        for part in range(label.max() + 1):
            nodes = np.flatnonzero(label == part)
            place = np.zeros(len(graph), dtype=np.int64)
            place[nodes] = np.arange(len(nodes))
            halves[nodes] = bisect(place[inside[of_edge == part]], len(nodes), random)
        label = 2 * label + halves
    return label


def train_router(vectors: np.ndarray, targets: np.ndarray, settings: Settings, random: np.random.Generator) -> Router:
    """Fit the classifier to each vector's share of neighbours per partition by stochastic gradient descent (Adam)."""
    d, parts = vectors.shape[1], targets.shape[1]
    weights = [random.normal(0, (2 / d) ** 0.5, (d, settings.hidden)), np.zeros(settings.hidden)]
    weights += [random.normal(0, (1 / settings.hidden) ** 0.5, (settings.hidden, parts)), np.zeros(parts)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    steps = 0
    for epoch in range(settings.epochs):
        rate = 3e-3 * (1 - epoch / settings.epochs) + 1e-4
        for rows in np.array_split(random.permutation(len(vectors)), max(1, len(vectors) // 256)):
            x = vectors[rows] + random.normal(0, 0.05, (len(rows), d))
            hidden = np.maximum(x @ weights[0] + weights[1], 0)
            logits = hidden @ weights[2] + weights[3]
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = (p / p.sum(axis=1, keepdims=True) - targets[rows]) / len(rows)
            back = (error @ weights[2].T) * (hidden > 0)
            steps += 1
            for i, g in enumerate([x.T @ back, back.sum(0), hidden.T @ error, error.sum(0)]):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                weights[i] -= rate * (first[i] / (1 - 0.9**steps)) / (np.sqrt(second[i] / (1 - 0.999**steps)) + 1e-8)
    return Router(*weights, probes=parts)


def fit(sample: np.ndarray, parts: int, k: int, settings: Settings = Settings()) -> Router:
    """Learn partitions and router from sample vectors, and how many partitions a search needs.

    A share of the sample is held out; its nearest among the others are known exactly, and the least number of partitions
    that hold `recall` of them is taken. The whole table is denser than the sample, so its neighbours are closer still.
    """
    random = np.random.default_rng(settings.seed)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    unit = unit[random.permutation(len(unit))]
    queries, known = np.split(unit, [int(len(unit) * settings.held_out)])
    edges = min(settings.neighbours, len(known) - 1)
    d = unit.shape[1]
    if parts < 2 or edges < 1 or not len(queries):
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    graph = nearest(known, known, edges, own=True)
    label = balanced_parts(graph, parts, random)
    targets = np.zeros((len(known), parts))
    for column in (label, *label[graph].T):
        targets[np.arange(len(known)), column] += 1 / (edges + 1)
    router = train_router(known, targets, settings, random)
    holds = router.logits(known).argmax(axis=1)
    found = holds[nearest(queries, known, min(k, edges), own=False)]
    order = np.argsort(-router.logits(queries), axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(parts)[None, :], axis=1)
    needed = np.sort(np.take_along_axis(rank, found, axis=1).ravel())
    probes = int(needed[min(len(needed) - 1, math.ceil(settings.recall * len(needed)) - 1)]) + 1
    return Router(router.first, router.first_bias, router.second, router.second_bias, probes)


def usable(rows: DataFrame, key: str, vector: str, is_query: Column) -> DataFrame:
    """(vec_id, vector, asked) of the rows that take part: no nulls, finite, not all zero. Rows that repeat id and vector are one."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(vector, lambda x: x != 0)
    kept = rows.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & fine & some)
    kept = kept.select(F.col(f"`{key}`").cast("bigint").alias("vec_id"), F.col(vector).alias("vector"), is_query.alias("asked"))
    return kept.groupBy("vec_id", "vector").agg(F.coalesce(F.max("asked"), F.lit(False)).alias("asked"))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors brought near 1 by powers of two, which is exact, so that squares of very small or large components are not lost."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1))
    half = exponent // 2  # in two steps: a factor itself must be a finite number
    return np.ldexp(np.ldexp(vectors, -half[:, None]), -(exponent - half)[:, None])


def _units(vectors: list) -> np.ndarray:
    x = scaled(np.stack(vectors).astype(np.float64))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass(frozen=True)
class Place:
    """Where vectors of one length are in the index: from which part on, and the router among them (None: one part)."""

    first: int
    parts: int
    router: Router | None


def _top(scores: np.ndarray, ids: np.ndarray, exact, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of one query in one block: scores first, smaller ids at ties. `exact` gives scores that depend on the
    pair alone, so that equal vectors tie."""
    near = np.flatnonzero(scores >= np.partition(scores, -k)[-k] - 1e-9) if len(scores) > k else np.arange(len(scores))
    near = near[np.isfinite(scores[near])]
    found = exact(near)
    order = np.lexsort((ids[near], -found))[:k]
    return ids[near][order], found[order]


def search(
    rows: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by cosine found for each query among all other rows.

    Every row is put in its likeliest partition; a query goes to as many of its likeliest partitions as the router needs,
    and to more while these hold too few rows. A partition is searched in blocks of rows and queries, so neither a partition
    with most of the rows nor many queries meet in one task, and only the k best of a block leave it. Scores are cosines of
    the original vectors in double precision.

    Vectors of different lengths are not compared: each length that many rows have gets partitions and a router of its own, each
    other one a partition. Rows whose id or vector is null, and vectors that are zero or hold nulls or non-finite components, take
    no part. Rows that repeat id and vector are one; other vectors of an id are rows of their own, which are asked and found each.
    Equal scores go to the smaller id. An empty table gives no rows.
    """
    base = usable(rows, key, vector, is_query).withColumn("row", F.monotonically_increasing_id())
    base = stage(base.withColumn("length", F.size("vector")), "vectors")
    sizes = base.groupBy("length").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "length").collect()  # a row per length
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    if not sizes:
        return rows.sparkSession.createDataFrame([], empty)
    places: dict[int, Place] = {}
    parts, range_ = 0, 1 << 30
    for length, total in ((r.length, r.n) for r in sizes):
        own = 1 << max(0, int(math.log2(max(1, min(settings.parts, total / settings.part_rows)))))
        router = None
        if own > 1 and len(places) < settings.routed:
            share = range_ if total <= settings.sample else math.ceil(range_ * settings.sample / total)
            taken = base.filter((F.col("length") == length) & (F.pmod(F.xxhash64("vec_id"), F.lit(range_)) < share))
            taken = taken.select("vec_id", "vector").toArrow().sort_by("vec_id")
            sample = taken["vector"].combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, length)
            router = fit(scaled(sample), own, k, settings) if len(sample) else None
        own = len(router.second_bias) if router else 1
        places[length] = Place(parts, own, router)
        parts += own

    def routed(vectors: pd.Series, choose) -> list:
        """`choose` gives one value per vector from a place and the logits of its router."""
        out: list = [None] * len(vectors)
        lengths = vectors.map(len)
        for length in lengths.unique().tolist():
            at, place = np.flatnonzero(lengths == length), places[length]
            x = [vectors.iloc[i] for i in at]
            logits = place.router.logits(_units(x)) if place.router else np.zeros((len(x), 1))
            for i, value in zip(at, choose(place, logits)):
                out[i] = value
        return out

    @F.pandas_udf("int")
    def part_of(vectors: pd.Series) -> pd.Series:
        return pd.Series(routed(vectors, lambda place, logits: place.first + logits.argmax(axis=1)), dtype="int32")

    index = stage(base.withColumn("part", part_of("vector")), "index")
    held = np.zeros(parts, dtype=np.int64)
    for row in index.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect():  # a row per partition
        held[row.part] = row.n

    @F.pandas_udf("array<int>")
    def probed(vectors: pd.Series) -> pd.Series:
        def likeliest(place: Place, logits: np.ndarray) -> list:
            order = place.first + np.argsort(-logits, axis=1, kind="stable")
            enough = (np.cumsum(held[order], axis=1) <= k).sum(axis=1) + 1  # the query itself may be among them
            least = place.router.probes if place.router else 1
            return [o[: max(least, n)].astype("int32") for o, n in zip(order, enough)]

        return pd.Series(routed(vectors, likeliest), dtype=object)

    asked = index.filter("asked")
    asked = asked.select(F.col("vec_id").alias("query_id"), F.col("row").alias("query"), "vector", F.explode(probed("vector")).alias("part"))
    asked = stage(asked, "asked")
    waiting = np.zeros(parts, dtype=np.int64)
    for row in asked.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect():
        waiting[row.part] = row.n
    row_blocks = np.maximum(1, -(-held // settings.block_rows))
    query_blocks = -(-waiting // settings.block_queries)
    of_part = lambda values: F.get(F.array(*[F.lit(int(v)) for v in values]), F.col("part"))
    every = lambda values: F.explode(F.sequence(F.lit(0), of_part(values) - 1))
    block = lambda name, values: F.pmod(F.xxhash64(name), of_part(values)).cast("int")
    searched = index.filter(of_part(query_blocks) > 0).withColumn("rows", block("row", row_blocks))
    searched = searched.withColumn("queries", every(query_blocks))
    asked = asked.withColumn("queries", block("query", query_blocks)).withColumn("rows", every(row_blocks))

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, own = left["vec_id"].to_numpy(), left["row"].to_numpy()
            x = scaled(np.stack(left["vector"].to_list()).astype(np.float64))
            x_norm = np.sqrt((x * x).sum(axis=1))
            for a in range(0, len(right), 64):
                some = right.iloc[a : a + 64]
                y = scaled(np.stack(some["vector"].to_list()).astype(np.float64))
                y_norm = np.sqrt((y * y).sum(axis=1))
                scores = (y @ x.T) / y_norm[:, None] / x_norm[None, :]
                for q, row, v, n, s in zip(some["query_id"].to_numpy(), some["query"].to_numpy(), y, y_norm, scores):
                    s[own == row] = -np.inf
                    found, score = _top(s, ids, lambda near, v=v, n=n: (x[near] * v).sum(axis=1) / (x_norm[near] * n), k)
                    out += [(int(q), int(row), int(i), float(c)) for i, c in zip(found, score)]
        return pd.DataFrame(out, columns=["query_id", "query", "vec_id", "score"])

    cell = ["part", "rows", "queries"]
    found = searched.groupBy(*cell).cogroup(asked.groupBy(*cell)).applyInPandas(best, "query_id bigint, query bigint, vec_id bigint, score double")
    in_order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(in_order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op1(embeddings: DataFrame) -> DataFrame:
    return search(embeddings, F.col("vec_id") % 50 == 0)
