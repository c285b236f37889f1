"""Connected components of links between any sortable keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.staging import stage
from .spread import most_rows, spread_join


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s


def components(links: DataFrame) -> DataFrame:
    """The smallest key reachable from every linked key: (node, root), from links (a, b).

    Alternates large-star and small-star steps until the links no longer change. A node with any number of links is a
    count and a join in which its links are dealt out to tasks; every round is written to the shared folder.
    """
    both = F.least("a", "b"), F.greatest("a", "b")
    edges = stage(links.filter("a <> b").select(both[1].alias("a"), both[0].alias("b")).distinct(), "edges")  # a > b
    mark = _mark(edges)
    while mark[0]:
        most = most_rows(2 * mark[0])
        either = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = either.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count(F.lit(1)).alias("__n"))
        large = spread_join(either, least, "a", "b", most).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()  # a > b still
        lowest = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("__n"))
        small = spread_join(large, lowest, "a", "b", most).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.filter("a <> b").unionByName(lowest.select("a", F.col("m").alias("b")))
        edges = stage(small.distinct(), "small")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
