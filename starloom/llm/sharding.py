"""Shards on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.staging import stage
from .ranks import positions

SHARDS = 24
VIRTUAL_NODES = 64
_CUTS = "arc int, __lo bigint, __hi bigint, shard int, __slot bigint"


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> tuple[np.ndarray, np.ndarray]:
    """Places of the virtual nodes on a ring of 2**32, ascending, and the shard of each. Places depend on names alone."""
    nodes = sorted(
        (int(hashlib.md5(f"shard-{s}:{v}".encode()).hexdigest()[:8], 16), s) for s in range(shards) for v in range(virtual_nodes)
    )
    return np.array([p for p, _ in nodes], dtype=np.int64), np.array([s for _, s in nodes], dtype=np.int64)


def capacities(total: int, shards: int) -> list[int]:
    """Rows each shard may hold: all of them together hold exactly the total, and no two differ by more than one."""
    return [total // shards + (s < total % shards) for s in range(shards)]


def plan(loads: Sequence[int], owners: Sequence[int], limits: Sequence[int]) -> list[tuple[int, int, int, int, int]]:
    """Cut the line of keys of every arc among shards: (arc, from, to, shard, slot of the first).

    Every arc first fills its owner, in ring order. What overflows goes on clockwise, one arc at a time for all arcs at
    once, and stays with the first shard that has room. `loads` has one number per virtual node, so this is small.
    """
    left = list(limits)
    filled = [0] * len(limits)
    done = [0] * len(loads)
    cuts = []
    waiting = [a for a, n in enumerate(loads) if n]
    for step in range(len(loads)):
        if not waiting:
            break
        for arc in waiting:
            shard = int(owners[(arc + step) % len(loads)])
            taken = min(left[shard], loads[arc] - done[arc])
            if taken:
                cuts.append((arc, done[arc], done[arc] + taken, shard, filled[shard]))
                left[shard] -= taken
                filled[shard] += taken
                done[arc] += taken
        waiting = [a for a in waiting if done[a] < loads[a]]
    return cuts


def assign(rows: DataFrame, shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """Add shard and slot to rows that have doc_id and place (a number below 2**32; equal places lie together on the ring).

    A key belongs to the next virtual node clockwise. Shards hold equal counts, at most one apart: the keys of an arc lie
    in a line by a digest of doc_id, a full shard takes no more of them, and the rest continue clockwise. Slots count each
    shard's rows from 0 without gaps. Repeated rows are rows of their own; a null doc_id counts as empty text. `rows` is
    read three times: stage what is costly to compute.
    """
    points, owners = ring(shards, virtual_nodes)

    @F.pandas_udf("int")
    def arc_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(points, place.to_numpy(), side="left") % len(points)).astype("int32")

    spark = rows.sparkSession
    kept = [f"`{c}`" for c in rows.columns]
    rows = stage(rows.withColumn("arc", arc_of("place")), "arcs")
    loads = [0] * len(points)
    for row in rows.groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect():  # one row per virtual node
        loads[row.arc] = row.n
    cuts = spark.createDataFrame(plan(loads, owners, capacities(sum(loads), shards)), _CUTS)
    placed = positions(rows, ["arc"], [], ["doc_id"], "__at")
    on = (placed.arc == cuts.arc) & (F.col("__at") >= F.col("__lo")) & (F.col("__at") < F.col("__hi"))
    found = placed.join(F.broadcast(cuts), on)  # at most shards x virtual nodes x shards rows, whatever the data
    return found.select(*kept, "shard", (F.col("__slot") + F.col("__at") - F.col("__lo")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """Shard documents: doc_id, size, text_crc32, shard, slot.

    The place on the ring is a digest of the text, so equal texts share a place and stay together until a shard is full.
    A null text counts as empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint").alias("place"),
    )
    return assign(slim, shards, virtual_nodes).drop("place")


def op7(docs: DataFrame) -> DataFrame:
    sharded = shard_documents(docs)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
