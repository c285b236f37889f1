"""Bounded samples of labelled documents, and which rows labels may be learned from."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTS = 1 << 30


def held_out(folds: int, fold: int, doc_id: str = "doc_id") -> Column:
    """Whether the checksum of doc_id as text, modulo the folds, is the held-out one. Null ids are held out."""
    place = F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds
    return F.coalesce(place == fold, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, column: str, folds: int, fold: int, most: int) -> DataFrame:
    """About `most` labelled rows that are not held out, as (doc_id, text, label), at random by a digest of doc_id.

    Fewer labelled rows are all taken. Several labels of one document: the smallest counts. Null labels are none.
    The sample of ids is bounded by `most`, so it is broadcast and the texts are never shuffled.
    """
    known = labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(folds, fold))
    known = known.groupBy(F.col("doc_id").alias("__id")).agg(F.min(column).cast("int").alias("label"))
    total = known.count()
    part = _PARTS if total <= most else math.ceil(_PARTS * most / total)
    chosen = known.filter(F.pmod(F.xxhash64("__id"), F.lit(_PARTS)) < part)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "label")
