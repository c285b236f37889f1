"""A training-data pipeline over `documents`: classify, dedup lines, dedup documents, mix sources, pack sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import linededup, mixing, neardup, packing, quality
from starloom.llm.spread import most_rows, spread_join
from starloom.operators.staging import stage
from starloom.session import tune

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of these documents, does not reject.

    Null and empty texts are scored like others, as texts without features. Rows that repeat an id are scored each; a null id has no
    label, and is scored too.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classify(docs, labels).filter(F.col("score") >= quality.THRESHOLD).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks that an earlier one has; n_chars follows the text.

    A document that loses all of its words goes. One that had none to begin with stays, null or empty. Rows without doc_id have no
    place in the order and stay as they are; rows that repeat id and text are one document and lose the same.
    """
    left = linededup.dedup(docs)
    changed = F.col("n_lines_removed") > 0
    left = left.filter(~changed | F.col("text").rlike(mixing.WORD))
    length = F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", length).select(*COLUMNS)


PERCENT = 80  # near-duplicates of the pipeline; op3 links at 85 as its contract says


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are 80% alike or more, directly or over others: the one with the smallest doc_id, and
    of several texts of that id the one with the least digest. Rows without doc_id stay; a row that is repeated as a whole is
    one document, and stays as often."""
    found = neardup.near_duplicates(docs, neardup.Settings(percent=PERCENT)).filter("doc_id is not null and group is not null")
    found = found.select("group", F.struct("doc_id", "digest").alias("row")).distinct()
    kept = found.groupBy("group").agg(F.min("row").alias("kept"), F.max("row").alias("last"), F.count(F.lit(1)).alias("__n"))
    most = most_rows(docs.count())
    gone = spread_join(found, kept.filter("kept < last").drop("last"), "group", "row", most).filter("row <> kept")
    gone = gone.select(F.col("row.doc_id").alias("__id"), F.col("row.digest").alias("__digest"))
    same = (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__digest"))
    return docs.join(gone, same, "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once, or up to three times. Null and empty texts are taken like
    others, and add no words; a null source is a source. Repeated rows are documents of their own."""
    return mixing.emit(mixing.mix(docs.withColumn("size", mixing.word_count())), COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences and their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null and empty texts are one
    token, the end of a document. Repeated rows, as the mix makes them, and rows without doc_id are packed each."""
    return packing.op10(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

# A trained model and the ids of a tokenizer are beyond SQL; tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet before the next reads it."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage_of in STAGES:
        docs = stage(stage_of(spark, docs, sf_dir), name)
    return docs
