"""The operators' queries over the given tables, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune
from . import cleaning, dialogue, linededup, mixing, neardup, neighbours, packing, quality, secrets, sharding, spelling, substrings, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _over(operator: Callable[..., DataFrame], *tables: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(*[tune(spark).read.parquet(f"{sf_dir}/{t}.parquet") for t in tables])

    return run


QUERIES: dict[str, Query] = {
    "op1_learned_partitions": _over(neighbours.op1, "embeddings"),
    "op2_layers": _over(secrets.op2, "documents"),
    "op3_setsketch": _over(neardup.op3, "documents"),
    "op4_mix": _over(mixing.op4, "documents"),
    "op5_patience_lines": _over(linededup.op5, "documents"),
    "op6_line_first": _over(cleaning.op6, "documents"),
    "op7_bounded_ring": _over(sharding.op7, "documents"),
    "op8_crf": _over(toxicity.op8, "documents", "labels"),
    "op9_subword": _over(quality.op9, "documents", "labels"),
    "op10_best_fit": _over(packing.op10, "documents"),
    "op11_reduced_alphabet": _over(spelling.op11, "documents"),
    "op12_relative_lz": _over(substrings.op12, "documents"),
    "op13_weighted_cyk": _over(dialogue.op13, "conversations"),
}

ORACLES: dict[str, str] = {
    "op4_mix": mixing.OP4_SQL,
    "op11_reduced_alphabet": spelling.OP11_SQL,
    "op12_relative_lz": substrings.OP12_SQL,
}
