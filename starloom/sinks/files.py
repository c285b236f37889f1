"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.rows import split_batches


def write_json_batches(df: DataFrame, path: str, n: int, key: str, name: str = "interval", dense: bool = False) -> None:
    """Write the rows as JSON lines in folders `interval=1..n`, batches taken along the unique column `key`.

    Tasks write in parallel: a folder has as many files as tasks held rows of its batch. `dense` as in `split_batches`.
    """
    split_batches(df, n, key, name, dense).write.mode("overwrite").partitionBy(name).json(path)


def write_csv(df: DataFrame, path: str, **options) -> None:
    """CSV files with a header; blanks around a text are kept. `options` are Spark's."""
    kept = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**{**kept, **options}).csv(path)
