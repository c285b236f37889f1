"""Written intermediate results in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_folders: set[str] = set()
_scratch: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a temporary one only for a session on this machine alone."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="starloom-")
    return _local_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path that no other call gets, in a folder that is deleted when the application ends."""
    folder = f"{shared_dir(spark)}/starloom/{spark.sparkContext.applicationId}"
    if folder not in _folders:
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = target.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(target)
        system.deleteOnExit(target)
        _folders.add(folder)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write the rows once and read them back: cuts lineage, survives lost executors, and gives later steps fixed rows."""
    spark = df.sparkSession
    path = new_path(spark, label)
    staged = _scratch.get()
    if staged is not None:
        staged.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder, with those above it, unless it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one step: it is there as a whole or not at all."""
    jvm = spark._jvm
    folder, name = path.rsplit("/", 1)
    target, aside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{folder}/_{name}")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(aside, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not system.rename(aside, target):
        raise OSError(f"{path} could not be written")


def read_texts(spark: SparkSession, folder: str) -> dict[str, str]:
    """The small files of a folder by path, hidden ones left out; read by the driver, without a job."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(folder)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, str] = {}
    for status in system.listStatus(target) if system.exists(target) else ():
        if status.isFile() and status.getPath().getName()[0] not in "_.":
            stream = system.open(status.getPath())
            try:
                found[status.getPath().toString()] = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
    return found


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch() -> Iterator[None]:
    """Delete what is staged inside once it is left. For runs whose results are all written as tables by then."""
    staged: list[tuple[SparkSession, str]] = []
    token = _scratch.set(staged)
    try:
        yield
    finally:
        _scratch.reset(token)
        for spark, path in staged:
            delete_path(spark, path)
