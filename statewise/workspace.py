"""Shared working folder: where intermediate results are written.

Everything that must survive a lost executor goes to the folder the cluster
names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

_open_scratch: list[list[str]] = []


def work_root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that all executors share"
            )
        context.setCheckpointDir(tempfile.mkdtemp(prefix="statewise-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Cuts the lineage, so that several readers share one computation, and gives
    the planner a true byte size: a small table is then broadcast by the normal
    threshold and a large one is not.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    for folders in _open_scratch[-1:]:
        folders.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what is settled inside the block when it ends.

    Nothing that reads a settled table may leave the block; write the result
    first.
    """
    folders: list[str] = []
    _open_scratch.append(folders)
    try:
        yield
    finally:
        _open_scratch.remove(folders)
        for path in folders:
            discard(spark, path)


def settle_result(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Settle what ``make`` gives, and delete what it settled on the way."""
    path = new_folder(spark, label)
    with scratch(spark):
        made = make()
        made.write.parquet(path)
    for folders in _open_scratch[-1:]:
        folders.append(path)
    return spark.read.schema(made.schema).parquet(path)


def _located(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    location, files = _located(spark, path)
    return files.exists(location)


def folder_is_complete(spark: SparkSession, path: str) -> bool:
    """True when a batch write to ``path`` has been committed."""
    return folder_exists(spark, f"{path}/_SUCCESS")


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder that nothing will read again."""
    location, files = _located(spark, path)
    files.delete(location, True)
