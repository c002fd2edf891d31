"""Upsert into a partitioned Parquet folder: latest row per key wins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewise.operators.latest import latest_by_key
from statewise.sinks.files import clustered, no_empty_partition, replace_partitions
from statewise.workspace import discard, folder_exists, folder_is_complete, new_folder


@dataclass(frozen=True)
class KeyedStore:
    """A Parquet folder with at most one row per key.

    ``partition_by`` must be part of ``keys``, so that a row never moves to
    another partition. ``order`` decides which row of a key is the latest.
    """

    path: str
    schema: T.StructType
    keys: Sequence[str]
    order: Sequence[str]
    partition_by: Sequence[str]

    def __post_init__(self) -> None:
        astray = set(self.partition_by) - set(self.keys)
        if astray:
            raise ValueError(f"partition column {sorted(astray)} is not part of the key")

    def read(self, spark: SparkSession) -> DataFrame:
        if not folder_exists(spark, self.path):
            return spark.createDataFrame([], self.schema)
        stored = spark.read.schema(self.schema).parquet(self.path)
        return stored.select(*self.schema.fieldNames())


def _touched(stored: DataFrame, changes: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Stored rows of the partitions that ``changes`` has rows for, NULL ones too.

    The partitions become a partition filter of the scan. Their list is as
    long as that of the folders which the planner lists for the write.
    """
    listed = changes.select(*partition_by).distinct().collect()
    matches = [
        reduce(
            lambda a, b: a & b,
            [F.col(name).eqNullSafe(F.lit(row[name])) for name in partition_by],
        )
        for row in listed
    ]
    while len(matches) > 1:  # in pairs, so that the condition stays shallow
        pairs = zip(matches[::2], matches[1::2])
        odd = matches[-1:] if len(matches) % 2 else []
        matches = [a | b for a, b in pairs] + odd
    return stored.where(matches[0] if matches else F.lit(False))


def upsert(store: KeyedStore, changes: DataFrame, stage: str | None = None) -> None:
    """Bring ``changes`` into the store.

    The merged partitions are first written to ``stage`` and then replace the
    stored ones. Give the same ``stage`` when repeating an attempt: if the
    earlier one had finished staging, its rows are published again and nothing
    is lost, even if it died half-way through the replacement.
    """
    spark = changes.sparkSession
    partition_by = list(store.partition_by)
    repeatable = stage is not None
    stage = stage or new_folder(spark, "stage")
    if not folder_is_complete(spark, stage):
        rows = changes = changes.select(*store.schema.fieldNames())
        if folder_exists(spark, store.path):
            stored = _touched(store.read(spark), changes, partition_by)
            rows = stored.unionByName(changes)
        merged = latest_by_key(rows, store.keys, store.order)
        merged = no_empty_partition(merged, partition_by)
        clustered(merged, partition_by).write.mode("overwrite").partitionBy(
            *partition_by
        ).parquet(stage)
    staged = spark.read.schema(store.schema).parquet(stage)
    replace_partitions(staged, store.path, partition_by, is_clustered=True)
    if not repeatable:
        discard(spark, stage)
