"""File sinks: every task writes its own part, nothing goes through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header in each part, replacing what was at ``path``."""
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def no_empty_partition(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """``df``, failing the write when a partition column holds an empty text: a
    folder cannot tell it from NULL."""
    texts = [name for name in partition_by if isinstance(df.schema[name].dataType, T.StringType)]
    return df.withColumns(
        {
            name: F.when(
                F.col(name) == "", F.raise_error(F.lit(f"empty text in partition column {name}"))
            ).otherwise(F.col(name))
            for name in texts
        }
    )


def clustered(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> DataFrame:
    """Rows of one partition value brought together before a partitioned write.

    A rebalance, not a repartition: a value holding a third of the rows is
    split over several tasks, and small values share one.
    """
    df = df.hint("rebalance", *partition_by)
    return df.sortWithinPartitions(*partition_by, *sort_by) if sort_by else df


def write_partitioned(
    df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()
) -> None:
    """Partitioned Parquet, replacing the whole of ``path``.

    Sorting by ``sort_by`` keeps the value range of each row group narrow, so
    range filters skip most of them.
    """
    (
        clustered(no_empty_partition(df, partition_by), partition_by, sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], is_clustered: bool = False
) -> None:
    """Replace exactly the partitions that ``df`` has rows for; keep the others.

    Running it again with the same rows changes nothing. ``df`` must not read
    from ``path``. Rows that come clustered are not shuffled again.
    """
    (
        (df if is_clustered else clustered(no_empty_partition(df, partition_by), partition_by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
