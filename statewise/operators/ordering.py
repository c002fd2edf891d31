"""Global positions and ranks without passing the rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statewise.operators.lookup import join_lookup
from statewise.workspace import settle

_LOCAL = 2**33  # monotonically_increasing_id counts partitions in units of this


def _in_order(df: DataFrame, order: Sequence) -> DataFrame:
    """``df`` range-sorted and written, with partition number and place therein."""
    ordered = settle(
        df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered"
    )
    return ordered.withColumns(
        {"_part": F.floor(F.col("_at") / _LOCAL), "_at": F.col("_at") % _LOCAL}
    )


def _offsets(ordered: DataFrame, size) -> DataFrame:
    """Total of ``size`` in all earlier partitions: one row per partition."""
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return (
        ordered.groupBy("_part")
        .agg(size.alias("_size"))
        .select(
            "_part",
            F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
        )
    )


def number_rows(
    df: DataFrame, order: Sequence, name: str, after: int = 0
) -> DataFrame:
    """Consecutive numbers from ``after`` + 1 on, in the given total order."""
    ordered = _in_order(df, order)
    # One row per sort partition, so its size is that of the task list.
    offsets = F.broadcast(_offsets(ordered, F.count("*")))
    number = (F.col("_offset") + F.col("_at") + 1 + after).cast("bigint")
    return ordered.join(offsets, "_part").select(number.alias(name), *df.columns)


def rows_below(df: DataFrame, value: str, name: str = "below") -> DataFrame:
    """Each distinct ``value`` with the number of rows holding a smaller one.

    Rows are counted per value before anything is sorted, so a value shared by
    a third of the rows is one row here.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).count()
    ordered = _in_order(counts, [value])
    offsets = F.broadcast(_offsets(ordered, F.sum("count")))
    before = W.partitionBy("_part").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    below = F.coalesce(F.sum("count").over(before), F.lit(0)) + F.col("_offset")
    return ordered.join(offsets, "_part").select(value, below.cast("bigint").alias(name))


def percent_ranks(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """Add ``<value>_rank``, the percent rank (0 to 1) of each value column.

    Ranks come from sorted counts of the distinct values, at any size. NULL
    values get a NULL rank and do not count.
    """
    df = settle(df, "ranked")  # read once per value below
    totals = df.agg(*[F.count(value).alias(value) for value in values]).first()
    for value in values:
        step = max(1, totals[value] - 1)
        ranks = settle(
            rows_below(df, value).select(
                value, (F.col("below") / F.lit(step)).alias(f"{value}_rank")
            ),
            "ranks",
        )
        df = join_lookup(df, ranks, [value], how="left")
    return df
