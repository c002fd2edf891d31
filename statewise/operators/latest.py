"""Key uniqueness: finding repeated keys and keeping the latest row of each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one that is last in ``order``, a total order.

    An aggregate, not a window: each task first reduces its own rows to one per
    key, so a hot key costs no more in the shuffle than a rare one.
    """
    rest = [name for name in df.columns if name not in keys]
    latest = F.max_by(F.struct(*rest), F.struct(*order)).alias("latest")
    return df.groupBy(*keys).agg(latest).select(*keys, "latest.*").select(*df.columns)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )
