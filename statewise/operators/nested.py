"""Flattening of the nested employment documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewise.sources.files import UNREADABLE


def flatten_series(documents: DataFrame, *keep: str) -> DataFrame:
    """One row per figure: (*keep, state, year, period, value).

    Series without figures and documents without series give no rows. A document
    whose text could not be read gives one row of NULLs when ``keep`` holds the
    column of its text. The generators run inside the scan stage; nothing is
    shuffled.
    """
    unread = F.col(UNREADABLE).isNotNull() if UNREADABLE in keep else F.lit(False)
    series = documents.select(
        *keep, F.posexplode_outer("Results.series").alias("series_at", "series")
    ).where(F.col("series_at").isNotNull() | unread)
    figures = series.select(
        *keep,
        F.col("series.catalog.area").alias("state"),
        F.posexplode_outer("series.data").alias("figure_at", "figure"),
    ).where(F.col("figure_at").isNotNull() | unread)
    return figures.select(*keep, "state", "figure.year", "figure.period", "figure.value")
