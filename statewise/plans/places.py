"""Places: raw city list -> city dimension."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewise import schemas


def excluding(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Rows whose ``column`` is not in a list; a NULL is not *not in* it."""
    return df.where(~F.col(column).isin(*values))


def clean_places(
    raw: DataFrame, not_states: Iterable[str] = schemas.NOT_STATES
) -> DataFrame:
    """Distinct places of the states, typed, without surrogate key.

    A row with no state name is dropped: NULL is never *not in* a list.
    """
    return (
        excluding(raw, "state_name", not_states)
        .select(
            F.col("city_ascii").alias("city"),
            F.col("state_name").alias("state"),
            F.col("state_id").alias("state_code"),
            F.lit(schemas.HOME_COUNTRY).alias("country"),
            F.col("lat").try_cast("double").alias("latitude"),
            F.col("lng").try_cast("double").alias("longitude"),
            # Via double, so that "1000.0" and "1000" are the same count.
            F.col("population").try_cast("double").try_cast("int").alias("population"),
            F.col("density").try_cast("double").alias("density"),
        )
        .distinct()
    )
