"""Weather: city temperature history -> temperatures with their state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewise import schemas
from statewise.functions.coordinates import hemisphere_degrees, rounded
from statewise.functions.periods import parsed_date
from statewise.operators.lookup import enrich_by_key
from statewise.operators.nearest import nearest_place

COORDINATES = ("latitude", "longitude")
WHERE = (*COORDINATES, "km")  # what tells why a row found no state


def clean_weather(raw: DataFrame, country: str = schemas.WEATHER_COUNTRY) -> DataFrame:
    """Measured temperatures of one country, parsed, still by coordinates."""
    measured = raw.where(
        (F.col("Country") == country) & F.col("AverageTemperature").isNotNull()
    )
    return measured.select(
        rounded(F.col("AverageTemperature")).alias("avg_temp"),
        rounded(F.col("AverageTemperatureUncertainty")).alias("avg_temp_uncertainty"),
        F.col("City").alias("city"),
        hemisphere_degrees(F.col("Latitude")).alias("latitude"),
        hemisphere_degrees(F.col("Longitude")).alias("longitude"),
        parsed_date(F.col("dt")).alias("date"),
    )


def state_of_coordinates(
    coordinates: DataFrame, cities: DataFrame, farthest_km: float | None = None
) -> DataFrame:
    """State of the city nearest to each coordinate, and its distance ``km``.

    The state is that of the nearest city at any distance, or NULL beyond
    ``farthest_km`` where that is given. The nearest city may lie across a state
    border; a limit keeps doubtful rows out at the price of more rejects.
    """
    near = nearest_place(coordinates, cities, "city_id", carry=["state"])
    state = F.col("state")
    if farthest_km is not None:
        state = F.when(F.col("km") <= farthest_km, state)
    return near.select(*COORDINATES, state.alias("state"), "km")


def weather_with_state(
    cleaned: DataFrame,
    cities: DataFrame,
    stored: DataFrame | None = None,
    farthest_km: float | None = None,
) -> DataFrame:
    """Cleaned rows with their state and the distance of the city that gave it.

    Each distinct coordinate is looked up once; with ``stored``, only those not
    looked up before. A row whose coordinate finds no state keeps NULL, for the
    quality gate to reject.
    """
    return enrich_by_key(
        cleaned,
        COORDINATES,
        lambda coordinates: state_of_coordinates(coordinates, cities, farthest_km),
        stored,
        how="left",
    )
