"""Schemas and fixed values of the three datasets and their star schema.

Raw CSV stays text until a transform parses it; the nested JSON schema names
only the fields that are read, so the scan never materialises the rest.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
HOME_COUNTRY = "United States of America"
WEATHER_COUNTRY = "United States"
NOT_STATES = ("Puerto Rico", "District of Columbia")
ANNUAL_PERIOD = "M13"
SERIES_SURVEY = "SM"
SERIES_ADJUSTMENT = "U"
SERIES_AREA = "00000"
SERIES_INDUSTRY = "00000000"
SERIES_DATA_TYPE = "01"
STATE_CODES = (
    "01", "02", "04", "05", "06", "08", "09", "10", "12", "13",
    "15", "16", "17", "18", "19", "20", "21", "22", "23", "24",
    "25", "26", "27", "28", "29", "30", "31", "32", "33", "34",
    "35", "36", "37", "38", "39", "40", "41", "42", "44", "45",
    "46", "47", "48", "49", "50", "51", "53", "54", "55", "56",
)
# ----------------------------------------------------------------------------


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


RAW_PLACES = _text(
    "city_ascii", "state_name", "state_id", "lat", "lng", "population", "density"
)

RAW_WEATHER = _text(
    "dt",
    "AverageTemperature",
    "AverageTemperatureUncertainty",
    "City",
    "Country",
    "Latitude",
    "Longitude",
)

_SERIES = T.StructType(
    [
        T.StructField("catalog", _text("area")),
        T.StructField("data", T.ArrayType(_text("year", "period", "value"))),
    ]
)

EMPLOYMENT_DOCUMENT = T.StructType().add(
    "Results", T.StructType().add("series", T.ArrayType(_SERIES))
)

DIM_CITIES = T.StructType(
    [
        T.StructField("city_id", T.LongType(), False),
        T.StructField("city", T.StringType(), False),
        T.StructField("state", T.StringType(), False),
        T.StructField("state_code", T.StringType(), False),
        T.StructField("country", T.StringType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
        T.StructField("population", T.IntegerType(), False),
        T.StructField("density", T.DoubleType(), True),
    ]
)

FACT_WEATHER = T.StructType(
    [
        T.StructField("avg_temp", T.DoubleType(), False),
        T.StructField("avg_temp_uncertainty", T.DoubleType(), True),
        T.StructField("city", T.StringType(), False),
        T.StructField("state", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
    ]
)

FACT_EMPLOYMENT = T.StructType(
    [
        T.StructField("people_employed", T.LongType(), True),
        T.StructField("state", T.StringType(), False),
        T.StructField("year", T.IntegerType(), False),
        T.StructField("month", T.IntegerType(), False),
    ]
)

KEYS = {
    "dim_cities": ("city_id",),
    "fact_weather": ("date", "state", "city"),
    "fact_employment": ("state", "year", "month"),
}

# Column order of the processed files, which is not the order of the tables.
LOAD_ORDER = {
    "dim_cities": (
        "city",
        "state",
        "state_code",
        "country",
        "latitude",
        "longitude",
        "population",
        "density",
    ),
    "fact_weather": ("avg_temp", "avg_temp_uncertainty", "city", "date", "state"),
    "fact_employment": ("state", "year", "month", "people_employed"),
}

TABLES = {
    "dim_cities": DIM_CITIES,
    "fact_weather": FACT_WEATHER,
    "fact_employment": FACT_EMPLOYMENT,
}


def required_columns(table: str) -> list[str]:
    """Columns of a table that must not be NULL, the generated key aside."""
    return [
        field.name
        for field in TABLES[table].fields
        if not field.nullable and field.name in LOAD_ORDER[table]
    ]
