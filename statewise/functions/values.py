"""Scaled figures and series identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statewise import schemas


def people_from_thousands(text: Column, whole_thousands: bool = False) -> Column:
    """Figure quoted in thousands -> people; unreadable text -> NULL.

    ``whole_thousands`` rounds half up to a thousand first (``1970.6`` ->
    1971000), for parity with figures published that way.
    """
    kind = "decimal(10,0)" if whole_thousands else "decimal(18,3)"
    return (text.try_cast(kind) * 1000).cast("bigint")


def series_id(state_code: Column) -> Column:
    """Identifier of a state's total employment series."""
    return F.concat(
        F.lit(schemas.SERIES_SURVEY + schemas.SERIES_ADJUSTMENT),
        state_code,
        F.lit(schemas.SERIES_AREA + schemas.SERIES_INDUSTRY + schemas.SERIES_DATA_TYPE),
    )


def series_state_code(identifier: Column) -> Column:
    """Two-digit state code held in a series identifier."""
    return F.substring(identifier, 4, 2)


def first_result_state(answer: Column) -> Column:
    """State in a geocoder's JSON answer; NULL when absent or unreadable."""
    return F.get_json_object(answer, "$.results[0].components.state")
