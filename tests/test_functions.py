from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from statewise import schemas
from statewise.functions import coordinates, periods, values


def one(spark, text, function):
    frame = spark.createDataFrame([(text,)], "t string")
    return frame.select(function(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "text, degrees",
    [
        ("40.99N", 40.99),
        ("74.56W", -74.56),
        ("5.63S", -5.63),
        ("10.0E", 10.0),
        ("10.0x", -10.0),
        ("N", None),
        ("", None),
        (None, None),
        ("abcN", None),
    ],
)
def test_hemisphere(spark, text, degrees):
    assert one(spark, text, coordinates.hemisphere_degrees) == degrees


@pytest.mark.parametrize(
    "text, number",
    [("3.14159", 3.142), ("1.0005", 1.001), ("-2.0006", -2.001), ("", None), ("x", None), (None, None)],
)
def test_rounded(spark, text, number):
    assert one(spark, text, coordinates.rounded) == number


@pytest.mark.parametrize(
    "code, month", [("M01", 1), ("M12", 12), ("M13", 13), ("S1", 1), ("M", None), (None, None)]
)
def test_month_of_period(spark, code, month):
    assert one(spark, code, periods.month_of_period) == month


@pytest.mark.parametrize(
    "text, exact, whole",
    [
        ("1970.6", 1970600, 1971000),
        ("12.5", 12500, 13000),
        ("12.4", 12400, 12000),
        ("-", None, None),
        (None, None, None),
    ],
)
def test_people(spark, text, exact, whole):
    assert one(spark, text, values.people_from_thousands) == exact
    assert one(spark, text, lambda c: values.people_from_thousands(c, True)) == whole


@pytest.mark.parametrize(
    "answer, state",
    [
        ('{"results":[{"components":{"state":"Ohio"}},{"components":{"state":"Iowa"}}]}', "Ohio"),
        ('{"results":[]}', None),
        ('{"results":[{"components":{}}]}', None),
        ('{"results"', None),
        ("", None),
        (None, None),
    ],
)
def test_first_result_state(spark, answer, state):
    assert one(spark, answer, values.first_result_state) == state


def test_coordinate_key(spark):
    frame = spark.createDataFrame([(40.5, -74.25), (1.0, None)], "a double, b double")
    keys = [r[0] for r in frame.select(coordinates.coordinate_key(F.col("a"), F.col("b"))).collect()]
    assert keys == ["40.5,-74.25", None]


def test_series_ids(spark):
    assert len(schemas.STATE_CODES) == len(set(schemas.STATE_CODES)) == 50
    assert one(spark, "06", values.series_id) == "SMU06000000000000001"
    assert one(spark, "SMU06000000000000001", values.series_state_code) == "06"


def test_great_circle(spark):
    quarter = spark.range(1).select(
        coordinates.great_circle_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))
    )
    assert quarter.first()[0] == pytest.approx(10007.557, abs=0.01)
