"""The three datasets from raw files to tables, on small invented files."""

from __future__ import annotations

import datetime
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from statewise import schemas
from statewise.operators.quality import REASON, QualityError, measure, null_checks, require
from statewise.plans.employment import clean_employment, wanted_series
from statewise.plans.indicator import (
    Indicator,
    cities_indicator,
    employment_indicator,
    load,
    prepare,
    weather_indicator,
)
from statewise.plans.places import clean_places
from statewise.plans.star import one_place_per_name, place_profiles, rank_places
from statewise.plans.weather import clean_weather, state_of_coordinates, weather_with_state
from statewise.sources.files import read_documents, read_header_csv
from statewise.workspace import scratch, settle, settle_result, work_root

PLACES = """\
id,city_ascii,state_name,state_id,lat,lng,population,density
1,Alpha,Texas,TX,31.0,-97.5,1000,12.5
1,Alpha,Texas,TX,31.0,-97.5,1000,12.5
2,Alpha,Texas,TX,31.5,-97.0,2000,
3,Beta,Puerto Rico,PR,18.2,-66.4,500,8
4,Cap,District of Columbia,DC,38.9,-77.0,600,9
5,Gamma,,,40.0,-80.0,10,1
6,,Ohio,OH,40.1,-82.9,70,
7,Delta,Ohio,OH,here,-82.9,70.0,1
8,Echo,Ohio,OH,40.0,-83.0,70.0,1
"""


@pytest.fixture
def raw_places(spark, tmp_path):
    (tmp_path / "places.csv").write_text(PLACES)
    return read_header_csv(spark, str(tmp_path / "places.csv"), schemas.RAW_PLACES.fieldNames())


def test_places(spark, tmp_path, raw_places):
    loaded = load(cities_indicator(), raw_places, str(tmp_path / "warehouse"))
    stored = spark.read.parquet(str(tmp_path / "warehouse" / "dim_cities"))
    usa = "United States of America"
    assert rows(stored.select(*schemas.DIM_CITIES.fieldNames())) == [
        (1, "Echo", "Ohio", "OH", usa, 40.0, -83.0, 70, 1.0),
        (2, "Alpha", "Texas", "TX", usa, 31.0, -97.5, 1000, 12.5),
        (3, "Alpha", "Texas", "TX", usa, 31.5, -97.0, 2000, None),
    ]
    rejects = spark.read.parquet(str(tmp_path / "warehouse" / "dim_cities_rejects"))
    assert rows(rejects.select("city", REASON)) == [
        ("Delta", "latitude is null"),
        (None, "city is null"),
    ]
    require(loaded.report)
    report = {r.check_name: r.actual for r in loaded.report.collect()}
    assert report["rejected rows"] == 2 and report["repeated keys"] == 0
    found = {(r.relation, r.check_name): r.actual for r in loaded.report.collect()}
    assert found["dim_cities input", "city is null"] == 1 and found["dim_cities", "city is null"] == 0
    # Loading again gives the same table.
    first = rows(loaded.rows)
    assert rows(load(cities_indicator(), raw_places, str(tmp_path / "warehouse")).rows) == first


def test_places_plan_filters_in_the_scan(raw_places, plan_of):
    plan = plan_of(clean_places(raw_places))
    assert "PushedFilters: [Not(In(state_name" in plan
    assert "Python" not in plan
    assert "id#" not in plan.split("ReadSchema")[1].split("\n")[0].replace("state_id", "")


DOCUMENT = {
    "status": "ok",
    "Results": {
        "series": [
            {
                "catalog": {"area": "Ohio", "more": 1},
                "data": [
                    {"year": "2019", "period": "M01", "value": "1970.6", "footnotes": [{}]},
                    {"year": "2019", "period": "M13", "value": "1980.0"},
                    {"year": "2019", "period": "M02", "value": "-"},
                    {"year": "2019", "period": "M12", "value": "12.5"},
                ],
            },
            {"catalog": {"area": "Iowa"}, "data": []},
            {"data": [{"year": "2019", "period": "M01", "value": "5"}]},
        ]
    },
}


@pytest.mark.parametrize("pretty", [False, True])
def test_employment(spark, tmp_path, pretty, plan_of):
    text = json.dumps(DOCUMENT, indent=2 if pretty else None)
    (tmp_path / "d.json").write_text(text)
    documents = read_documents(spark, str(tmp_path / "d.json"), multi_line=pretty)
    plan = plan_of(clean_employment(documents))
    assert "Exchange" not in plan and "Python" not in plan
    loaded = load(employment_indicator(), documents, str(tmp_path / "warehouse"))
    stored = spark.read.parquet(str(tmp_path / "warehouse" / "fact_employment"))
    assert rows(stored.select("state", "year", "month", "people_employed")) == [
        ("Ohio", 2019, 1, 1970600),
        ("Ohio", 2019, 12, 12500),
        ("Ohio", 2019, 2, None),
    ]
    assert rows(loaded.rows) == rows(stored.select(*loaded.rows.columns))
    assert rows(loaded.rejects.select("month", REASON)) == [(1, "state is null")]
    require(loaded.report)  # a missing figure is only a warning
    literal = clean_employment(documents, whole_thousands=True)
    assert [r.people_employed for r in literal.where("month = 1 and state = 'Ohio'").collect()] == [
        1971000
    ]


WEATHER = """\
dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude
1900-01-01,3.1234,0.5,Alpha,United States,31.0N,97.5W
1900-02-01,,,Alpha,United States,31.0N,97.5W
1900-03-01,4.5,,Alpha,United States,31.0N,97.5W
1900-01-01,20.1,,Delta,Peru,1.1S,77.0W
1900-01-01,20.1,,Nowhere,,31.0N,97.5W
1900-01-01,1.0,1.0,Alpha,United States,40.1N,83.0W
1900-01-01,2.0,1.0,Far,United States,60.0N,150.0W
1900-01-01,2.0,1.0,Lost,United States,,150.0W
never,2.0,1.0,Echo,United States,40.1N,83.0W
"""
CITIES = [(1, "Texas", 31.0, -97.4), (2, "Ohio", 40.0, -83.0)]


@pytest.fixture
def cities(spark):
    return spark.createDataFrame(CITIES, "city_id int, state string, latitude double, longitude double")


@pytest.fixture
def raw_weather(spark, tmp_path):
    (tmp_path / "w.csv").write_text(WEATHER)
    return read_header_csv(spark, str(tmp_path / "w.csv"), schemas.RAW_WEATHER.fieldNames())


def test_weather(spark, tmp_path, cities, raw_weather):
    loaded = load(weather_indicator(cities), raw_weather, str(tmp_path / "warehouse"))
    stored = spark.read.parquet(str(tmp_path / "warehouse" / "fact_weather"))
    assert rows(stored.select("avg_temp", "avg_temp_uncertainty", "city", "state", "date")) == [
        (1.0, 1.0, "Alpha", "Ohio", datetime.date(1900, 1, 1)),
        (2.0, 1.0, "Far", "Texas", datetime.date(1900, 1, 1)),
        (3.123, 0.5, "Alpha", "Texas", datetime.date(1900, 1, 1)),
        (4.5, None, "Alpha", "Texas", datetime.date(1900, 3, 1)),
    ]
    assert rows(loaded.rejects.select("city", REASON)) == [
        ("Echo", "date is null"),
        ("Lost", "state is null"),
    ]
    near = load(weather_indicator(cities, farthest_km=100.0), raw_weather, str(tmp_path / "near"))
    rejects = near.rejects.select("city", "latitude", "longitude", F.col("km") > 4000, REASON)
    assert rows(rejects) == [
        ("Echo", 40.1, -83.0, False, "date is null"),
        ("Far", 60.0, -150.0, True, "state is null"),
        ("Lost", None, -150.0, None, "state is null"),
    ]


def test_load_leaves_no_scratch_and_can_fail(spark, tmp_path):
    before = set(os.listdir(work_root(spark)))
    twice = Indicator(
        table="fact",
        transform=lambda raw: settle(raw, "raw"),
        keys=["k"],
        required=["k"],
        order=["v"],
    )
    raw = spark.createDataFrame([(1, 1), (1, 2), (None, 3)], "k int, v int")
    loaded = load(twice, raw, str(tmp_path))
    assert set(os.listdir(work_root(spark))) == before
    assert rows(loaded.rows) == [(1, 2)] and rows(loaded.rejects.select("v")) == [(3,)]
    with pytest.raises(QualityError, match="k is null"):
        require(measure(loaded.rejects, null_checks(["k"]), "fact"))


def test_only_the_result_stays(spark):
    before = set(os.listdir(work_root(spark)))
    with scratch(spark):
        kept = settle_result(spark, lambda: settle(spark.range(3), "step").where("id > 0"), "kept")
        assert rows(kept) == [(1,), (2,)]
        assert len(set(os.listdir(work_root(spark))) - before) == 1
    assert set(os.listdir(work_root(spark))) == before


def test_unreadable_documents_become_rejects(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps(DOCUMENT) + '\n{"Results": {\n')
    documents = read_documents(spark, str(tmp_path / "d.json"), keep_unreadable=True)
    loaded = load(employment_indicator(), documents, str(tmp_path / "warehouse"))
    assert loaded.rows.count() == 3
    assert rows(loaded.rejects.select("unreadable", REASON)) == [
        ('{"Results": {', "state is null, year is null, month is null"),
        (None, "state is null"),
    ]


def test_weather_transform_needs_no_python(raw_weather, plan_of):
    plan = plan_of(clean_weather(raw_weather))
    assert "Python" not in plan and "PushedFilters: [IsNotNull(Country)" in plan


def test_stored_states_are_not_looked_up_again(spark, cities, raw_weather):
    stored = spark.createDataFrame(
        [(31.0, -97.5, "Stored")], "latitude double, longitude double, state string"
    )
    located = weather_with_state(clean_weather(raw_weather), cities, stored)
    found = {(r.city, r.state) for r in located.collect()}
    assert ("Alpha", "Stored") in found and ("Alpha", "Ohio") in found
    assert ("Alpha", "Texas") not in found


def test_distance_limit(spark, cities):
    spots = spark.createDataFrame([(60.0, -150.0)], "latitude double, longitude double")
    assert state_of_coordinates(spots, cities).first().state == "Texas"
    assert state_of_coordinates(spots, cities, farthest_km=100).first().state is None


def test_a_new_source_is_one_declaration(spark, tmp_path):
    crime = Indicator(
        table="fact_crime",
        transform=lambda raw: raw.select("state", F.col("n").try_cast("int").alias("cases")),
        keys=["state"],
        required=["state", "cases"],
        rules={"negative": F.col("cases") >= 0},
        partition_by=["state"],
    )
    raw = spark.createDataFrame(
        [("Ohio", "3"), ("Ohio", "4"), ("Iowa", "x"), ("Utah", "-1")], "state string, n string"
    )
    loaded = load(crime, raw, str(tmp_path))
    assert rows(loaded.rows) == [("Ohio", 3), ("Ohio", 4)]
    assert rows(loaded.rejects.select("state", REASON)) == [
        ("Iowa", "cases is null, negative"),
        ("Utah", "negative"),
    ]
    report = {r.check_name: r.actual for r in loaded.report.collect()}
    assert report["repeated keys"] == 1
    assert rows(prepare(crime, raw).rows) == rows(loaded.rows)


def test_gate_stops_a_bad_table(spark):
    report = spark.createDataFrame(
        [("x", 2, 0, False, "failure")],
        "check_name string, actual int, expected int, passed boolean, severity string",
    )
    with pytest.raises(QualityError):
        require(report)


def test_one_series_per_state(spark):
    codes = spark.createDataFrame([(c,) for c in schemas.STATE_CODES], "state_code string")
    ids = wanted_series(codes)
    assert ids.count() == 50 and ids.first().series_id == "SMU01000000000000001"


def test_profiles_and_ranking(spark):
    cities = spark.createDataFrame(
        [(1, "A", "Ohio", 5), (2, "A", "Ohio", 9), (3, "B", "Iowa", 1), (4, "A", "Iowa", 1)],
        "city_id int, city string, state string, population int",
    )
    assert rows(one_place_per_name(cities).select("city_id")) == [(2,), (3,), (4,)]
    day = datetime.date
    weather = spark.createDataFrame(
        [(1.0, "A", "Ohio", day(2000, 1, 1)), (3.0, "A", "Ohio", day(2000, 2, 1)),
         (99.0, "A", "Ohio", day(2001, 1, 1)), (7.0, "A", "Iowa", day(2000, 1, 1))],
        "avg_temp double, city string, state string, date date",
    )
    employment = spark.createDataFrame(
        [(10, "Ohio", 2000, 1), (30, "Ohio", 1999, 12), (None, "Ohio", 2000, 2)],
        "people_employed long, state string, year int, month int",
    )
    profiles = place_profiles(cities, weather, employment, day(2000, 1, 1), day(2000, 12, 31))
    assert rows(profiles.select("city_id", "mean_temp", "people_employed")) == [
        (2, 2.0, 10), (3, None, None), (4, 7.0, None),
    ]
    ranked = rank_places(profiles, {"mean_temp": 1.0, "population": -0.5}, "city_id", 2)
    assert rows(ranked.select("place_rank", "city_id", "score")) == [(1, 4, 1.5), (2, 3, 0.5)]


def test_shared_folder_is_the_clusters(spark):
    assert work_root(spark) == spark.conf.get("spark.checkpoint.dir")
    path = settle(spark.range(3), "x").inputFiles()[0]
    assert work_root(spark) in path
