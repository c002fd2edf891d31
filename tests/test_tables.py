from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from statewise import schemas
from statewise.operators.quality import QualityError
from statewise.sinks.tables import (
    arranged,
    create_tables,
    drop_tables,
    insert,
    load_file,
    save_bucketed,
)


@pytest.fixture
def warehouse(spark, tmp_path):
    drop_tables(spark)
    create_tables(spark, str(tmp_path / "warehouse"))
    yield
    drop_tables(spark)


def test_definition_and_reset(spark, tmp_path, warehouse):
    create_tables(spark, str(tmp_path / "elsewhere"))  # present: no effect
    for name, schema in schemas.TABLES.items():
        assert set(spark.table(name).columns) == set(schema.fieldNames())
    drop_tables(spark)
    drop_tables(spark)
    assert not spark.catalog.tableExists("dim_cities")


def test_load_maps_columns_and_types(spark, tmp_path, warehouse):
    (tmp_path / "w.csv").write_text(
        "avg_temp,avg_temp_uncertainty,city,date,state\n1.5,,Alpha,1900-01-01,Ohio\n"
    )
    load_file(spark, "fact_weather", str(tmp_path / "w.csv"))
    row = spark.table("fact_weather").first()
    assert (row.avg_temp, row.avg_temp_uncertainty, row.city, row.state, str(row.date)) == (
        1.5, None, "Alpha", "Ohio", "1900-01-01",
    )


def test_load_refuses_missing_values(spark, tmp_path, warehouse):
    (tmp_path / "w.csv").write_text(
        "avg_temp,avg_temp_uncertainty,city,date,state\n1.5,,Alpha,someday,Ohio\n"
    )
    with pytest.raises(QualityError, match="date unfit: 1"):
        load_file(spark, "fact_weather", str(tmp_path / "w.csv"))
    (tmp_path / "w.csv").write_text(
        "avg_temp,avg_temp_uncertainty,city,date,state\n1.5,,Alpha,,Ohio\n"
    )
    with pytest.raises(QualityError, match="date: 1"):
        load_file(spark, "fact_weather", str(tmp_path / "w.csv"))
    assert spark.table("fact_weather").count() == 0


def test_load_refuses_what_does_not_fit(spark, tmp_path, warehouse):
    header = "avg_temp,avg_temp_uncertainty,city,date,state\n"
    (tmp_path / "w.csv").write_text(
        header + "1.5,abc,Alpha,1900-01-01,Ohio\n1.5,,Beta,1900-01-01,Ohio,2,3\n1.5,,Beta\n"
    )
    with pytest.raises(QualityError, match="number of fields: 2, avg_temp_uncertainty unfit: 1"):
        load_file(spark, "fact_weather", str(tmp_path / "w.csv"))
    assert spark.table("fact_weather").count() == 0


def test_numbers_go_on_over_loads(spark, tmp_path, warehouse):
    header = ",".join(schemas.LOAD_ORDER["dim_cities"])
    for i, cities in enumerate((["B", "A"], ["C"])):
        lines = [f"{city},Ohio,OH,USA,40.0,-80.0,10,1.5" for city in cities]
        (tmp_path / f"{i}.csv").write_text("\n".join([header, *lines]))
        load_file(spark, "dim_cities", str(tmp_path / f"{i}.csv"))
    assert rows(spark.table("dim_cities").select("city_id", "city")) == [(1, "A"), (2, "B"), (3, "C")]


def test_insert_is_by_name(spark, warehouse):
    # The partition column `state` is last in the table but not in the rows.
    frame = spark.createDataFrame(
        [("Ohio", "Alpha", 1.0, 0.5)], "state string, city string, avg_temp double, avg_temp_uncertainty double"
    ).withColumn("date", F.lit("2000-01-01").cast("date"))
    insert(spark, "fact_weather", frame)
    row = spark.table("fact_weather").first()
    assert (row.state, row.city, row.avg_temp) == ("Ohio", "Alpha", 1.0)


def test_column_list_is_checked(spark):
    frame = spark.createDataFrame([("1",)], "x string")
    with pytest.raises(ValueError, match="1 columns given, 2 listed"):
        arranged(frame, ["city", "state"], schemas.DIM_CITIES)
    with pytest.raises(ValueError, match="not in the table: nowhere"):
        arranged(frame, ["nowhere"], schemas.DIM_CITIES)


def test_bucketed_tables_join_without_shuffle(spark, tmp_path, plan_of):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("left_side", "right_side"):
            save_bucketed(spark.range(100), name, str(tmp_path / name), ["id"], 4, ["id"])
        joined = spark.table("left_side").join(spark.table("right_side"), "id")
        assert joined.count() == 100
        assert "Exchange" not in plan_of(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("left_side", "right_side"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
