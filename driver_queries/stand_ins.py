"""Raw-shaped frames derived from the driver's tables, and their SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statewise.workspace import new_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_database(spark: SparkSession) -> str:
    """A database of the run's own, so that no shared name is touched."""
    name = f"run_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(spark, name)}'")
    return name


def day_text(stamp: str) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd")


# Keys spread over 25-49 degrees north and 67-124 degrees west, in hundredths.
def north(key: Column) -> Column:
    return F.lit(2500) + (key * 7919) % 2400


def west(key: Column) -> Column:
    return F.lit(12400) - (key * 104729) % 5700


def _hundredths_text(value: Column, suffix: str) -> Column:
    return F.concat(
        F.floor(value / 100).cast("string"),
        F.lit("."),
        F.lpad((value % 100).cast("string"), 2, "0"),
        F.lit(suffix),
    )


def latitude_text(key: Column) -> Column:
    return _hundredths_text(north(key), "N")


def longitude_text(key: Column) -> Column:
    return _hundredths_text(west(key), "W")


def coordinates(key: Column) -> list[Column]:
    return [
        (north(key) / 100).cast("double").alias("latitude"),
        (-(west(key) / 100)).cast("double").alias("longitude"),
    ]


def sql_coordinates(key: str) -> str:
    return (
        f"cast(2500 + ({key} * 7919) % 2400 as double) / 100 AS latitude, "
        f"-(cast(12400 - ({key} * 104729) % 5700 as double) / 100) AS longitude"
    )


SQL_KM = """round(2 * 6371.0088 * asin(sqrt(least(1.0,
    power(sin(radians(b.latitude - a.latitude) / 2), 2)
    + cos(radians(a.latitude)) * cos(radians(b.latitude))
      * power(sin(radians(b.longitude - a.longitude) / 2), 2)))), 6)"""


def raw_places(spark: SparkSession, folder: str) -> DataFrame:
    """City list from the customers."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        F.col("c_name").alias("city_ascii"),
        F.col("c_mktsegment").alias("state_name"),
        F.substring("c_mktsegment", 1, 2).alias("state_id"),
        _hundredths_text(north(key), "").alias("lat"),
        F.concat(F.lit("-"), _hundredths_text(west(key), "")).alias("lng"),
        key.cast("string").alias("population"),
        F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("density"),
    )


SQL_PLACES = f"""
    SELECT DISTINCT c_name AS city, c_mktsegment AS state,
           substr(c_mktsegment, 1, 2) AS state_code,
           'United States of America' AS country,
           {sql_coordinates('c_custkey')},
           cast(c_custkey as integer) AS population, c_acctbal AS density
    FROM customer WHERE c_mktsegment NOT IN ('HOUSEHOLD', 'MACHINERY')"""


def raw_weather(spark: SparkSession, folder: str) -> DataFrame:
    """Temperature history from the orders, at the customers' coordinates."""
    price = F.col("o_totalprice").cast("decimal(12,2)")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return table(spark, folder, "orders").select(
        day_text("o_orderdate").alias("dt"),
        F.when(~urgent, price.cast("string")).alias("AverageTemperature"),
        F.when(F.col("o_orderstatus") != "F", price.cast("string")).alias(
            "AverageTemperatureUncertainty"
        ),
        F.col("o_orderpriority").alias("City"),
        F.when(F.col("o_orderstatus") == "P", "Peru")
        .otherwise("United States")
        .alias("Country"),
        latitude_text(F.col("o_custkey")).alias("Latitude"),
        longitude_text(F.col("o_custkey")).alias("Longitude"),
    )


def cities(spark: SparkSession, folder: str) -> DataFrame:
    """City dimension from the suppliers."""
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("city_id"),
        F.col("s_name").alias("city"),
        F.concat(F.lit("state "), F.col("s_nationkey").cast("string")).alias("state"),
        *coordinates(F.col("s_suppkey") + 17),
        F.col("s_suppkey").cast("int").alias("population"),
    )


SQL_CITIES = f"""
    SELECT s_suppkey AS city_id, s_name AS city,
           'state ' || s_nationkey AS state, {sql_coordinates('(s_suppkey + 17)')},
           cast(s_suppkey as integer) AS population
    FROM supplier"""


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Nested employment documents, one per order: two series with figures, one
    without."""

    def figure(period: Column, value: Column) -> Column:
        return F.struct(
            F.date_format("o_orderdate", "yyyy").alias("year"),
            period.alias("period"),
            value.alias("value"),
        )

    def series(area: Column, *figures: Column) -> Column:
        return F.struct(
            F.struct(area.alias("area")).alias("catalog"), F.array(*figures).alias("data")
        )

    period = F.concat(F.lit("M"), F.date_format("o_orderdate", "MM"))
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    none = F.array().cast("array<struct<year:string,period:string,value:string>>")
    return table(spark, folder, "orders").select(
        F.struct(
            F.array(
                series(
                    F.col("o_orderstatus"),
                    figure(period, price),
                    figure(F.lit("M13"), F.lit("1.0")),
                ),
                series(
                    F.col("o_orderpriority"),
                    figure(period, F.col("o_orderkey").cast("string")),
                    figure(F.lit("M12"), F.lit("-")),
                ),
                F.struct(
                    F.struct(F.lit("empty").alias("area")).alias("catalog"),
                    none.alias("data"),
                ),
            ).alias("series")
        ).alias("Results")
    )


SQL_FIGURES = """
    SELECT o_orderstatus AS state, cast(year(o_orderdate) as integer) AS year,
           cast(month(o_orderdate) as integer) AS month,
           cast(cast(o_totalprice as decimal(12,2)) * 1000 as double) AS people_employed
    FROM orders
    UNION ALL
    SELECT o_orderpriority, cast(year(o_orderdate) as integer),
           cast(month(o_orderdate) as integer), cast(o_orderkey * 1000 as double)
    FROM orders
    UNION ALL
    SELECT o_orderpriority, cast(year(o_orderdate) as integer), 12, NULL
    FROM orders"""
