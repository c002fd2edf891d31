"""Questions asked of the star schema."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from driver_queries.stand_ins import table
from statewise.operators.lookup import join_dimension
from statewise.plans.star import (
    facts_by_dimension,
    place_profiles,
    rank_places,
    summary_in_range,
    total_by_month,
)

MONEY = "decimal(18,2)"


def weather_range_agg(spark, folder):
    summary = summary_in_range(
        table(spark, folder, "lineitem"),
        "l_shipdate",
        datetime.date(1996, 3, 1),
        datetime.date(1998, 2, 28),
        ["l_returnflag", "l_linestatus"],
        "l_quantity",
    )
    return summary.withColumn("mean", F.round("mean", 6))


def employment_month_agg(spark, folder):
    totals = total_by_month(
        table(spark, folder, "orders"),
        ["o_orderstatus"],
        F.year("o_orderdate"),
        F.month("o_orderdate"),
        F.col("o_totalprice").cast(MONEY),
    )
    return totals.withColumn("total", F.col("total").cast("double"))


def star_join(spark, folder):
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = join_dimension(
        table(spark, folder, "customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
        ),
        nations.select("n_nationkey", "n_name", "r_name"),
        ["n_nationkey"],
    )
    found = facts_by_dimension(
        table(spark, folder, "orders").withColumn("year", F.year("o_orderdate")),
        customers,
        ["o_custkey"],
        ["r_name", "n_name", "year"],
        {"spent": F.sum(F.col("o_totalprice").cast(MONEY)), "n_orders": F.count("*")},
    )
    return found.withColumn("spent", F.col("spent").cast("double"))


def ranked_customers(spark, folder):
    orders = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count("*").alias("n_orders"),
            F.sum(F.col("o_totalprice").cast(MONEY)).cast("double").alias("spent"),
        )
    )
    places = (
        table(spark, folder, "customer")
        .select("c_custkey", "c_acctbal")
        .join(orders, "c_custkey", "left")
    )
    weights = {"c_acctbal": 0.5, "n_orders": 0.3, "spent": -0.2}
    best = rank_places(places, weights, tie="c_custkey", top=25)
    return best.withColumn("n_orders", F.col("n_orders").cast("double"))


def profiles(spark, folder):
    supplier = table(spark, folder, "supplier")
    places = supplier.select(
        F.col("s_suppkey").alias("city_id"),
        F.concat(F.lit("city "), F.floor(F.col("s_suppkey") / 2).cast("string")).alias("city"),
        F.concat(F.lit("state "), (F.floor(F.col("s_suppkey") / 2) % 7).cast("string")).alias(
            "state"
        ),
        (F.col("s_suppkey") % 3).cast("int").alias("population"),
    )
    half = F.floor(F.col("l_suppkey") / 2)
    weather = table(spark, folder, "lineitem").select(
        F.col("l_quantity").alias("avg_temp"),
        F.concat(F.lit("city "), half.cast("string")).alias("city"),
        F.concat(F.lit("state "), (half % 7).cast("string")).alias("state"),
        F.to_date("l_shipdate").alias("date"),
    )
    employment = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("people_employed"),
        F.concat(F.lit("state "), (F.col("o_custkey") % 5).cast("string")).alias("state"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    )
    profile = place_profiles(
        places,
        weather,
        employment,
        datetime.date(1997, 1, 1),
        datetime.date(1997, 12, 31),
    )
    return profile.select(
        "city",
        "state",
        "city_id",
        "population",
        F.round("mean_temp", 6).alias("mean_temp"),
        F.col("people_employed").cast("double").alias("people_employed"),
    )


QUERIES = {
    "weather_range_agg": weather_range_agg,
    "employment_month_agg": employment_month_agg,
    "star_join": star_join,
    "rank_places": ranked_customers,
    "place_profiles": profiles,
}

SQL = {
    "weather_range_agg": """
        SELECT l_returnflag, l_linestatus, count(l_quantity) AS n,
               round(avg(l_quantity), 6) AS mean, min(l_quantity) AS least,
               max(l_quantity) AS greatest
        FROM lineitem
        WHERE l_shipdate BETWEEN date '1996-03-01' AND date '1998-02-28'
        GROUP BY 1, 2""",
    "employment_month_agg": """
        SELECT o_orderstatus, cast(year(o_orderdate) as integer) AS year,
               cast(month(o_orderdate) as integer) AS month,
               cast(sum(cast(o_totalprice as decimal(18,2))) as double) AS total,
               count(*) AS n
        FROM orders GROUP BY 1, 2, 3""",
    "star_join": """
        SELECT r_name, n_name, cast(year(o_orderdate) as integer) AS year,
               cast(sum(cast(o_totalprice as decimal(18,2))) as double) AS spent,
               count(*) AS n_orders
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        GROUP BY 1, 2, 3""",
    "rank_places": """
        WITH o AS (
            SELECT o_custkey AS c_custkey, count(*) AS n_orders,
                   cast(sum(cast(o_totalprice as decimal(18,2))) as double) AS spent
            FROM orders GROUP BY 1),
        p AS (SELECT c_custkey, c_acctbal, n_orders, spent
              FROM customer LEFT JOIN o USING (c_custkey)),
        r AS (SELECT *,
                percent_rank() OVER (
                    PARTITION BY c_acctbal IS NULL ORDER BY c_acctbal) AS a,
                percent_rank() OVER (
                    PARTITION BY n_orders IS NULL ORDER BY n_orders) AS b,
                percent_rank() OVER (PARTITION BY spent IS NULL ORDER BY spent) AS c
              FROM p),
        s AS (SELECT c_custkey, c_acctbal, cast(n_orders as double) AS n_orders, spent,
                round(CASE WHEN c_acctbal IS NULL THEN 0 ELSE a END * cast(0.5 as double)
                    + CASE WHEN n_orders IS NULL THEN 0 ELSE b END * cast(0.3 as double)
                    + CASE WHEN spent IS NULL THEN 0 ELSE 1 - c END * cast(0.2 as double),
                    6) AS score
              FROM r)
        SELECT *, cast(rank() OVER (ORDER BY score DESC) as integer) AS place_rank
        FROM s ORDER BY score DESC, c_custkey LIMIT 25""",
    "place_profiles": """
        WITH c AS (
            SELECT s_suppkey AS city_id, 'city ' || (s_suppkey // 2) AS city,
                   'state ' || (s_suppkey // 2) % 7 AS state,
                   cast(s_suppkey % 3 as integer) AS population
            FROM supplier
            QUALIFY row_number() OVER (
                PARTITION BY s_suppkey // 2 ORDER BY s_suppkey % 3 DESC, s_suppkey) = 1),
        w AS (
            SELECT 'city ' || (l_suppkey // 2) AS city,
                   'state ' || (l_suppkey // 2) % 7 AS state,
                   avg(l_quantity) AS mean_temp
            FROM lineitem
            WHERE cast(l_shipdate as date) BETWEEN date '1997-01-01' AND date '1997-12-31'
            GROUP BY 1, 2),
        e AS (
            SELECT 'state ' || o_custkey % 5 AS state, o_orderkey AS people_employed
            FROM orders
            QUALIFY row_number() OVER (
                PARTITION BY o_custkey % 5
                ORDER BY year(o_orderdate) DESC, month(o_orderdate) DESC,
                         o_orderkey DESC) = 1)
        SELECT city, state, city_id, population, round(mean_temp, 6) AS mean_temp,
               cast(people_employed as double) AS people_employed
        FROM c LEFT JOIN w USING (city, state) LEFT JOIN e USING (state)""",
}
