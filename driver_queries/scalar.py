"""Column expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.stand_ins import day_text, table
from statewise.functions import coordinates, periods, values
from statewise.plans.employment import wanted_series


def hemisphere_coord(spark, folder):
    size = F.abs("c_acctbal").cast("decimal(12,2)").cast("string")
    side = F.element_at(
        F.array(*[F.lit(s) for s in ("N", "S", "E", "W", "x", "")]),
        (F.col("c_custkey") % 6 + 1).cast("int"),
    )
    text = F.when(F.col("c_nationkey") == 3, "").otherwise(F.concat(size, side))
    return table(spark, folder, "customer").select(
        "c_custkey", coordinates.hemisphere_degrees(text).alias("degrees")
    )


def round3(spark, folder):
    text = (F.col("l_extendedprice") / 7).cast("string")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", coordinates.rounded(text).alias("rounded")
    )


def coord_key(spark, folder):
    part = F.when(F.col("l_linenumber") != 7, F.col("l_partkey"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        coordinates.coordinate_key(F.col("l_suppkey"), part).alias("coordinate"),
    )


def period_month(spark, folder):
    code = (
        F.when(F.col("l_linenumber") == 6, "M13")
        .when(F.col("l_linenumber") == 7, "Mxx")
        .otherwise(F.concat(F.lit("M"), F.date_format("l_shipdate", "MM")))
    )
    month = periods.month_of_period(code)
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        month.cast("double").alias("month"),
        F.coalesce(periods.is_calendar_month(month), F.lit(False)).cast("int").alias("kept"),
    )


def scaled_decimal(spark, folder):
    text = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        values.people_from_thousands(text).alias("people"),
        values.people_from_thousands(text, whole_thousands=True).alias("whole"),
    )


def series_key(spark, folder):
    coded = table(spark, folder, "customer").select(
        "c_custkey", F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("state_code")
    )
    ids = coded.withColumn("series_id", values.series_id(F.col("state_code")))
    return ids.select(
        "c_custkey",
        "series_id",
        values.series_state_code(F.col("series_id")).alias("code_again"),
    )


def series_list(spark, folder):
    codes = table(spark, folder, "customer").select(
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("state_code")
    )
    return wanted_series(codes.distinct())


def yyyymm_key(spark, folder):
    day = periods.parsed_date(day_text("o_orderdate"))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        periods.year_month(day).alias("year_month"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
    )


def json_path_first(spark, folder):
    def answer(inner):
        return F.concat(F.lit('{"results":['), inner, F.lit("]}"))

    state = F.concat(F.lit('{"components":{"state":"'), "event_type", F.lit('"}}'))
    text = (
        F.when(F.col("event_type") == "error", answer(F.lit("")))
        .when(F.col("event_type") == "view", answer(F.lit('{"components":{}}')))
        .when(F.col("event_type") == "signup", F.lit('{"results":[{"comp'))
        .when(F.col("user_id") < 5, F.lit(None))
        .otherwise(answer(state))
    )
    return table(spark, folder, "events").select(
        "event_id",
        values.first_result_state(text).alias("state"),
        F.get_json_object("props", "$.k").alias("k"),
    )


QUERIES = {
    "hemisphere_coord": hemisphere_coord,
    "round3": round3,
    "coord_key": coord_key,
    "period_month": period_month,
    "scaled_decimal": scaled_decimal,
    "series_key": series_key,
    "series_list": series_list,
    "yyyymm_key": yyyymm_key,
    "json_path_first": json_path_first,
}

SQL = {
    "hemisphere_coord": """
        WITH t AS (SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN '' ELSE
            cast(abs(cast(c_acctbal as decimal(12,2))) as varchar)
            || ['N','S','E','W','x',''][c_custkey % 6 + 1] END AS text FROM customer),
        d AS (SELECT c_custkey, text,
              try_cast(left(text, length(text) - 1) as double) AS size FROM t)
        SELECT c_custkey,
               CASE WHEN right(text, 1) IN ('N', 'E') THEN size ELSE -size END AS degrees
        FROM d""",
    "round3": """
        SELECT l_orderkey, l_linenumber, round(l_extendedprice / 7, 3) AS rounded
        FROM lineitem""",
    "coord_key": """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_linenumber <> 7 THEN
                   cast(l_suppkey as varchar) || ',' || cast(l_partkey as varchar)
               END AS coordinate
        FROM lineitem""",
    "period_month": """
        WITH m AS (SELECT l_orderkey, l_linenumber,
            try_cast(substr(CASE l_linenumber WHEN 6 THEN 'M13' WHEN 7 THEN 'Mxx'
                ELSE 'M' || strftime(l_shipdate, '%m') END, 2, 3) as integer) AS month
            FROM lineitem)
        SELECT l_orderkey, l_linenumber, cast(month as double) AS month,
               CASE WHEN month BETWEEN 1 AND 12 THEN 1 ELSE 0 END AS kept
        FROM m""",
    "scaled_decimal": """
        SELECT o_orderkey,
               cast(cast(o_totalprice as decimal(12,2)) * 1000 as bigint) AS people,
               cast(cast(cast(o_totalprice as decimal(12,2)) as decimal(10,0)) * 1000
                    as bigint) AS whole
        FROM orders""",
    "series_key": """
        SELECT c_custkey,
               'SMU' || lpad(cast(c_nationkey as varchar), 2, '0')
                   || '00000' || '00000000' || '01' AS series_id,
               lpad(cast(c_nationkey as varchar), 2, '0') AS code_again
        FROM customer""",
    "series_list": """
        SELECT DISTINCT lpad(cast(c_nationkey as varchar), 2, '0') AS state_code,
               'SMU' || lpad(cast(c_nationkey as varchar), 2, '0')
                   || '00000' || '00000000' || '01' AS series_id
        FROM customer""",
    "yyyymm_key": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS year_month,
               cast(year(o_orderdate) as integer) AS year,
               cast(month(o_orderdate) as integer) AS month
        FROM orders""",
    "json_path_first": """
        WITH t AS (SELECT event_id, props, CASE
            WHEN event_type = 'error' THEN '{"results":[]}'
            WHEN event_type = 'view' THEN '{"results":[{"components":{}}]}'
            WHEN event_type = 'signup' THEN '{"results":[{"comp'
            WHEN user_id < 5 THEN NULL
            ELSE '{"results":[{"components":{"state":"' || event_type || '"}}]}'
            END AS answer FROM events)
        SELECT event_id,
               CASE WHEN json_valid(answer) THEN json_extract_string(
                   answer, '$.results[0].components.state') END AS state,
               json_extract_string(props, '$.k') AS k
        FROM t""",
}
