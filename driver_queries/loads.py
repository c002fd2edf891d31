"""The three datasets, from raw rows to loaded star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.relational import NOT_SEGMENTS
from driver_queries.stand_ins import (
    SQL_CITIES,
    SQL_FIGURES,
    SQL_KM,
    SQL_PLACES,
    cities,
    documents,
    new_database,
    raw_places,
    raw_weather,
    sql_coordinates,
    table,
)
from statewise import schemas
from statewise.operators.quality import measure, null_checks
from statewise.plans.employment import (
    DELIVERY,
    clean_employment,
    deliveries,
    employment_store,
)
from statewise.plans.indicator import (
    cities_indicator,
    employment_indicator,
    load,
    prepare,
    weather_indicator,
)
from statewise.plans.places import clean_places
from statewise.sinks.files import clustered, write_csv
from statewise.sinks.tables import create_tables, drop_tables, load_file
from statewise.sources.files import read_header_csv
from statewise.streaming.ingest import ingest_available
from statewise.workspace import new_folder


def table_load(spark, folder):
    """Processed CSV appended to a freshly created table, twice."""
    places = clean_places(raw_places(spark, folder), NOT_SEGMENTS)
    path = new_folder(spark, "processed")
    write_csv(places.select(*schemas.LOAD_ORDER["dim_cities"]), path)
    database, before = new_database(spark), spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)
    try:
        drop_tables(spark)  # none there: no effect
        create_tables(spark, new_folder(spark, "warehouse"))
        create_tables(spark, new_folder(spark, "warehouse"))  # they exist: no effect
        load_file(spark, "dim_cities", path)
        load_file(spark, "dim_cities", path)
    finally:
        spark.catalog.setCurrentDatabase(before)
    return spark.table(f"{database}.dim_cities")


def dim_cities(spark, folder):
    path = new_folder(spark, "raw")
    write_csv(raw_places(spark, folder), path)
    raw = read_header_csv(spark, path, schemas.RAW_PLACES.fieldNames())
    return load(cities_indicator(), raw, new_folder(spark, "warehouse")).rows


def fact_employment(spark, folder):
    loaded = load(
        employment_indicator(), documents(spark, folder), new_folder(spark, "warehouse")
    )
    return loaded.rows.withColumn("people_employed", F.col("people_employed").cast("double"))


def _spoiled(series):
    area = F.nullif(series["catalog"]["area"], F.lit("1-URGENT"))
    unknown = F.coalesce(area == "F", F.lit(False))

    def figure(one):
        strange = unknown & (one["period"] != schemas.ANNUAL_PERIOD)
        period = F.when(strange, "Mxx").otherwise(one["period"])
        return F.struct(one["year"].alias("year"), period.alias("period"), one["value"].alias("value"))

    return F.struct(
        F.struct(area.alias("area")).alias("catalog"),
        F.transform(series["data"], figure).alias("data"),
    )


def employment_report(spark, folder):
    """Documents in which an area is missing and another has unknown periods."""
    spoiled = documents(spark, folder).withColumn(
        "Results",
        F.struct(
            F.transform("Results.series", lambda series: _spoiled(series)).alias("series")
        ),
    )
    report = prepare(employment_indicator(), spoiled).report
    return report.withColumn("passed", F.col("passed").cast("int"))


def employment_null_check(spark, folder):
    figures = clean_employment(documents(spark, folder), whole_thousands=True)
    return measure(figures, null_checks(["people_employed"])).drop("passed", "severity")


def employment_ingest(spark, folder):
    """Orders as figures that are delivered, and corrected, up to two months late."""
    landing, progress = new_folder(spark, "landing"), new_folder(spark, "progress")
    store = employment_store(new_folder(spark, "store"))
    delivered = F.date_format(
        F.add_months("o_orderdate", (F.col("o_custkey") % 3).cast("int")), "yyyyMM"
    )
    figure = F.struct(
        F.date_format("o_orderdate", "yyyy").alias("year"),
        F.concat(F.lit("M"), F.date_format("o_orderdate", "MM")).alias("period"),
        delivered.alias("value"),
    )
    series = F.struct(
        F.struct(F.col("o_orderstatus").alias("area")).alias("catalog"),
        F.array(figure).alias("data"),
    )
    raw = table(spark, folder, "orders").select(
        F.struct(F.array(series).alias("series")).alias("Results"),
        delivered.alias("ingest_month"),
    )
    early = F.coalesce(F.col("ingest_month") < "199801", F.lit(False))
    for arrived in (~early, early):
        clustered(raw.where(arrived), ["ingest_month"]).write.mode("append").partitionBy(
            "ingest_month"
        ).json(landing)
        ingest_available(spark, landing, DELIVERY, deliveries, store, progress)
    return store.read(spark).select(*schemas.FACT_EMPLOYMENT.fieldNames(), "ingest_month")


def ingest_rejects(spark, folder):
    """Broken documents and unknown periods: good and rejected rows are all rows.

    An order with status P gives text that is not JSON, one with status O a
    figure of an unknown period; of each, the number that went where.
    """
    landing, progress = new_folder(spark, "landing"), new_folder(spark, "progress")
    store = employment_store(new_folder(spark, "store"))
    month = F.date_format("o_orderdate", "MM")
    period = F.when(F.col("o_orderstatus") == "O", "Mxx").otherwise(F.concat(F.lit("M"), month))
    figure = F.struct(
        F.date_format("o_orderdate", "yyyy").alias("year"),
        period.alias("period"),
        F.col("o_custkey").cast("string").alias("value"),
    )
    # Every order has an area of its own, so that no figure replaces another.
    area = F.struct(F.col("o_orderkey").cast("string").alias("area"))
    series = F.struct(area.alias("catalog"), F.array(figure).alias("data"))
    document = F.to_json(F.struct(F.struct(F.array(series).alias("series")).alias("Results")))
    text = F.when(F.col("o_orderstatus") == "P", F.substring(document, 1, 20)).otherwise(document)
    table(spark, folder, "orders").select(
        text.alias("value"), F.date_format("o_orderdate", "yyyy01").alias("ingest_month")
    ).write.partitionBy("ingest_month").text(landing)
    ingest_available(spark, landing, DELIVERY, deliveries, store, progress)
    rejects = spark.read.parquet(f"{store.path}_rejects")
    return (
        store.read(spark)
        .select(F.lit("").alias("reject_reason"))
        .unionByName(rejects.select("reject_reason"))
        .groupBy("reject_reason")
        .agg(F.count("*").alias("n"))
    )


def _weather(spark, folder, farthest_km=None):
    path = new_folder(spark, "raw")
    write_csv(raw_weather(spark, folder), path)
    raw = read_header_csv(spark, path, schemas.RAW_WEATHER.fieldNames())
    return load(
        weather_indicator(cities(spark, folder), farthest_km=farthest_km),
        raw,
        new_folder(spark, "warehouse"),
    )


def fact_weather(spark, folder):
    rows = _weather(spark, folder).rows
    return rows.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def fact_weather_near(spark, folder):
    rows = _weather(spark, folder, farthest_km=100.0).rows
    return rows.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def weather_rejects(spark, folder):
    rejects = _weather(spark, folder, farthest_km=100.0).rejects
    return rejects.withColumns(
        {"date": F.date_format("date", "yyyy-MM-dd"), "km": F.round("km", 3)}
    )


QUERIES = {
    "table_load": table_load,
    "dim_cities": dim_cities,
    "fact_employment": fact_employment,
    "employment_ingest": employment_ingest,
    "employment_report": employment_report,
    "employment_null_check": employment_null_check,
    "ingest_rejects": ingest_rejects,
    "fact_weather": fact_weather,
    "fact_weather_near": fact_weather_near,
    "weather_rejects": weather_rejects,
}

_SQL_LOCATED = f"""
    WITH points AS (
        SELECT o.*, {sql_coordinates('o_custkey')} FROM orders o
        WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT'),
    a AS (SELECT DISTINCT latitude, longitude FROM points),
    b AS ({SQL_CITIES}),
    near AS (
        SELECT a.latitude, a.longitude, b.state, {SQL_KM} AS km FROM a, b
        QUALIFY row_number() OVER (
            PARTITION BY a.latitude, a.longitude ORDER BY {SQL_KM}, city_id) = 1),
    located AS (
        SELECT o_totalprice AS avg_temp,
               CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END
                   AS avg_temp_uncertainty,
               o_orderpriority AS city,
               state, latitude, longitude, round(km, 3) AS km,
               strftime(o_orderdate, '%Y-%m-%d') AS date
        FROM points JOIN near USING (latitude, longitude))"""

SQL = {
    "table_load": f"""
        WITH p AS ({SQL_PLACES}),
        n AS (SELECT row_number() OVER (ORDER BY state, city) AS city_id, * FROM p)
        SELECT * FROM n
        UNION ALL
        SELECT city_id + (SELECT count(*) FROM n), * EXCLUDE (city_id) FROM n""",
    "dim_cities": f"""
        WITH p AS ({SQL_PLACES.replace("('HOUSEHOLD', 'MACHINERY')",
                                       "('Puerto Rico', 'District of Columbia')")})
        SELECT row_number() OVER (ORDER BY state, city) AS city_id, * FROM p""",
    "fact_employment": f"""
        SELECT state, year, month, max(people_employed) AS people_employed
        FROM ({SQL_FIGURES}) GROUP BY state, year, month""",
    "ingest_rejects": """
        SELECT CASE o_orderstatus WHEN 'P' THEN 'unreadable' WHEN 'O' THEN 'month is null'
                    ELSE '' END AS reject_reason, count(*) AS n
        FROM orders GROUP BY 1""",
    "employment_ingest": """
        SELECT o_orderstatus AS state, cast(year(o_orderdate) as integer) AS year,
               cast(month(o_orderdate) as integer) AS month,
               max(strftime(o_orderdate + to_months(cast(o_custkey % 3 as integer)), '%Y%m'))
                   AS ingest_month,
               cast(max(strftime(
                   o_orderdate + to_months(cast(o_custkey % 3 as integer)), '%Y%m'))
                   as bigint) * 1000 AS people_employed
        FROM orders GROUP BY 1, 2, 3""",
    "employment_report": f"""
        WITH f AS (
            SELECT nullif(state, '1-URGENT') AS state, year,
                   CASE WHEN state <> 'F' THEN month END AS month, people_employed
            FROM ({SQL_FIGURES})),
        g AS (
            SELECT state, year, month, max(people_employed) AS people_employed FROM f
            WHERE state IS NOT NULL AND year IS NOT NULL AND month IS NOT NULL
            GROUP BY state, year, month),
        c AS (
            SELECT ' input' AS side, 'state is null' AS check_name,
                   count(*) FILTER (WHERE state IS NULL) AS actual, 'warning' AS severity FROM f
            UNION ALL SELECT ' input', 'year is null',
                   count(*) FILTER (WHERE year IS NULL), 'warning' FROM f
            UNION ALL SELECT ' input', 'month is null',
                   count(*) FILTER (WHERE month IS NULL), 'warning' FROM f
            UNION ALL SELECT ' input', 'rejected rows', count(*) FILTER (
                   WHERE state IS NULL OR year IS NULL OR month IS NULL), 'warning' FROM f
            UNION ALL SELECT '', 'state is null', count(*) FILTER (WHERE state IS NULL),
                   'failure' FROM g
            UNION ALL SELECT '', 'year is null', count(*) FILTER (WHERE year IS NULL),
                   'failure' FROM g
            UNION ALL SELECT '', 'month is null', count(*) FILTER (WHERE month IS NULL),
                   'failure' FROM g
            UNION ALL SELECT '', 'people_employed is null',
                   count(*) FILTER (WHERE people_employed IS NULL), 'warning' FROM g
            UNION ALL SELECT '', 'repeated keys', count(*) - count(DISTINCT (state, year, month)),
                   'failure' FROM g)
        SELECT 'fact_employment' || side AS relation, check_name, actual,
               cast(0 as bigint) AS expected,
               CASE WHEN actual = 0 THEN 1 ELSE 0 END AS passed, severity
        FROM c""",
    "employment_null_check": f"""
        WITH f AS ({SQL_FIGURES})
        SELECT '' AS relation, 'people_employed is null' AS check_name,
               count(*) AS actual, cast(0 as bigint) AS expected
        FROM f WHERE people_employed IS NULL""",
    "fact_weather": f"""{_SQL_LOCATED}
        SELECT * EXCLUDE (latitude, longitude, km) FROM located""",
    "fact_weather_near": f"""{_SQL_LOCATED}
        SELECT * EXCLUDE (latitude, longitude, km) FROM located WHERE km <= 100""",
    "weather_rejects": f"""{_SQL_LOCATED}
        SELECT * REPLACE (CAST(NULL AS VARCHAR) AS state), 'state is null' AS reject_reason
        FROM located WHERE km > 100""",
}
