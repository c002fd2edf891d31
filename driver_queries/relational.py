"""Filters, distinct, nested data, joins, keys and quality gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.stand_ins import (
    SQL_FIGURES,
    SQL_KM,
    SQL_PLACES,
    coordinates,
    day_text,
    documents,
    latitude_text,
    longitude_text,
    raw_places,
    sql_coordinates,
    table,
)
from statewise.functions.coordinates import coordinate_key
from statewise.operators.latest import latest_by_key, repeated_keys
from statewise.operators.lookup import enrich_by_key, extend_lookup, join_lookup
from statewise.operators.nearest import nearest_place
from statewise.operators.quality import (
    Check,
    measure,
    measure_queries,
    null_checks,
    split_rejects,
    with_reason,
)
from statewise.plans.employment import clean_employment
from statewise.plans.places import clean_places, excluding
from statewise.plans.weather import clean_weather
from statewise.sources.files import read_documents
from statewise.workspace import new_folder

NOT_SEGMENTS = ("HOUSEHOLD", "MACHINERY")


def dim_places(spark, folder):
    return clean_places(raw_places(spark, folder), NOT_SEGMENTS)


def preview(spark, folder):
    return dim_places(spark, folder).orderBy("city").limit(10)


def not_in_null(spark, folder):
    segment = F.nullif("c_mktsegment", F.lit("HOUSEHOLD"))
    customers = table(spark, folder, "customer").select("c_custkey", segment.alias("segment"))
    return excluding(customers, "segment", ["MACHINERY", "BUILDING"])


def hidden_filter(spark, folder):
    return (
        table(spark, folder, "orders")
        .where(F.col("o_orderstatus") == "F")
        .select("o_orderkey", F.col("o_totalprice").alias("price"))
    )


def weather_clean(spark, folder):
    key = F.col("user_id")
    raw = table(spark, folder, "events").select(
        day_text("ts").alias("dt"),
        (F.nullif("value", F.lit(6.55)) / 7).cast("string").alias("AverageTemperature"),
        F.get_json_object("props", "$.k").alias("AverageTemperatureUncertainty"),
        F.col("event_id").cast("string").alias("City"),
        F.col("event_type").alias("Country"),
        latitude_text(key).alias("Latitude"),
        longitude_text(key).alias("Longitude"),
    )
    return clean_weather(raw, country="click").withColumn(
        "date", F.date_format("date", "yyyy-MM-dd")
    )


def nested_explode(spark, folder):
    path = new_folder(spark, "documents")
    documents(spark, folder).write.json(path)
    return clean_employment(read_documents(spark, path)).withColumn(
        "people_employed", F.col("people_employed").cast("double")
    )


def _supply_points(spark, folder, wanted="true"):
    return table(spark, folder, "lineitem").where(wanted).select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_suppkey") % 50).cast("double").alias("latitude"),
        (F.col("l_partkey") % 50).cast("double").alias("longitude"),
    )


def _enriched(points):
    place = coordinate_key(F.col("latitude").cast("int"), F.col("longitude").cast("int"))
    return points.withColumn("place", place)


def distinct_lookup_join(spark, folder):
    located = enrich_by_key(
        _supply_points(spark, folder), ["latitude", "longitude"], _enriched
    )
    return located.drop("latitude", "longitude")


def lookup_new_keys(spark, folder):
    """A lasting lookup, extended twice: the second time asks for new keys only."""
    path, keys = new_folder(spark, "lookup"), ["latitude", "longitude"]
    returned = _supply_points(spark, folder, "l_returnflag = 'R'")
    extend_lookup(path, returned, keys, lambda new: new.withColumn("place", F.lit("stored")))
    known = extend_lookup(path, _supply_points(spark, folder), keys, _enriched)
    return known.groupBy((F.col("place") == "stored").cast("int").alias("was_stored")).agg(
        F.count("*").alias("n")
    )


def hot_key_join(spark, folder):
    """A third of the rows on one key, joined with a lookup that is not broadcast."""
    lines = table(spark, folder, "lineitem").select(
        F.when(F.col("l_linenumber") % 3 == 0, 1).otherwise(F.col("l_orderkey")).alias("o_orderkey"),
        "l_quantity",
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    joined = join_lookup(lines, orders.hint("merge"), ["o_orderkey"], "left")
    return joined.groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("quantity")
    )


def nearest_lookup(spark, folder):
    customers = table(spark, folder, "customer").select(
        "c_custkey", *coordinates(F.col("c_custkey"))
    )
    suppliers = table(spark, folder, "supplier").select(
        "s_suppkey", *coordinates(F.col("s_suppkey") + 17)
    )
    return enrich_by_key(
        customers,
        ["latitude", "longitude"],
        lambda points: nearest_place(points, suppliers, "s_suppkey").drop("km"),
    ).select("c_custkey", "s_suppkey")


def upsert_by_key(spark, folder):
    events = table(spark, folder, "events").select(
        "user_id", "event_type", "event_id", "ts", "value"
    )
    return latest_by_key(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


def key_violations(spark, folder):
    return repeated_keys(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


def null_gate(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.nullif("o_orderstatus", F.lit("P")).alias("people_employed"),
        F.col("o_orderkey").alias("city"),
    )
    events = table(spark, folder, "events").select(
        F.nullif("value", F.lit(6.55)).alias("avg_temp")
    )
    report = measure(
        orders,
        [*null_checks(["people_employed"], "warning"), *null_checks(["city"])],
        "orders",
    ).unionByName(
        measure(
            events,
            [*null_checks(["avg_temp"]), Check("negative", F.col("avg_temp") < 0)],
            "events",
        )
    )
    return report.withColumn("passed", F.col("passed").cast("int"))


def query_checks(spark, folder):
    for name in ("orders", "lineitem"):
        table(spark, folder, name).createOrReplaceTempView(f"checked_{name}")
    report = measure_queries(
        spark,
        {
            "select count(*) from checked_orders where o_orderkey is null": 0,
            "select max(l_linenumber) from checked_lineitem": 7,
            "select min(o_orderstatus) from checked_orders": "G",
        },
    )
    return report.withColumn("passed", F.col("passed").cast("int"))


def _gated_orders(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        "o_totalprice",
    )


def reject_split(spark, folder):
    good, rejected = split_rejects(
        _gated_orders(spark, folder),
        ["status", "priority"],
        {"price is too low": F.col("o_totalprice") >= 1000},
    )
    return good.groupBy("status", "priority").agg(F.count("*").alias("n")).select(
        F.lit("").alias("reason"), "status", "priority", "n"
    ).unionByName(
        rejected.groupBy("reject_reason")
        .agg(F.count("*").alias("n"))
        .select(
            F.col("reject_reason").alias("reason"),
            F.lit("").alias("status"),
            F.lit("").alias("priority"),
            "n",
        )
    )


def reject_reasons(spark, folder):
    marked = with_reason(
        _gated_orders(spark, folder),
        ["status", "priority"],
        {"price is too low": F.col("o_totalprice") >= 1000},
    )
    return marked.select("o_orderkey", "reject_reason")


_SQL_REASON = """
    concat_ws(', ',
        CASE WHEN o_orderstatus = 'P' THEN 'status is null' END,
        CASE WHEN o_orderpriority = '5-LOW' THEN 'priority is null' END,
        CASE WHEN o_totalprice < 1000 THEN 'price is too low' END)"""

QUERIES = {
    "dim_places": dim_places,
    "preview": preview,
    "not_in_null": not_in_null,
    "hidden_filter": hidden_filter,
    "weather_clean": weather_clean,
    "nested_explode": nested_explode,
    "distinct_lookup_join": distinct_lookup_join,
    "lookup_new_keys": lookup_new_keys,
    "hot_key_join": hot_key_join,
    "nearest_lookup": nearest_lookup,
    "upsert_by_key": upsert_by_key,
    "key_violations": key_violations,
    "null_gate": null_gate,
    "query_checks": query_checks,
    "reject_split": reject_split,
    "reject_reasons": reject_reasons,
}

SQL = {
    "dim_places": SQL_PLACES,
    "preview": f"{SQL_PLACES} ORDER BY city LIMIT 10",
    "not_in_null": """
        SELECT c_custkey, nullif(c_mktsegment, 'HOUSEHOLD') AS segment FROM customer
        WHERE nullif(c_mktsegment, 'HOUSEHOLD') NOT IN ('MACHINERY', 'BUILDING')""",
    "hidden_filter": """
        SELECT o_orderkey, o_totalprice AS price FROM orders WHERE o_orderstatus = 'F'""",
    "weather_clean": f"""
        SELECT round(value / 7, 3) AS avg_temp,
               cast(json_extract_string(props, '$.k') as double) AS avg_temp_uncertainty,
               cast(event_id as varchar) AS city, {sql_coordinates('user_id')},
               strftime(ts, '%Y-%m-%d') AS date
        FROM events WHERE event_type = 'click' AND nullif(value, 6.55) IS NOT NULL""",
    "nested_explode": SQL_FIGURES,
    "distinct_lookup_join": """
        SELECT l_orderkey, l_linenumber,
               cast(l_suppkey % 50 as varchar) || ',' || cast(l_partkey % 50 as varchar)
                   AS place
        FROM lineitem""",
    "lookup_new_keys": """
        SELECT was_stored, count(*) AS n FROM (
            SELECT l_suppkey % 50, l_partkey % 50,
                   max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS was_stored
            FROM lineitem GROUP BY 1, 2)
        GROUP BY 1""",
    "hot_key_join": """
        WITH l AS (
            SELECT CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE l_orderkey END AS k, l_quantity
            FROM lineitem)
        SELECT o_orderpriority, count(*) AS n, sum(l_quantity) AS quantity
        FROM l LEFT JOIN orders ON k = o_orderkey GROUP BY 1""",
    "nearest_lookup": f"""
        WITH a AS (SELECT c_custkey, {sql_coordinates('c_custkey')} FROM customer),
        b AS (SELECT s_suppkey, {sql_coordinates('(s_suppkey + 17)')} FROM supplier)
        SELECT c_custkey, s_suppkey FROM a, b
        QUALIFY row_number() OVER (
            PARTITION BY c_custkey ORDER BY {SQL_KM}, s_suppkey) = 1""",
    "upsert_by_key": """
        SELECT user_id, event_type, event_id, value FROM events
        QUALIFY row_number() OVER (
            PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "key_violations": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "null_gate": """
        WITH c AS (
            SELECT 'orders' AS relation, 'people_employed is null' AS check_name,
                   count(*) AS actual, 'warning' AS severity
            FROM orders WHERE o_orderstatus = 'P'
            UNION ALL SELECT 'orders', 'city is null', count(*), 'failure'
            FROM orders WHERE o_orderkey IS NULL
            UNION ALL SELECT 'events', 'avg_temp is null', count(*), 'failure'
            FROM events WHERE value = 6.55 OR value IS NULL
            UNION ALL SELECT 'events', 'negative', count(*), 'failure'
            FROM events WHERE nullif(value, 6.55) < 0)
        SELECT relation, check_name, actual, cast(0 as bigint) AS expected,
               CASE WHEN actual = 0 THEN 1 ELSE 0 END AS passed, severity
        FROM c""",
    "query_checks": """
        SELECT 'select count(*) from checked_orders where o_orderkey is null'
                   AS check_name,
               cast(count(*) as varchar) AS actual, '0' AS expected,
               CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS passed
        FROM orders WHERE o_orderkey IS NULL
        UNION ALL
        SELECT 'select max(l_linenumber) from checked_lineitem',
               cast(max(l_linenumber) as varchar), '7',
               CASE WHEN max(l_linenumber) = 7 THEN 1 ELSE 0 END
        FROM lineitem
        UNION ALL
        SELECT 'select min(o_orderstatus) from checked_orders', min(o_orderstatus), 'G',
               CASE WHEN min(o_orderstatus) = 'G' THEN 1 ELSE 0 END
        FROM orders""",
    "reject_split": f"""
        WITH m AS (SELECT *, {_SQL_REASON} AS reason FROM orders)
        SELECT reason, CASE WHEN reason = '' THEN o_orderstatus ELSE '' END AS status,
               CASE WHEN reason = '' THEN o_orderpriority ELSE '' END AS priority,
               count(*) AS n
        FROM m GROUP BY 1, 2, 3""",
    "reject_reasons": f"""
        SELECT o_orderkey, {_SQL_REASON} AS reject_reason FROM orders""",
}
