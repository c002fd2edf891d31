"""Sources and sinks: written by Spark, read back through the library."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from driver_queries.stand_ins import new_database, table
from statewise.operators.ordering import number_rows
from statewise.sinks.files import replace_partitions, write_csv, write_partitioned
from statewise.sinks.layout import SALT, save_spread, write_z_ordered
from statewise.sinks.registry import KeyRegistry, register, with_registered
from statewise.sinks.tables import read_load_file, save_bucketed
from statewise.sinks.upsert import KeyedStore, upsert
from statewise.sinks.versioned import VersionedStore, upsert_versioned
from statewise.sources.archives import member_rows
from statewise.sources.files import read_header_csv, read_months, read_typed_csv
from statewise.streaming.ingest import ingest_available
from statewise.workspace import _located, discard, new_folder

ORDERS = (
    T.StructType()
    .add("o_orderkey", "long")
    .add("o_custkey", "long")
    .add("o_orderstatus", "string")
    .add("o_totalprice", "double")
    .add("o_orderdate", "string")
    .add("o_orderpriority", "string")
)


def _orders(spark, folder):
    return table(spark, folder, "orders").withColumn(
        "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")
    )


def csv_roundtrip(spark, folder):
    path = new_folder(spark, "csv")
    write_csv(_orders(spark, folder), path)
    return read_typed_csv(spark, path, ORDERS)


def csv_by_name(spark, folder):
    path = new_folder(spark, "csv")
    write_csv(_orders(spark, folder), path)
    return read_header_csv(spark, path, ["o_orderpriority", "o_orderkey"])


def positional_load(spark, folder):
    path = new_folder(spark, "csv")
    file_order = ["o_orderdate", "o_totalprice", "o_orderkey", "o_orderstatus", "o_custkey"]
    write_csv(_orders(spark, folder).select(*file_order), path)
    return read_load_file(spark, path, file_order, ORDERS).drop("o_orderpriority")


def _by_month(spark, folder):
    return _orders(spark, folder).withColumn(
        "ingest_month", F.date_format(F.to_date("o_orderdate"), "yyyyMM")
    )


def month_partition_read(spark, folder):
    path = new_folder(spark, "months")
    write_partitioned(_by_month(spark, folder), path, ["ingest_month"])
    return read_months(spark, path, ORDERS, "199803")


def replace_month(spark, folder):
    path = new_folder(spark, "months")
    months = _by_month(spark, folder)
    spoiled = months.withColumn(
        "o_totalprice",
        F.when(F.col("ingest_month") == "199803", -1.0).otherwise(F.col("o_totalprice")),
    )
    write_partitioned(spoiled, path, ["ingest_month"])
    replace_partitions(
        months.where(F.col("ingest_month") == "199803"), path, ["ingest_month"]
    )
    return read_months(spark, path, ORDERS, "000000", "999999")


def surrogate_key(spark, folder):
    named = table(spark, folder, "customer").select("c_mktsegment", "c_name")
    return number_rows(named, ["c_mktsegment", F.desc("c_name")], "city_id", after=10)


def sorted_layout(spark, folder):
    path = new_folder(spark, "layout")
    write_partitioned(
        table(spark, folder, "lineitem"), path, ["l_linestatus"], ["l_shipdate"]
    )
    return (
        spark.read.parquet(path)
        .where((F.col("l_linestatus") == "F") & (F.year("l_shipdate") == 1997))
        .select("l_orderkey", "l_linenumber", "l_quantity", "l_linestatus")
    )


def bucketed_join(spark, folder):
    place = new_folder(spark, "bucketed")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity")
    database = new_database(spark)
    tables = {"orders": (orders, "o_orderkey"), "lines": (lines, "l_orderkey")}
    for name, (rows, key) in tables.items():
        save_bucketed(rows, f"{database}.{name}", f"{place}/{name}", [key], 16)
    joined = spark.table(f"{database}.lines").join(
        spark.table(f"{database}.orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("quantity")
    )


EVENTS = (
    T.StructType()
    .add("event_id", "long")
    .add("ts", "timestamp_ntz")
    .add("user_id", "long")
    .add("event_type", "string")
    .add("value", "double")
)


def _latest_events(path):
    return KeyedStore(
        path, EVENTS, ["user_id", "event_type"], ["ts", "event_id"], ["event_type"]
    )


def upsert_store(spark, folder):
    events = table(spark, folder, "events").select(*EVENTS.fieldNames())
    store = _latest_events(new_folder(spark, "store"))
    late = F.coalesce(F.col("value") >= 10, F.lit(False))  # NULL is not late
    upsert(store, events.where(late))
    upsert(store, events.where(~late))
    upsert(store, events.where(late))  # a repeated load changes nothing
    return store.read(spark).drop("ts")


def upsert_null_partition(spark, folder):
    """A store whose partition column is NULL in some rows, brought in by halves."""
    events = table(spark, folder, "events").select(
        "event_id", "ts", "user_id", F.nullif("event_type", F.lit("view")).alias("event_type"), "value"
    )
    store = _latest_events(new_folder(spark, "store"))
    even = F.col("user_id") % 2 == 0  # the halves share partitions but no keys
    for half in (even, ~even):
        upsert(store, events.where(half))
    return store.read(spark).drop("ts")


def incremental_ingest(spark, folder):
    landing, checkpoint = new_folder(spark, "landing"), new_folder(spark, "progress")
    store = _latest_events(new_folder(spark, "store"))
    events = table(spark, folder, "events").select(*EVENTS.fieldNames())
    late = F.coalesce(F.col("value") >= 10, F.lit(False))
    for arrived in (~late, late):
        events.where(arrived).write.mode("append").json(landing)
        ingest_available(spark, landing, EVENTS, lambda raw: raw, store, checkpoint)
    discard(spark, landing)
    return store.read(spark).drop("ts")


def _zipped_orders(spark, folder):
    """A folder with one archive per batch of orders, written by the tasks."""
    header = ",".join(ORDERS.fieldNames())
    location, files = _located(spark, new_folder(spark, "archives"))
    files.mkdirs(location)
    target = files.makeQualified(location).toString()

    def pack(batches):
        import io
        import zipfile

        import pandas as pd
        from pyarrow.fs import FileSystem
        from pyspark import TaskContext

        store, path = FileSystem.from_uri(target)
        part = TaskContext.get().partitionId()
        for number, frame in enumerate(batches):
            content = io.BytesIO()
            with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("other.csv", "not,wanted\n1,2\n")
                archive.writestr("orders.csv", "\n".join([header, *frame["line"]]))
            name = f"{part}-{number}.zip"  # a repeated attempt writes the same file
            with store.open_output_stream(f"{path}/{name}") as out:
                out.write(content.getvalue())
            yield pd.DataFrame({"name": [name]})

    lines = _orders(spark, folder).select(F.to_csv(F.struct("*")).alias("line"))
    lines.mapInPandas(pack, "name string").count()
    return target


def zip_member_rows(spark, folder):
    rows = member_rows(spark, _zipped_orders(spark, folder), ["orders.csv"], ORDERS)
    return rows.drop("path", "member")


def stable_city_ids(spark, folder):
    """Customers numbered once, then again with others among them."""
    names = T.StructType().add("c_mktsegment", "string").add("c_name", "string")
    registry = KeyRegistry(new_folder(spark, "registry"), names, "city_id")
    customers = table(spark, folder, "customer").select("c_mktsegment", "c_name", "c_custkey")
    register(registry, customers.where("c_custkey % 10 <> 0"))
    return with_registered(registry, customers)


def _versioned_events(spark):
    name = f"{new_database(spark)}.latest_events"
    path = new_folder(spark, "versions")
    return VersionedStore(
        name, path, EVENTS, ["user_id", "event_type"], ["ts", "event_id"], ["event_type"]
    )


def versioned_upsert(spark, folder):
    events = table(spark, folder, "events").select(*EVENTS.fieldNames())
    store = _versioned_events(spark)
    late = F.coalesce(F.col("value") >= 10, F.lit(False))
    for half in (late, ~late):
        upsert_versioned(store, events.where(half))
    return store.read(spark).drop("ts")


def repeated_delivery(spark, folder):
    """Partitions that each delivery has rows for, and that it makes be written anew."""
    events = table(spark, folder, "events").select(*EVENTS.fieldNames())
    corrected = F.when(F.col("event_type") == "view", F.lit(-1.0)).otherwise(F.col("value"))
    later = F.when(F.col("event_type") == "view", F.expr("ts + interval 1 day")).otherwise(F.col("ts"))
    store = _versioned_events(spark)
    said = []
    for n, delivery in enumerate(
        [events, events, events.withColumns({"value": corrected, "ts": later}), events]
    ):
        done = upsert_versioned(store, delivery)
        said.append((n, done.version, done.touched, done.rewritten))
    return spark.createDataFrame(said, "delivery int, version int, touched int, rewritten int")


def bucketed_hot_join(spark, folder):
    """Events with the largest value of their type; a few types have all the rows."""
    place, database = new_folder(spark, "spread"), new_database(spark)
    events = table(spark, folder, "events").select("event_type", "event_id", "value")
    most = events.groupBy("event_type").agg(F.max("value").alias("most"))
    names = (f"{database}.events", f"{database}.types")
    save_spread(events, most, "event_type", names, (f"{place}/events", f"{place}/types"), 16)
    joined = spark.table(names[0]).join(spark.table(names[1]), ["event_type", SALT])
    return joined.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_if(F.col("value") * 2 >= F.col("most")).alias("n_large")
    )


def z_order_scan(spark, folder):
    """A box of dates and parts from files in Z-order of both."""
    path = new_folder(spark, "layout")
    write_z_ordered(table(spark, folder, "lineitem"), path, ["l_shipdate", "l_partkey"], 16)
    box = (F.year("l_shipdate") == 1997) & F.col("l_partkey").between(100, 400)
    return (
        spark.read.parquet(path)
        .where(box)
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    )


QUERIES = {
    "csv_roundtrip": csv_roundtrip,
    "csv_by_name": csv_by_name,
    "positional_load": positional_load,
    "month_partition_read": month_partition_read,
    "replace_month": replace_month,
    "surrogate_key": surrogate_key,
    "sorted_layout": sorted_layout,
    "bucketed_join": bucketed_join,
    "upsert_store": upsert_store,
    "upsert_null_partition": upsert_null_partition,
    "incremental_ingest": incremental_ingest,
    "zip_member_rows": zip_member_rows,
    "stable_city_ids": stable_city_ids,
    "versioned_upsert": versioned_upsert,
    "repeated_delivery": repeated_delivery,
    "bucketed_hot_join": bucketed_hot_join,
    "z_order_scan": z_order_scan,
}

_ORDERS = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
    FROM orders"""
_MONTHS = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority,
           strftime(o_orderdate, '%Y%m') AS ingest_month
    FROM orders"""
_LATEST = """
    SELECT event_id, user_id, event_type, value FROM events
    QUALIFY row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""

SQL = {
    "csv_roundtrip": _ORDERS,
    "csv_by_name": """
        SELECT o_orderpriority, cast(o_orderkey as varchar) AS o_orderkey FROM orders""",
    "positional_load": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
        FROM orders""",
    "month_partition_read": f"{_MONTHS} WHERE strftime(o_orderdate, '%Y%m') = '199803'",
    "replace_month": _MONTHS,
    "surrogate_key": """
        SELECT 10 + row_number() OVER (ORDER BY c_mktsegment, c_name DESC) AS city_id,
               c_mktsegment, c_name
        FROM customer""",
    "sorted_layout": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_linestatus FROM lineitem
        WHERE l_linestatus = 'F' AND year(l_shipdate) = 1997""",
    "bucketed_join": """
        SELECT o_orderstatus, count(*) AS n, sum(l_quantity) AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "upsert_store": _LATEST,
    "upsert_null_partition": """
        SELECT event_id, user_id, nullif(event_type, 'view') AS event_type, value FROM events
        QUALIFY row_number() OVER (
            PARTITION BY user_id, nullif(event_type, 'view')
            ORDER BY ts DESC, event_id DESC) = 1""",
    "incremental_ingest": _LATEST,
    "zip_member_rows": _ORDERS,
    "stable_city_ids": """
        SELECT CASE WHEN c_custkey % 10 <> 0 THEN 0 ELSE 1000000 END + row_number() OVER (
                   PARTITION BY c_custkey % 10 <> 0 ORDER BY c_mktsegment, c_name) AS city_id,
               c_mktsegment, c_name, c_custkey
        FROM customer""",
    "versioned_upsert": _LATEST,
    "repeated_delivery": """
        WITH n AS (SELECT cast(count(DISTINCT event_type) AS integer) AS types,
                          cast(max(cast(event_type = 'view' AS integer)) AS integer) AS views FROM events)
        SELECT unnest([0, 1, 2, 3]) AS delivery, unnest([1, 1, 1 + views, 1 + views]) AS version,
               types AS touched, unnest([types, 0, views, 0]) AS rewritten
        FROM n""",
    "bucketed_hot_join": """
        SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value * 2 >= most) AS n_large
        FROM events JOIN (SELECT event_type, max(value) AS most FROM events GROUP BY 1) USING (event_type)
        GROUP BY event_type""",
    "z_order_scan": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
        WHERE year(l_shipdate) = 1997 AND l_partkey BETWEEN 100 AND 400""",
}
