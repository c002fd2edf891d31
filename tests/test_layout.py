from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from statewise.sinks.layout import (
    SALT,
    file_ranges,
    heavy_keys,
    save_spread,
    write_sorted,
    write_z_ordered,
)


def test_files_of_a_compound_order_do_not_overlap(spark, tmp_path):
    path = str(tmp_path / "sorted")
    # The first column has two values, so its order alone would give two files.
    frame = spark.range(4000).select((F.col("id") % 2).alias("y"), ((F.col("id") * 7919) % 4000).alias("m"))
    write_sorted(frame, path, ["y", "m"], 8)
    place = F.col("y") * 10_000 + F.col("m")
    found = file_ranges(spark.read.parquet(path).withColumn("at", place), ["at"])
    ranges = sorted((r["at_least"], r["at_greatest"]) for r in found.collect())
    assert len(ranges) == 8
    assert all(before[1] < after[0] for before, after in zip(ranges, ranges[1:]))


@pytest.mark.parametrize("column", ["x", "y"])
def test_a_range_of_either_column_meets_few_z_ordered_files(spark, tmp_path, column):
    path = str(tmp_path / "z")
    x, y = (F.col("id") * 7919) % 6400, (F.col("id") * 104_729) % 6389
    write_z_ordered(spark.range(6400).select(x.alias("x"), y.alias("y")), path, ["x", "y"], 16)
    back = spark.read.parquet(path)
    assert back.count() == 6400 and back.columns == ["x", "y"]
    met = file_ranges(back, ["x", "y"]).where(
        (F.col(f"{column}_least") <= 1100) & (F.col(f"{column}_greatest") >= 1000)
    )
    assert met.count() <= 6  # 4 of 16 would be perfect, without an order it is all


def test_z_order_of_nulls_dates_and_one_value(spark, tmp_path):
    path = str(tmp_path / "z")
    day = F.when(F.col("id") % 3 > 0, F.expr("date'2020-01-01' + cast(id as int)"))
    frame = spark.range(300).select(day.alias("day"), F.lit(5).alias("same"), F.lit(None).cast("int").alias("no"))
    write_z_ordered(frame, path, ["day", "same", "no"], 4)
    assert sorted(map(str, spark.read.parquet(path).collect())) == sorted(map(str, frame.collect()))


def test_heavy_keys_are_counted_and_null_is_none(spark):
    key = F.expr("case when id < 300 then 'hot' when id < 400 then null else string(id) end")
    frame = spark.range(1000).select(key.alias("k"))
    assert heavy_keys(frame, "k", 0.1) == [("hot", 300)]
    assert heavy_keys(frame.where("k is null"), "k") == []


def test_a_key_with_a_third_of_the_rows_joins_bucketed_over_many_buckets(spark, tmp_path, plan_of):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k")
    facts = spark.range(9000).select(key, F.col("id").alias("v"))
    lookup = facts.select("k").distinct().withColumn("name", F.concat(F.lit("n"), "k"))
    spark.sql("CREATE DATABASE IF NOT EXISTS layouts")
    names = ("layouts.facts", "layouts.names")
    heavy = save_spread(facts, lookup, "k", names, (str(tmp_path / "f"), str(tmp_path / "n")), 8, 0.02)
    assert heavy == [(0, 3000)]
    stored = spark.table(names[0])
    per_file = stored.groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).first()[0]
    assert per_file < 3000
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = stored.join(spark.table(names[1]), ["k", SALT])
        assert "Exchange" not in plan_of(joined)
        assert joined.count() == 9000
        assert joined.where("name = concat('n', k)").select("v").distinct().count() == 9000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
