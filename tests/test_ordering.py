from __future__ import annotations

from conftest import rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statewise.operators.latest import latest_by_key, repeated_keys
from statewise.operators.ordering import number_rows, percent_ranks, rows_below


def test_numbers_follow_the_order_without_gaps(spark):
    frame = spark.range(5000).select(F.xxhash64("id").alias("name"), "id").repartition(13)
    numbered = number_rows(frame, ["name"], "n", after=4).orderBy("n").collect()
    assert [r.n for r in numbered] == list(range(5, 5005))
    assert [r.name for r in numbered] == sorted(r.name for r in numbered)


def test_numbering_nothing(spark):
    assert number_rows(spark.range(0), ["id"], "n").count() == 0


def skewed(spark):
    # A third of the rows shares one value; some have none.
    return spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 1.5)
        .when(F.col("id") % 10 != 1, (F.col("id") * 7919) % 500 / 10)
        .alias("a"),
        ((F.col("id") * 31) % 17).alias("b"),
    )


def test_rows_below(spark):
    frame = skewed(spark)
    counted = {r.a: r.below for r in rows_below(frame, "a").collect()}
    known = [r.a for r in frame.collect() if r.a is not None]
    assert counted == {v: sum(other < v for other in known) for v in set(known)}


def test_ranks_equal_the_window(spark):
    frame = skewed(spark)
    expected = frame
    for value in ("a", "b"):
        present = W.partitionBy(F.col(value).isNull()).orderBy(value)
        rank = F.when(F.col(value).isNotNull(), F.percent_rank().over(present))
        expected = expected.withColumn(f"{value}_rank", rank)
    by_id = {r.id: r for r in expected.collect()}
    ranked = percent_ranks(frame, ["a", "b"])
    assert all(
        (r.a_rank, r.b_rank) == (by_id[r.id].a_rank, by_id[r.id].b_rank) for r in ranked.collect()
    )
    assert ranked.count() == 3000


def test_latest_equals_the_window(spark):
    frame = skewed(spark).withColumn("key", F.when(F.col("id") % 3 != 0, F.col("id") % 7))
    latest = latest_by_key(frame, ["key"], ["b", "id"])
    order = W.partitionBy("key").orderBy(F.desc("b"), F.desc("id"))
    first = frame.withColumn("n", F.row_number().over(order)).where("n = 1").drop("n")
    assert rows(latest.select(*frame.columns)) == rows(first)


def test_repeated_keys(spark):
    frame = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert rows(repeated_keys(frame, ["a", "b"])) == [(1, 1, 2), (None, 1, 2)]
