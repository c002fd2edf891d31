from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from statewise.functions.coordinates import great_circle_km
from statewise.operators import nearest as nearest_module
from statewise.operators.lookup import (
    build_lookup,
    enrich_by_key,
    extend_lookup,
    has_at_most,
    join_dimension,
    join_lookup,
    only_new_keys,
)
from statewise.operators.nearest import nearest_place
from statewise.plans.star import facts_by_dimension


@pytest.mark.parametrize("how", ["inner", "left"])
def test_shuffled_join_equals_broadcast_join(spark, how):
    # A third of the rows has one key; some keys are unknown, some NULL.
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7.5).when(F.col("id") % 100 != 1, F.col("id") % 50 + 0.0).alias("k"),
        F.create_map(F.lit("id"), F.col("id") % 5).alias("m"),
    )
    lookup = spark.range(40).select((F.col("id") + 0.0).alias("k"), F.col("id").alias("v"))
    lookup = lookup.union(spark.createDataFrame([(7.5, 99)], "k double, v bigint"))
    small = join_dimension(facts, lookup, ["k"], how)
    large = join_dimension(facts, lookup.hint("merge"), ["k"], how, rows=3)
    assert large.columns == small.columns
    assert rows(large) == rows(small)


def test_a_hot_key_is_split_over_tasks(spark):
    """A third of the rows on one key and a lookup that is not broadcast."""
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        facts = spark.range(0, 60_000, 1, 6).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("x")
        )
        lookup = spark.range(60_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        joined = join_lookup(facts, lookup, ["k"])
        assert joined.count() == 60_000
        assert joined.where("v <> 2 * k").count() == 0
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in names:
            spark.conf.unset(name)


def test_a_dimension_comes_to_the_facts(spark, plan_of):
    facts = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    dimension = spark.range(10).select(F.col("id").alias("k"), (F.col("id") % 2).alias("kind"))
    totals = facts_by_dimension(facts, dimension, ["k"], ["kind"], {"n": F.count("*")})
    assert rows(totals) == [(0, 500), (1, 500)]
    assert "BroadcastHashJoin" in plan_of(totals) and "hashpartitioning(k#" not in plan_of(totals)


def test_size_check(spark):
    frame = spark.createDataFrame([("x" * 1000, 1)] * 5, "t string, n int")
    assert has_at_most(frame, 5) and not has_at_most(frame, 4)
    assert has_at_most(frame, 5, 6000) and not has_at_most(frame, 5, 5000)


def test_other_join_types_are_refused(spark):
    frame = spark.range(1)
    with pytest.raises(ValueError):
        join_lookup(frame, frame, ["id"], "full")


def test_each_key_is_enriched_once(spark):
    facts = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (None,)], "k double")
    calls = spark.sparkContext.accumulator(0)

    def enrich(keys):
        def ask(batches):
            for frame in batches:
                calls.add(len(frame))
                yield frame.assign(v=frame["k"] * 10)

        return keys.mapInPandas(ask, "k double, v double")

    joined = enrich_by_key(facts, ["k"], enrich)
    assert rows(joined) == [(1.0, 10.0), (1.0, 10.0), (2.0, 20.0)]
    assert rows(joined) and calls.value == 2


def test_stored_answers_are_kept(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    stored = spark.createDataFrame([(1, "old"), (9, "old")], "k int, v string")
    assert rows(only_new_keys(facts, stored, ["k"])) == [(2,), (3,)]
    lookup = build_lookup(facts, ["k"], lambda keys: keys.withColumn("v", F.lit("new")), stored)
    assert rows(lookup) == [(1, "old"), (2, "new"), (3, "new"), (9, "old")]


def test_a_lasting_lookup_asks_for_new_keys_only(spark, tmp_path):
    path = str(tmp_path / "lookup")
    for keys, answer in (([1, 2, None], "first"), ([2, 3], "second")):
        facts = spark.createDataFrame([(k,) for k in keys], "k int")
        lookup = extend_lookup(path, facts, ["k"], lambda new, a=answer: new.withColumn("v", F.lit(a)))
    assert rows(lookup) == [(1, "first"), (2, "first"), (3, "second")]


def brute_force(points, places):
    """All pairs, on a small fixture."""
    right = places.select(
        "place_id", F.col("latitude").alias("a"), F.col("longitude").alias("b")
    )
    km = F.round(great_circle_km(F.col("latitude"), F.col("longitude"), F.col("a"), F.col("b")), 6)
    best = (
        points.distinct()
        .crossJoin(right)
        .groupBy("latitude", "longitude")
        .agg(F.min(F.struct(km.alias("km"), "place_id")).alias("m"))
    )
    return {(r.latitude, r.longitude): (r.m.km, r.m.place_id) for r in best.collect()}


def frames(spark, points, places):
    coordinates = "latitude double, longitude double"
    return (
        spark.createDataFrame(points, coordinates),
        spark.createDataFrame(
            [(i, *place) for i, place in enumerate(places)], "place_id int, " + coordinates
        ),
    )


def found(df):
    return {(r.latitude, r.longitude): (r.km, r.place_id) for r in df.collect()}


def globe(generator, n):
    return [
        (round(generator.uniform(-90, 90), 2), round(generator.uniform(-180, 180), 2))
        for _ in range(n)
    ]


def cluster(generator, n, lat, lon, spread):
    return [
        (lat + generator.uniform(-spread, spread), lon + generator.uniform(-spread, spread))
        for _ in range(n)
    ]


EDGES = [(90.0, 0.0), (-90.0, 10.0), (89.9, 179.9), (0.0, 180.0), (0.0, -180.0), (45.0, -179.99)]


@pytest.mark.parametrize("short_list, first_pairs", [(32, 2_000_000), (2, 0), (1, 3_000)])
def test_nearest_equals_brute_force(spark, monkeypatch, short_list, first_pairs):
    monkeypatch.setattr(nearest_module, "FIRST_PAIRS", first_pairs)
    generator = random.Random(5)
    points = globe(generator, 150) + EDGES + cluster(generator, 80, 40, -75, 0.5)
    places = globe(generator, 40) + EDGES[:4] + cluster(generator, 60, 40.2, -75.1, 0.05)
    points, places = frames(spark, points + points[:20], places + places[:5])
    near = nearest_place(points, places, short_list=short_list)
    assert found(near) == brute_force(points, places)


def test_far_cluster_takes_several_levels(spark, monkeypatch):
    """Points far from a dense group of places: their lists must still shrink."""
    monkeypatch.setattr(nearest_module, "FIRST_PAIRS", 0)
    generator = random.Random(6)
    points, places = frames(
        spark, cluster(generator, 60, -30, 100, 2), cluster(generator, 200, 45, -100, 0.3)
    )
    near = nearest_place(points, places, short_list=8)
    assert found(near) == brute_force(points, places)


def test_crowded_cell_is_cut_again(spark):
    generator = random.Random(7)
    points, places = frames(
        spark, cluster(generator, 100, 40, -75, 0.2), cluster(generator, 20, 40, -75, 0.2)
    )
    near = nearest_place(points, places, cell_points=5)
    assert found(near) == brute_force(points, places)


def test_ties_coordinates_and_gaps(spark):
    points, places = frames(
        spark,
        [(10.0, 10.0), (None, 3.0), (91.0, 0.0), (5.0, float("nan"))],
        [(10.0, 11.0), (10.0, 9.0), (10.0, 11.0)],
    )
    near = nearest_place(points, places).collect()
    assert [(r.latitude, r.longitude, r.place_id) for r in near] == [(10.0, 10.0, 0)]


def test_no_places(spark):
    points, places = frames(spark, [(10.0, 10.0)], [])
    places = spark.createDataFrame([], "place_id int, latitude double, longitude double")
    assert nearest_place(points, places).count() == 0
