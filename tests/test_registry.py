from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from conftest import rows
from pyspark.sql import types as T

from statewise.sinks.registry import KeyRegistry, register, take_blocks, with_registered

KEYS = T.StructType().add("city", "string").add("state", "string")


def test_numbers_stay_when_a_key_comes_in_between(spark, tmp_path):
    registry = KeyRegistry(str(tmp_path / "r"), KEYS, "city_id", block=10)
    first = spark.createDataFrame([("b", "x"), ("d", "x"), (None, "x"), ("b", "x")], KEYS)
    assert register(registry, first) == 3
    before = {tuple(row)[:2]: row["city_id"] for row in registry.read(spark).collect()}
    assert sorted(before.values()) == [1, 2, 3]
    more = first.union(spark.createDataFrame([("a", "x"), ("c", None)], KEYS))
    found = with_registered(registry, more)
    after = {(row["city"], row["state"]): row["city_id"] for row in found.collect()}
    assert found.count() == 6 and {key: after[key] for key in before} == before
    assert sorted(after[key] for key in after.keys() - before.keys()) == [11, 12]
    assert register(registry, more) == 0


def test_more_keys_than_a_block(spark, tmp_path):
    registry = KeyRegistry(str(tmp_path / "r"), T.StructType().add("k", "long"), block=7)
    assert register(registry, spark.range(30).withColumnRenamed("id", "k")) == 30
    assert rows(registry.read(spark).select("id", "k")) == sorted([(i + 1, i) for i in range(30)], key=str)


def test_two_loads_at_once_take_different_blocks(spark, tmp_path):
    registry = KeyRegistry(str(tmp_path / "r"), KEYS)
    with ThreadPoolExecutor(4) as pool:
        taken = [block for blocks in pool.map(lambda _: take_blocks(spark, registry, 5), range(4)) for block in blocks]
    assert len(set(taken)) == 20


def test_an_empty_table_numbers_nothing(spark, tmp_path):
    registry = KeyRegistry(str(tmp_path / "r"), KEYS)
    empty = spark.createDataFrame([], KEYS)
    assert register(registry, empty) == 0
    assert with_registered(registry, empty).columns == ["id", "city", "state"]
