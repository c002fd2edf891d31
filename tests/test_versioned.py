from __future__ import annotations

import uuid

import pytest
from conftest import rows
from pyspark.sql import types as T

from statewise.sinks import versioned
from statewise.sinks.versioned import (
    Published,
    VersionedStore,
    current_version,
    remove_old_versions,
    upsert_versioned,
)

ROW = T.StructType().add("p", "integer").add("k", "integer").add("at", "integer").add("v", "string")
FIRST = [(1, 1, 1, "a"), (1, 2, 1, "b"), (2, 1, 1, "c"), (None, 1, 1, "n")]
SECOND = [(1, 1, 2, "a2"), (1, 3, 1, "d"), (3, 1, 1, "e"), (1, 2, 0, "older")]
MERGED = [(1, 1, 2, "a2"), (1, 2, 1, "b"), (1, 3, 1, "d"), (2, 1, 1, "c"), (3, 1, 1, "e"), (None, 1, 1, "n")]


@pytest.fixture
def store(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS stores")
    name = f"stores.s{uuid.uuid4().hex}"
    return VersionedStore(name, str(tmp_path / "s"), ROW, ["p", "k"], ["at", "v"], ["p"])


def test_latest_wins_and_a_repeated_delivery_writes_nothing(spark, store, tmp_path):
    first, second = (spark.createDataFrame(data, ROW) for data in (FIRST, SECOND))
    assert upsert_versioned(store, first) == Published(1, 3, 3)
    assert upsert_versioned(store, second) == Published(2, 2, 2)
    assert rows(store.read(spark)) == sorted(MERGED, key=str)
    files = sorted(tmp_path.rglob("data/**/*.parquet"))
    assert upsert_versioned(store, first) == Published(2, 3, 0)
    assert upsert_versioned(store, second) == Published(2, 2, 0)
    assert sorted(tmp_path.rglob("data/**/*.parquet")) == files
    assert rows(store.read(spark)) == sorted(MERGED, key=str)


def test_a_reader_of_before_sees_the_old_rows_until_they_are_removed(spark, store):
    upsert_versioned(store, spark.createDataFrame(FIRST, ROW))
    reading = store.read(spark)
    upsert_versioned(store, spark.createDataFrame(SECOND, ROW))
    assert rows(reading) == sorted(FIRST, key=str)
    assert remove_old_versions(store, spark) == 1  # the old folder of partition 1
    assert rows(store.read(spark)) == sorted(MERGED, key=str)


@pytest.mark.parametrize("killed", ["_declare", "_publish"])
def test_a_killed_publication_changes_nothing_and_can_be_repeated(spark, store, monkeypatch, killed):
    upsert_versioned(store, spark.createDataFrame(FIRST, ROW))

    def die(*_):
        raise KeyboardInterrupt

    second = spark.createDataFrame(SECOND, ROW)
    with monkeypatch.context() as patch:
        patch.setattr(versioned, killed, die)
        with pytest.raises(KeyboardInterrupt):
            upsert_versioned(store, second, stage="delivery-2")
    assert current_version(store, spark) == 1
    assert rows(store.read(spark)) == sorted(FIRST, key=str)
    assert upsert_versioned(store, second, stage="delivery-2") == Published(2, 2, 2)
    assert rows(store.read(spark)) == sorted(MERGED, key=str)


def test_only_the_partitions_asked_for_are_read(spark, store, plan_of):
    upsert_versioned(store, spark.createDataFrame(FIRST, ROW))
    one = store.read(spark).where("p = 1")
    assert one.count() == 2 and "PartitionFilters: [isnotnull(p" in plan_of(one)


def test_the_empty_store_and_a_text_that_is_no_folder(spark, store, tmp_path):
    assert store.read(spark).count() == 0
    assert upsert_versioned(store, spark.createDataFrame([], ROW)) == Published(0, 0, 0)
    text = T.StructType().add("p", "string").add("k", "integer")
    other = VersionedStore(f"{store.name}_t", str(tmp_path / "t"), text, ["p", "k"], ["k"], ["p"])
    with pytest.raises(Exception, match="no folder"):
        upsert_versioned(other, spark.createDataFrame([("a/b", 1)], text))
    upsert_versioned(other, spark.createDataFrame([("a b", 1), (None, 2)], text))
    assert rows(other.read(spark)) == sorted([("a b", 1), (None, 2)], key=str)
