from __future__ import annotations

import itertools
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewise.plans.employment import (
    DELIVERY,
    clean_employment,
    deliveries,
    employment_store,
)
from statewise.sinks import upsert as upsert_module
from statewise.sinks.files import replace_partitions
from statewise.sinks.upsert import KeyedStore, upsert
from statewise.sources.files import read_documents
from statewise.streaming.ingest import ingest_available

ROW = T.StructType().add("p", "integer").add("k", "integer").add("at", "integer").add("v", "string")


def store_at(path):
    return KeyedStore(str(path), ROW, ["p", "k"], ["at", "v"], ["p"])


FIRST = [(1, 1, 1, "a"), (1, 2, 1, "b"), (2, 1, 1, "c")]
SECOND = [(1, 1, 2, "a2"), (1, 3, 1, "d"), (3, 1, 1, "e"), (1, 2, 0, "older")]
MERGED = [(1, 1, 2, "a2"), (1, 2, 1, "b"), (1, 3, 1, "d"), (2, 1, 1, "c"), (3, 1, 1, "e")]


def test_latest_wins_in_any_order_and_twice(spark, tmp_path):
    frames = [spark.createDataFrame(data, ROW) for data in (FIRST, SECOND)]
    for i, order in enumerate(itertools.permutations(frames)):
        store = store_at(tmp_path / str(i))
        for frame in (*order, order[0]):
            upsert(store, frame)
        assert rows(store.read(spark)) == MERGED


def test_only_touched_partitions_are_read(spark, tmp_path, plan_of):
    store = store_at(tmp_path / "s")
    upsert(store, spark.createDataFrame(FIRST, ROW))
    changes = spark.createDataFrame([(2, 1, 9, "x")], ROW)
    touched = upsert_module._touched(store.read(spark), changes, ["p"])
    assert rows(touched) == [(2, 1, 1, "c")]
    assert "PartitionFilters: [(p" in plan_of(touched)


def test_rows_of_the_null_partition_stay(spark, tmp_path):
    store = store_at(tmp_path / "s")
    upsert(store, spark.createDataFrame([(None, 1, 1, "a"), (1, 1, 1, "b")], ROW))
    upsert(store, spark.createDataFrame([(None, 3, 1, "c")], ROW))
    assert rows(store.read(spark)) == [(1, 1, 1, "b"), (None, 1, 1, "a"), (None, 3, 1, "c")]


def test_many_partitions_are_touched(spark, tmp_path):
    store = store_at(tmp_path / "s")
    many = spark.range(300).select(F.col("id").cast("int").alias("p"), F.lit(1).alias("k"), F.lit(1).alias("at"), F.lit("a").alias("v"))
    upsert(store, many)
    upsert(store, many.withColumns({"k": F.lit(2)}))
    assert store.read(spark).count() == 600


def test_an_empty_partition_text_is_refused(spark, tmp_path):
    text = T.StructType().add("p", "string").add("k", "integer").add("v", "string")
    store = KeyedStore(str(tmp_path / "s"), text, ["p", "k"], ["v"], ["p"])
    upsert(store, spark.createDataFrame([("x", 1, "a")], text))
    with pytest.raises(Exception, match="empty text in partition column p"):
        upsert(store, spark.createDataFrame([("", 1, "b")], text))
    assert rows(store.read(spark)) == [("x", 1, "a")]


def test_repeated_attempt_after_a_crash_loses_nothing(spark, tmp_path, monkeypatch):
    store = store_at(tmp_path / "s")
    upsert(store, spark.createDataFrame(FIRST, ROW))
    changes, stage = spark.createDataFrame(SECOND, ROW), str(tmp_path / "stage")

    def dies(staged, path, partition_by, is_clustered):
        # Half of the replacement: partition 1 has lost its stored rows.
        replace_partitions(staged.where("p = 1 and k = 3"), path, partition_by)
        raise RuntimeError("lost")

    monkeypatch.setattr(upsert_module, "replace_partitions", dies)
    with pytest.raises(RuntimeError):
        upsert(store, changes, stage)
    monkeypatch.undo()
    upsert(store, changes, stage)
    assert rows(store.read(spark)) == MERGED


def test_partition_must_be_part_of_the_key(tmp_path):
    with pytest.raises(ValueError):
        KeyedStore(str(tmp_path), ROW, ["k"], ["at"], ["p"])


def document(**areas):
    """area=[(year, period, value), ...]"""
    return json.dumps(
        {
            "Results": {
                "series": [
                    {
                        "catalog": {"area": area},
                        "data": [dict(zip(("year", "period", "value"), figure)) for figure in data],
                    }
                    for area, data in areas.items()
                ]
            }
        }
    )


def deliver(landing, month, name, *documents):
    folder = landing / f"ingest_month={month}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(documents) + "\n")


def test_employment_ingest(spark, tmp_path):
    landing = tmp_path / "landing"
    store = employment_store(str(tmp_path / "store"))

    def run():
        ingest_available(
            spark, str(landing), DELIVERY, deliveries, store, str(tmp_path / "progress"),
            max_files=1, glob="*.json",
        )
        return rows(store.read(spark).select("state", "year", "month", "people_employed"))

    deliver(landing, "201911", "a.json", document(Ohio=[("2019", "M01", "2.0"), ("2019", "M02", "3")]))
    assert run() == [("Ohio", 2019, 1, 2000), ("Ohio", 2019, 2, 3000)]
    assert run() == [("Ohio", 2019, 1, 2000), ("Ohio", 2019, 2, 3000)]  # nothing new
    # A later delivery corrects January; an earlier month that comes late does not.
    deliver(landing, "201912", "b.json", document(Ohio=[("2019", "M01", "2.5"), ("2019", "M13", "9")]))
    deliver(landing, "201910", "c.json", document(Ohio=[("2019", "M01", "1.0"), ("2019", "M02", "1.0")], Iowa=[("2018", "M12", "-")]))
    stored = run()
    assert stored == [("Iowa", 2018, 12, None), ("Ohio", 2019, 1, 2500), ("Ohio", 2019, 2, 3000)]
    assert run() == stored
    assert not rows(spark.read.parquet(str(tmp_path / "store_rejects")))
    deliver(landing, "202001", "d.json", document(**{"": [("20xx", "M01", "1.0")]}))
    assert run() == stored
    rejects = spark.read.parquet(str(tmp_path / "store_rejects"))
    assert rows(rejects.select("month", "reject_reason")) == [(1, "year is null")]
    deliver(landing, "202002", "e.json", '{"Results": {"ser', document(Utah=[("2020", "Mxx", "1")]))
    assert run() == stored
    rejects = spark.read.option("mergeSchema", True).parquet(str(tmp_path / "store_rejects"))
    assert rows(rejects.select("state", "unreadable", "reject_reason")) == [
        ("", None, "year is null"),
        ("Utah", None, "month is null"),
        (None, '{"Results": {"ser', "unreadable"),
    ]


def test_a_broken_line_is_not_stored_as_nulls(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text('{"p": 1, "k": 1, "at": 1, "v": "a"}\n{"p": 1, "k"\n')
    store = store_at(tmp_path / "store")
    ingest_available(spark, str(landing), ROW, lambda raw: raw.drop("_metadata"), store, str(tmp_path / "progress"))
    assert rows(store.read(spark)) == [(1, 1, 1, "a")]
    rejects = spark.read.parquet(str(tmp_path / "store_rejects"))
    assert rows(rejects.select("unreadable", "reject_reason")) == [('{"p": 1, "k"', "unreadable")]


def test_stream_ends_with_the_batch_table(spark, tmp_path):
    landing = tmp_path / "landing"
    store = employment_store(str(tmp_path / "store"))
    for month in ("202001", "202002", "202003"):
        deliver(
            landing, month, "x.json",
            document(**{f"S{i}": [("2020", f"M{m:02d}", f"{i}.{month[-1]}") for m in range(1, 14)] for i in range(5)}),
        )
        ingest_available(spark, str(landing), DELIVERY, deliveries, store, str(tmp_path / "progress"))
    batch = clean_employment(read_documents(spark, str(landing), DELIVERY), "ingest_month")
    last = batch.where("ingest_month = '202003'").select("state", "year", "month", "people_employed")
    assert rows(store.read(spark).select(*last.columns)) == rows(last)


def test_explode_undoes_nesting(spark):
    flat = spark.range(60).select(
        F.concat(F.lit("S"), (F.col("id") % 4).cast("string")).alias("state"),
        (2000 + F.col("id") % 5).cast("int").alias("year"),
        (F.col("id") % 12 + 1).cast("int").alias("month"),
        (F.col("id") * 1000).alias("people_employed"),
    )
    figure = F.struct(
        F.col("year").cast("string").alias("year"),
        F.concat(F.lit("M"), F.lpad(F.col("month").cast("string"), 2, "0")).alias("period"),
        (F.col("people_employed") / 1000).cast("string").alias("value"),
    )
    series = flat.groupBy("state").agg(F.collect_list(figure).alias("data")).select(
        F.struct(F.struct(F.col("state").alias("area")).alias("catalog"), "data").alias("s")
    )
    documents = series.select(F.struct(F.array("s").alias("series")).alias("Results"))
    assert rows(clean_employment(documents)) == rows(flat)
