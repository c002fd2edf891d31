from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from statewise.llm import fixity
from statewise.llm.fixity import audit, audit_pages, merkle_levels

LEAF = "at long, hash string"


@pytest.fixture
def leaves(spark):
    return spark.range(500).select(
        (F.col("id") * 37).alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("hash")
    )


@pytest.mark.parametrize("width, fanout", [(64, 2), (100, 16), (10**6, 16), (1, 3)])
def test_faults_are_located(leaves, spark, width, fanout):
    replica = leaves.where("at <> 370").withColumn("hash", F.when(F.col("at").isin(0, 18463), "bad").otherwise(F.col("hash")))
    replica = replica.unionByName(spark.createDataFrame([(5, "new"), (99_999, None)], LEAF))
    expected = [(0, "changed"), (18463, "changed"), (370, "missing"), (5, "extra"), (99999, "extra")]
    assert rows(audit(leaves, replica, width, fanout)) == expected
    assert audit(leaves, leaves, width, fanout).count() == 0


def test_only_differing_branches_are_followed(leaves, monkeypatch):
    replica = leaves.withColumn("hash", F.when(F.col("at") == 370, "bad").otherwise(F.col("hash")))
    sizes = []

    def watched(df, label, settle=fixity.settle):
        df = settle(df, label)
        if label == "suspects":
            sizes.append(df.count())
        return df

    monkeypatch.setattr(fixity, "settle", watched)
    assert rows(audit(leaves, replica, 64, 4)) == [(370, "changed")]
    assert len(sizes) > 3 and set(sizes) == {1}


def test_tree_shape(leaves):
    levels = merkle_levels(leaves, 500 * 37, 100, 4)
    assert [level.count() for level in levels] == [500, 185, 47, 12, 3, 1]


def test_edges(spark, leaves):
    none = leaves.limit(0)
    assert audit(none, none).count() == 0
    assert audit(leaves, none).where("status = 'missing'").count() == 500
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None)], LEAF)
    assert audit(twice, twice.orderBy(F.desc("hash"))).count() == 0
    assert rows(audit(twice, spark.createDataFrame([(1, "a"), (2, "")], LEAF))) == [(1, "changed")]


def test_pages(spark):
    data = [(i, f"http://x/{i}", "é" * i, 1) for i in range(60)] + [(7, "http://x/7", "é" * 7, 1), (None, None, None, 1)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, offset int")
    pages = pages.withColumn("n_bytes", F.lit(0))
    damaged = F.when(F.col("page_id") == 50, "other").otherwise(F.col("html"))
    found = audit_pages(pages, damaged, F.coalesce(F.col("page_id") == 7, F.lit(False)))

    def size(i):
        return 66 + len(f"http://x/{i}") + len(str(2 * i)) + 2 * i + 8

    start = {i: sum(size(j) for j in range(i)) + (size(7) if i > 7 else 0) for i in range(60)}
    assert rows(found) == [
        (50, start[50], size(50), "changed"),
        (7, start[7], size(7), "missing"),
        (7, start[7] + size(7), size(7), "missing"),
    ]
