"""The pipeline's stages on a small corpus, and every query against its twin."""

from __future__ import annotations

import compare
import corpus_pipeline
import pytest

from statewise.llm import queries
from statewise.llm.decontaminate import contamination
from statewise.llm.ngram_join import near_duplicates

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_result_as_sql(spark, name):
    ours = queries.QUERIES[name](spark, FOLDER).toPandas()
    theirs = compare.connect(FOLDER).sql(queries.SQL[name]).df()
    assert compare.difference(ours, theirs) == ""


def test_stages_take_effect(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "ngram_join", "benchmark", "mix"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], FOLDER))
    sizes = [frame.count() for frame in kept]
    assert sizes[0] > sizes[1] == sizes[2] >= sizes[3] >= sizes[4] == sizes[5] > 0
    assert all(frame.columns == docs.columns for frame in kept[:-1])
    assert near_duplicates(kept[4]).where("n_links > 0").count() == 0
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    assert contamination(kept[4], benchmark).where("contaminated").count() == 0
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, kept[5].collect()))


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == 0
