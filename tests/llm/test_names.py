"""Columns of documents may have any name, those that a stage uses itself included."""

from __future__ import annotations

import pytest
from corpus_cases import documents, prose  # noqa: F401
from pyspark.sql import functions as F

from statewise.llm.decontaminate import decontaminate
from statewise.llm.line_spread import remove_shared_lines
from statewise.llm.ngram_join import keep_one_of_each

INTERNAL = (
    "_key _bytes _removed _of_key _of_bytes _row _size _of_row _of_size __row _line at site line sites "
    "_chosen _row_key key node first least_node _hits _items __hits hits items _HITS_2"
).split()


@pytest.fixture
def named(documents, prose):
    texts = [f"{prose(i, 30)}\nshared line\n{prose(i + 50, 30)}" for i in range(12)]
    found = documents([(i, text, f"s{i}") for i, text in enumerate(texts)])
    return found.withColumns({name: F.concat(F.lit(f"{name} of "), F.col("doc_id")) for name in INTERNAL})


def test_no_stage_loses_a_column_or_fails_on_its_name(spark, named):
    bench = spark.createDataFrame([("b", "some words that no document has")], "item_id string, text string")
    stages = [remove_shared_lines, keep_one_of_each, lambda docs: decontaminate(docs, bench)]
    for stage in stages:
        found = stage(named).select(*named.columns)
        assert found.count() == 12
        for name in INTERNAL:
            assert found.where(F.col(name) == F.concat(F.lit(f"{name} of "), F.col("doc_id"))).count() == 12


def test_line_removal_takes_the_lines_and_no_others(named):
    found = remove_shared_lines(named)
    assert found.where("n_removed = 1 and n_lines = 3 and size(split(text, '\\n')) = 2").count() == 12
    assert found.where("text like '%shared line%'").count() == 0
