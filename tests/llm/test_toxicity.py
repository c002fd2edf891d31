from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_cases import documents, prose  # noqa: F401

from statewise.llm.toxicity import choose_features, design, score_toxicity, text_features, train


@pytest.fixture
def case(spark, documents, prose):
    generator = random.Random(3)
    data, labels = [], []
    for i in range(800):
        words = prose(i, 60).split()
        toxic = i % 8 == 0
        if toxic:
            for _ in range(3):
                words.insert(generator.randrange(60), generator.choice(["vilest", "uglyx", "uglyz"]))
        data.append((i, " ".join(words), "a"))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    return documents(data), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_accuracy(case):
    docs, labels = case
    found = {r.doc_id: r for r in score_toxicity(docs, labels).collect()}
    assert len(found) == 800 and all(found[i].held_out == held_out(i) for i in found)
    wrong = [i for i, r in found.items() if held_out(i) and (r.predicted == 1) != (i % 8 == 0)]
    assert len(wrong) <= 2
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found.values())


def test_labels_of_the_held_out_fold_change_nothing(case):
    docs, labels = case
    turned = labels.withColumn(
        "toxic",
        F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")),
    )
    one, other = ({r.doc_id: r.score for r in score_toxicity(docs, x).collect()} for x in (labels, turned))
    assert one == other


def test_negative_risk_is_corrected():
    # Positives that the unlabelled rows hold none of: the plain estimate would fall below 0.
    generator = np.random.default_rng(1)
    positives = np.c_[np.ones((50, 1)), generator.integers(0, 2, (50, 20)), np.ones((50, 1))]
    unlabelled = np.c_[np.zeros((400, 1)), generator.integers(0, 2, (400, 20)), np.ones((400, 1))]
    weights = train(positives, unlabelled, 0.3)
    negative = np.logaddexp(0, unlabelled @ weights).mean() - 0.3 * np.logaddexp(0, positives @ weights).mean()
    assert np.isfinite(weights).all() and negative > -0.2
    assert (positives @ weights > 0).mean() > 0.9


def test_features():
    assert text_features(b"") == [] and text_features(b"Word word") == text_features(b"word")
    rows = [[1, 2], [1, 3], [1]] * 5, [[2], [3], [4], [4]] * 5
    assert choose_features(*rows) == [1]
    assert design([[1, 9], [2]], [1, 2]).tolist() == [[1, 0, 1], [0, 1, 1]]


def test_edges(spark, documents, case):
    _, labels = case
    odd = documents([(1, None, None), (1, "", "a"), (None, "word", "a"), (2, "x " * 50_000, "a")])
    found = score_toxicity(odd, labels).collect()
    assert len(found) == 4 and len({r.score for r in found}) == 1
    none = score_toxicity(odd, labels.limit(0)).collect()
    assert [r.score for r in none] == [0.0] * 4
    missing = labels.select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("int").alias("toxic"))
    assert score_toxicity(odd.limit(0), missing).count() == 0
