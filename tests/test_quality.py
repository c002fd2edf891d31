from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from statewise.operators.quality import (
    Check,
    QualityError,
    measure,
    measure_queries,
    null_checks,
    require,
    split_rejects,
)


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (None, None)], "n int, t string")


def test_checks_share_one_pass(frame, plan_of):
    report = measure(frame, null_checks(["n", "t"]), "frame")
    assert plan_of(report).count("Scan") == 1
    assert [(r.check_name, r.actual, r.passed) for r in report.collect()] == [
        ("n is null", 1, False),
        ("t is null", 2, False),
    ]


def test_require_names_the_failures(frame):
    with pytest.raises(QualityError, match="n is null: 1, expected 0"):
        require(measure(frame, null_checks(["n"])))
    require(measure(frame, null_checks(["n"], severity="warning")))
    require(measure(frame, [Check("two or more", F.col("n") >= 2, expected=1)]))


def test_query_checks(spark, frame):
    frame.createOrReplaceTempView("checked")
    queries = {"select count(*) from checked where n is null": 1, "select max(n) from checked": 2}
    report = measure_queries(spark, queries)
    require(report, n_checks=2)
    with pytest.raises(QualityError, match="expected 5"):
        require(measure_queries(spark, {"select max(n) from checked": 5}))
    for expected in (0, None):
        with pytest.raises(QualityError, match="n > 9"):
            require(measure_queries(spark, {"select n from checked where n > 9": expected}))


def test_good_and_rejected_make_the_input(spark, frame):
    good, rejected = split_rejects(frame, ["t"], {"n too small": F.col("n") > 0})
    assert rows(good) == [(1, "a")]
    assert rows(rejected) == [(2, None, "t is null"), (None, None, "t is null, n too small")]
    assert good.columns == frame.columns
    assert good.count() + rejected.count() == frame.count()
