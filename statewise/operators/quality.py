"""Data-quality gates: checks as rows, and rejected rows with a reason."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REASON = "reject_reason"


class QualityError(ValueError):
    """A check did not give the expected result."""


@dataclass(frozen=True)
class Check:
    """``expected`` rows should satisfy ``condition``."""

    name: str
    condition: Column
    expected: int = 0
    severity: str = "failure"  # or "warning"


def null_checks(columns: Iterable[str], severity: str = "failure") -> list[Check]:
    return [
        Check(f"{column} is null", F.col(column).isNull(), severity=severity)
        for column in columns
    ]


def measure(df: DataFrame, checks: Sequence[Check], relation: str = "") -> DataFrame:
    """All checks of one relation in a single pass, one row per check."""
    counted = df.agg(
        *[
            F.count_if(check.condition).alias(f"c{i}")
            for i, check in enumerate(checks)
        ]
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(relation).alias("relation"),
                F.lit(check.name).alias("check_name"),
                F.col(f"c{i}").alias("actual"),
                F.lit(check.expected).cast("bigint").alias("expected"),
                (F.col(f"c{i}") == check.expected).alias("passed"),
                F.lit(check.severity).alias("severity"),
            )
            for i, check in enumerate(checks)
        ]
    )
    return counted.select(F.inline(lines))


def measure_queries(
    spark: SparkSession, expectations: Mapping[str, object]
) -> DataFrame:
    """First column of the first row of each SQL query against an expected value.

    A query without a row is a failed check, whatever it expects.
    """

    def line(query: str, expected: object) -> DataFrame:
        answer = spark.sql(query).limit(1)
        answer = answer.select(answer[answer.columns[0]].alias("actual"), F.lit(True).alias("given"))
        answer = spark.range(1).join(answer, F.lit(True), "left")
        actual = F.col("actual")
        return answer.select(
            F.lit(query).alias("check_name"),
            actual.cast("string").alias("actual"),
            F.lit(expected).cast("string").alias("expected"),
            (F.col("given").isNotNull() & actual.eqNullSafe(F.lit(expected))).alias("passed"),
        )

    lines = [line(query, expected) for query, expected in expectations.items()]
    return reduce(DataFrame.unionByName, lines)


def require(report: DataFrame, n_checks: int | None = None) -> None:
    """Raise when a check of the report failed, naming every failed check.

    ``n_checks`` also catches a query that gave no row at all.
    """
    lines = report.collect()  # one row per check
    failed = [
        f"{row.check_name}: {row.actual}, expected {row.expected}"
        for row in lines
        if not row.passed and getattr(row, "severity", "failure") == "failure"
    ]
    if n_checks is not None and len(lines) < n_checks:
        failed.append(f"{n_checks - len(lines)} check(s) gave no result")
    if failed:
        raise QualityError("; ".join(failed))


def with_reason(
    df: DataFrame, required: Sequence[str], rules: Mapping[str, Column] | None = None
) -> DataFrame:
    """Add the reject reason, '' for a good row.

    A row is bad when a required column is NULL or a rule is false or unknown.
    """
    reasons = [
        F.when(F.col(column).isNull(), F.lit(f"{column} is null"))
        for column in required
    ] + [
        F.when(~F.coalesce(rule, F.lit(False)), F.lit(name))
        for name, rule in (rules or {}).items()
    ]
    return df.withColumn(REASON, F.concat_ws(", ", *reasons))


def split_rejects(
    df: DataFrame, required: Sequence[str], rules: Mapping[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with reason); together they are the input."""
    marked = with_reason(df, required, rules)
    good = marked.where(F.col(REASON) == "").drop(REASON)
    return good, marked.where(F.col(REASON) != "")
