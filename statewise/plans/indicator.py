"""One declaration per data source: transform, key, required columns, layout."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewise import schemas
from statewise.operators.latest import latest_by_key, repeated_keys
from statewise.operators.ordering import number_rows
from statewise.operators.quality import (
    REASON,
    Check,
    measure,
    null_checks,
    require,
    with_reason,
)
from statewise.plans.employment import employment_rows
from statewise.plans.places import clean_places
from statewise.plans.weather import WHERE, clean_weather, weather_with_state
from statewise.sinks.files import write_partitioned
from statewise.sinks.tables import PARTITIONS, PLACE_ORDER, SORTING
from statewise.sources.files import UNREADABLE
from statewise.workspace import scratch, settle


@dataclass(frozen=True)
class Indicator:
    """How raw rows become a table.

    ``optional`` columns are counted when NULL but do not reject a row. With
    ``order`` the last row of each key in that order is kept. ``details`` are
    columns that only the rejects keep. With ``number`` the good rows get a
    surrogate key in the given total order.
    """

    table: str
    transform: Callable[[DataFrame], DataFrame]
    keys: Sequence[str]
    required: Sequence[str]
    optional: Sequence[str] = ()
    rules: Mapping[str, Column] = field(default_factory=dict)
    order: Sequence[str] = ()
    details: Sequence[str] = ()
    partition_by: Sequence[str] = ()
    sort_by: Sequence[str] = ()
    number: tuple[str, Sequence[str]] | None = None


@dataclass(frozen=True)
class Loaded:
    rows: DataFrame
    rejects: DataFrame
    report: DataFrame


def _input_report(indicator: Indicator, marked: DataFrame) -> DataFrame:
    """What the gate found, before it removed anything: warnings."""
    checks = [
        *null_checks(indicator.required, severity="warning"),
        Check("rejected rows", F.col(REASON) != "", severity="warning"),
    ]
    return measure(marked, checks, f"{indicator.table} input")


def _table_report(indicator: Indicator, rows: DataFrame) -> DataFrame:
    """What must hold of the table."""
    checks = [
        *null_checks(indicator.required),
        *null_checks(indicator.optional, severity="warning"),
    ]
    once = Check("repeated keys", F.lit(True), severity="failure" if indicator.order else "warning")
    return measure(rows, checks, indicator.table).unionByName(
        measure(repeated_keys(rows, indicator.keys), [once], indicator.table)
    )


def prepare(indicator: Indicator, raw: DataFrame) -> Loaded:
    """Transform, gate and check. The transform runs once; its marked rows are
    written, and everything after reads that."""
    shaped = indicator.transform(raw)
    rules = dict(indicator.rules)
    for name in indicator.partition_by:
        if isinstance(shaped.schema[name].dataType, T.StringType):
            rules[f"{name} is empty"] = ~F.col(name).eqNullSafe("")
    marked = settle(with_reason(shaped, indicator.required, rules), indicator.table)
    details = [name for name in indicator.details if name in marked.columns]
    good = marked.where(F.col(REASON) == "").drop(REASON, *details)
    rejects = marked.where(F.col(REASON) != "")
    if indicator.order:
        good = settle(latest_by_key(good, indicator.keys, indicator.order), "latest")
    if indicator.number:
        name, order = indicator.number
        good = number_rows(good, order, name)
    report = _input_report(indicator, marked).unionByName(_table_report(indicator, good))
    return Loaded(good, rejects, report)


def load(indicator: Indicator, raw: DataFrame, root: str) -> Loaded:
    """Replace the table and its rejects below ``root`` and check what was written.

    Raises when a check of the written table fails. The frames given back read
    the target; intermediates are deleted.
    """
    spark = raw.sparkSession
    path = f"{root.rstrip('/')}/{indicator.table}"
    with scratch(spark):
        loaded = prepare(indicator, raw)
        if indicator.partition_by:
            write_partitioned(loaded.rows, path, indicator.partition_by, indicator.sort_by)
        else:
            loaded.rows.write.mode("overwrite").parquet(path)
        loaded.rejects.write.mode("overwrite").parquet(f"{path}_rejects")
        # Partition folders are read by the declared types, not guessed ones.
        rows = spark.read.schema(loaded.rows.schema).parquet(path).select(*loaded.rows.columns)
        rejects = spark.read.schema(loaded.rejects.schema).parquet(f"{path}_rejects")
        found_in_input = loaded.report.where(F.col("relation") != indicator.table)
        report = found_in_input.unionByName(_table_report(indicator, rows))
        report = spark.createDataFrame(report.collect(), report.schema)  # a row per check
    require(report)
    return Loaded(rows, rejects, report)


def _standard(table: str, transform: Callable[[DataFrame], DataFrame], **more) -> Indicator:
    return Indicator(
        table=table,
        transform=transform,
        keys=schemas.KEYS[table],
        required=schemas.required_columns(table),
        partition_by=PARTITIONS[table],
        sort_by=SORTING[table],
        **more,
    )


def cities_indicator() -> Indicator:
    return _standard("dim_cities", clean_places, number=("city_id", PLACE_ORDER))


def employment_indicator(order: Sequence[str] = ("people_employed",)) -> Indicator:
    """A repeated (state, year, month) keeps the last row in ``order``: the one
    with a figure before one without, then the largest. Deliveries in month
    folders go through ``employment_store`` instead, where the latest wins.
    """
    return _standard(
        "fact_employment",
        employment_rows,
        optional=["people_employed"],
        order=order,
        details=[UNREADABLE],
    )


def weather_indicator(
    cities: DataFrame, stored: DataFrame | None = None, farthest_km: float | None = None
) -> Indicator:
    """Rejects keep their coordinates and the distance of the nearest city."""
    return _standard(
        "fact_weather",
        # Written first: the text is parsed once, and the search for distinct
        # coordinates reads two columns.
        lambda raw: weather_with_state(
            settle(clean_weather(raw), "cleaned"), cities, stored, farthest_km
        ),
        details=WHERE,
    )
