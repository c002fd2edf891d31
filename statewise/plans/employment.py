"""Employment: nested monthly documents -> people employed per state and month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewise import schemas
from statewise.functions.periods import is_calendar_month, month_of_period
from statewise.functions.values import people_from_thousands, series_id
from statewise.operators.nested import flatten_series
from statewise.sinks.upsert import KeyedStore
from statewise.sources.files import MONTH_COLUMN, UNREADABLE

ARRIVED = "arrived_at"

# Raw documents in month folders, and the store that remembers which month's
# delivery a figure came from: every delivery repeats the whole year.
DELIVERY = T.StructType(
    [*schemas.EMPLOYMENT_DOCUMENT.fields, T.StructField(MONTH_COLUMN, T.StringType())]
)
STORED = T.StructType(
    [
        *schemas.FACT_EMPLOYMENT.fields,
        T.StructField(MONTH_COLUMN, T.StringType()),
        T.StructField(ARRIVED, T.TimestampType()),
    ]
)


def clean_employment(
    documents: DataFrame, *keep: str, whole_thousands: bool = False
) -> DataFrame:
    """(*keep, state, year, month, people_employed), a row per figure.

    Only the annual average is dropped. Any other period that is not a calendar
    month has a NULL month, for the quality gate to reject.
    """
    month = month_of_period(F.col("period"))
    return (
        flatten_series(documents, *keep)
        .where(~F.col("period").eqNullSafe(schemas.ANNUAL_PERIOD))
        .select(
            *keep,
            "state",
            F.col("year").try_cast("int").alias("year"),
            F.when(is_calendar_month(month), month).alias("month"),
            people_from_thousands(F.col("value"), whole_thousands).alias("people_employed"),
        )
    )


def employment_rows(documents: DataFrame) -> DataFrame:
    """``clean_employment`` with a row of NULLs and its text for every document
    that could not be read, where ``documents`` keeps that text."""
    keep = [UNREADABLE] if UNREADABLE in documents.columns else []
    return clean_employment(documents, *keep)


def deliveries(documents: DataFrame) -> DataFrame:
    """Rows for the employment store from documents in month folders."""
    arrived = documents.select(
        "*", F.col("_metadata.file_modification_time").alias(ARRIVED)
    )
    return clean_employment(arrived, MONTH_COLUMN, ARRIVED)


def employment_store(path: str) -> KeyedStore:
    """Latest delivery wins; of two in one month, the file that came last.

    Kept by year, which is just what one delivery repeats.
    """
    return KeyedStore(
        path=path,
        schema=STORED,
        keys=schemas.KEYS["fact_employment"],
        order=(MONTH_COLUMN, ARRIVED, "people_employed"),
        partition_by=("year",),
    )


def wanted_series(state_codes: DataFrame, code: str = "state_code") -> DataFrame:
    """Identifier of the series to ask for, per state code."""
    return state_codes.select(code, series_id(F.col(code)).alias("series_id"))
