"""Raw file scans: header CSV, nested JSON, month-addressed folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewise import schemas

MONTH_COLUMN = "ingest_month"
UNREADABLE = "unreadable"  # text of a document or line that does not parse


def under(base: str, *parts: str) -> str:
    """Path of a dataset below a base folder or URI."""
    return "/".join([base.rstrip("/"), *[part.strip("/") for part in parts]])


def read_header_csv(
    spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """Text columns of a CSV with a header, found by name; empty is NULL.

    Every file must carry the same header. Other columns of the file are not
    parsed. ``multi_line`` allows line breaks inside quotes at the price of one
    task per file.
    """
    rows = spark.read.csv(
        path,
        header=True,
        enforceSchema=False,
        escape='"',
        multiLine=multi_line,
        mode="PERMISSIVE",
    )
    missing = [name for name in columns if name not in rows.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    return rows.select(*columns)


def read_typed_csv(
    spark: SparkSession, path: str, schema: T.StructType, corrupt: str | None = None
) -> DataFrame:
    """CSV whose columns are in the order of ``schema``, parsed to its types.

    ``corrupt`` names a column that keeps the text of lines that do not fit.
    """
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    return spark.read.schema(schema).csv(
        path,
        header=True,
        escape='"',
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=corrupt or "_corrupt",
    )


def read_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.EMPLOYMENT_DOCUMENT,
    multi_line: bool = False,
    keep_unreadable: bool = False,
) -> DataFrame:
    """JSON documents, one per line unless ``multi_line``.

    The schema is declared: an empty month keeps its columns, and the data are
    read once, not twice. With ``keep_unreadable`` the column ``unreadable`` has
    the text of each document that is not JSON, for the rejects.
    """
    if keep_unreadable:
        schema = T.StructType([*schema.fields, T.StructField(UNREADABLE, T.StringType())])
    return spark.read.schema(schema).json(
        path, multiLine=multi_line, columnNameOfCorruptRecord=UNREADABLE
    )


def month_file(base: str, dataset: str, year: int, month: int) -> str:
    """``base/dataset/yyyymm/dataset<yyyymm>.json``"""
    key = f"{year}{month:02d}"
    return under(base, dataset, key, f"{dataset}{key}.json")


def read_months(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    first: str,
    last: str | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """Months ``first`` to ``last`` (``yyyyMM``) of a month-partitioned folder.

    The months become a partition filter: folders of other months are not read.
    """
    if MONTH_COLUMN not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(MONTH_COLUMN, T.StringType())])
    rows = spark.read.schema(schema).format(file_format).load(root)
    return rows.where(F.col(MONTH_COLUMN).between(first, last or first))
