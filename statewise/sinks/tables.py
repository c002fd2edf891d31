"""Warehouse tables: definition, column-list loads, layout."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewise import schemas
from statewise.operators.ordering import number_rows
from statewise.operators.quality import QualityError
from statewise.sources.files import UNREADABLE
from statewise.workspace import settle

# How each fact table is laid out: the columns most queries select by.
PARTITIONS = {"dim_cities": (), "fact_weather": ("state",), "fact_employment": ("year",)}
SORTING = {"dim_cities": (), "fact_weather": ("date",), "fact_employment": ("month",)}

# A total order of places, so that numbering does not depend on the input order.
PLACE_ORDER = ("state", "city", "latitude", "longitude", "population", "density")


def create_tables(
    spark: SparkSession, location: str, names: Iterable[str] = tuple(schemas.TABLES)
) -> None:
    """Create the star schema's tables below ``location`` where absent."""
    for name in names:
        columns = ", ".join(
            f"`{field.name}` {field.dataType.simpleString()}"
            for field in schemas.TABLES[name].fields
        )
        layout = ", ".join(PARTITIONS[name])
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
            + (f" PARTITIONED BY ({layout})" if layout else "")
            + f" LOCATION '{location.rstrip('/')}/{name}'"
        )


def drop_tables(
    spark: SparkSession, names: Iterable[str] = tuple(schemas.TABLES)
) -> None:
    """Drop the tables where present. Files at their location stay."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def arranged(
    rows: DataFrame, columns: Sequence[str], target: T.StructType
) -> DataFrame:
    """Rows given in file order, as rows of the target table.

    ``columns`` names the table column of each file column, in file order. The
    table's types are applied; table columns not listed are NULL.
    """
    if len(columns) != len(rows.columns):
        raise ValueError(f"{len(rows.columns)} columns given, {len(columns)} listed")
    unknown = set(columns) - set(target.fieldNames())
    if unknown:
        raise ValueError(f"not in the table: {', '.join(sorted(unknown))}")
    named = rows.toDF(*columns)
    return named.select(
        *[
            (F.col(field.name).try_cast(field.dataType) if field.name in columns
             else F.lit(None).cast(field.dataType)).alias(field.name)
            for field in target.fields
        ]
    )


def _read_text(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A headed CSV file as text, with ``unreadable`` for lines of another length."""
    text = [T.StructField(name, T.StringType()) for name in (*columns, UNREADABLE)]
    return spark.read.schema(T.StructType(text)).csv(
        path, header=True, escape='"', columnNameOfCorruptRecord=UNREADABLE
    )


def _misfits(rows: DataFrame, columns: Sequence[str], target: T.StructType) -> dict[str, int]:
    """Numbers of lines and fields that do not fit the target, by what is wrong."""
    found = {"lines with another number of fields": F.col(UNREADABLE).isNotNull()}
    for name in columns:
        cast = F.col(name).try_cast(target[name].dataType)
        found[f"{name} unfit"] = F.col(name).isNotNull() & cast.isNull()
    counts = rows.agg(*[F.count_if(wrong).alias(name) for name, wrong in found.items()]).first()
    return {name: n for name, n in counts.asDict().items() if n}


def read_load_file(
    spark: SparkSession, path: str, columns: Sequence[str], target: T.StructType
) -> DataFrame:
    """A headed CSV file in the order of ``columns``, as rows of the target.

    Refused as a whole when a line has another number of fields or a text does
    not fit the type of its column; the error says how many.
    """
    rows = settle(_read_text(spark, path, columns), "load")
    wrong = _misfits(rows, columns, target)
    if wrong:
        said = ", ".join(f"{name}: {n}" for name, n in wrong.items())
        raise QualityError(f"{path} does not fit: {said}")
    return arranged(rows.drop(UNREADABLE), columns, target)


def insert(spark: SparkSession, table: str, rows: DataFrame, overwrite: bool = False) -> None:
    """Insert by column *name*.

    A table keeps its partition columns last, so inserting by position would
    silently put values into the wrong columns.
    """
    rows.select(*spark.table(table).columns).write.insertInto(table, overwrite=overwrite)


def load_file(
    spark: SparkSession, table: str, path: str, columns: Sequence[str] | None = None
) -> None:
    """Append a processed CSV file to a table of the star schema.

    The whole load is refused when a line or a text does not fit, or when a
    required column has a NULL. A missing key is numbered on.
    """
    target = schemas.TABLES[table]
    rows = settle(
        read_load_file(spark, path, columns or schemas.LOAD_ORDER[table], target), table
    )
    bad = rows.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in schemas.required_columns(table)]
    ).first()
    refused = [f"{name}: {n}" for name, n in bad.asDict().items() if n]
    if refused:
        raise QualityError(f"NULL in required columns of {path}: {', '.join(refused)}")
    if table == "dim_cities":
        last = spark.table(table).agg(F.max("city_id")).first()[0] or 0
        rows = number_rows(rows.drop("city_id"), PLACE_ORDER, "city_id", after=last)
    insert(spark, table, rows)


def save_bucketed(
    df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int,
    sort_by: Sequence[str] = (),
) -> None:
    """Save as an external table hashed into buckets by ``keys``.

    Two tables bucketed alike join without a shuffle. A bucket is read by one
    task: use it for keys without very frequent values, else partition.
    """
    # Each bucket in one task first: otherwise every task writes into every bucket.
    writer = df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).format("parquet")
    writer = writer.bucketBy(buckets, *keys)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    writer.saveAsTable(table)
