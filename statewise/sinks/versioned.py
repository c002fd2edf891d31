"""Upserts that no reader sees half-done, and that rewrite only what changes.

Readers query a view. Behind it stands a table whose partitions lie in folders
of several versions: an upsert writes the changed partitions into new folders,
declares a further table over old and new folders, and swaps the view to it,
one step of the catalog. A query that began before goes on reading the old
folders; ``remove_old_versions`` deletes them later.

Each partition is kept with its number of rows and a fingerprint, the sum of its
rows' hashes, which no order changes. A delivery that repeats what is stored
gives the same fingerprints, and nothing is written.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewise.operators.latest import latest_by_key
from statewise.sinks.files import clustered, no_empty_partition
from statewise.workspace import _located, discard, folder_is_complete, scratch, settle

#: Partitions declared by one statement.
DECLARED = 200
STAGE = "stage"
_FINGERPRINT = "decimal(38,0)"


@dataclass(frozen=True)
class VersionedStore:
    """At most one row per key; ``name`` is the view that readers query.

    ``partition_by`` must be part of ``keys``. ``order`` decides which row of a
    key is the latest. All folders lie below ``path``.
    """

    name: str
    path: str
    schema: T.StructType
    keys: Sequence[str]
    order: Sequence[str]
    partition_by: Sequence[str]

    def __post_init__(self) -> None:
        astray = set(self.partition_by) - set(self.keys)
        if astray:
            raise ValueError(f"partition column {sorted(astray)} is not part of the key")

    def read(self, spark: SparkSession) -> DataFrame:
        if not spark.catalog.tableExists(self.name):
            return spark.createDataFrame([], self.schema)
        return spark.table(self.name).select(*self.schema.fieldNames())


@dataclass(frozen=True)
class Published:
    """What an upsert did: the version that holds now, partitions touched and rewritten."""

    version: int
    touched: int
    rewritten: int


def current_version(store: VersionedStore, spark: SparkSession) -> int:
    """Number of the published version, 0 where there is none."""
    if not spark.catalog.tableExists(store.name):
        return 0
    found = spark.sql(f"SHOW TBLPROPERTIES {store.name}('version')").first()
    return int(found["value"])


def _map_path(store: VersionedStore, version: int) -> str:
    return f"{store.path}/versions/{version}"


def _map_schema(store: VersionedStore) -> T.StructType:
    fields = [store.schema[name] for name in store.partition_by]
    fields = [T.StructField(field.name, field.dataType) for field in fields]
    rest = T.StructType.fromDDL(f"_folder string, _rows bigint, _fingerprint {_FINGERPRINT}")
    return T.StructType([*fields, *rest.fields])


def partition_map(store: VersionedStore, spark: SparkSession) -> DataFrame:
    """Folder, rows and fingerprint of each partition of the published version."""
    version = current_version(store, spark)
    if not version:
        return spark.createDataFrame([], _map_schema(store))
    return spark.read.schema(_map_schema(store)).parquet(_map_path(store, version))


def _equal(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[name].eqNullSafe(right[name]) for name in names])


def fingerprints(rows: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Per partition ``_rows`` and ``_fingerprint``, whatever the order of its rows."""
    row_hash = F.xxhash64(*rows.columns).cast(_FINGERPRINT)
    return rows.groupBy(*partition_by).agg(
        F.count("*").alias("_rows"), F.sum(row_hash).cast(_FINGERPRINT).alias("_fingerprint")
    )


def _read_folders(store: VersionedStore, spark: SparkSession, folders: DataFrame) -> DataFrame:
    """Rows of the partitions in ``folders``.

    Their list is that which the planner makes of any partitioned scan.
    """
    found = [row["_folder"] for row in folders.select("_folder").collect()]
    if not found:
        return spark.createDataFrame([], store.schema)
    schema = T.StructType([*store.schema.fields, T.StructField(STAGE, T.StringType())])
    base = _qualified(spark, f"{store.path}/data")
    rows = spark.read.schema(schema).option("basePath", base).parquet(*found)
    return rows.select(*store.schema.fieldNames())


def _partition_folder(store: VersionedStore, stage: str) -> Column:
    """The folder that a partitioned write below ``stage`` gives a partition."""
    parts = [F.lit(stage)]
    for name in store.partition_by:
        # Texts that Spark would escape here are refused, see below.
        value = F.coalesce(F.col(name).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
        parts.append(F.concat(F.lit(f"{name}="), value))
    return F.concat_ws("/", *parts)


def _plain_partitions(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """``df``, failing the write when a partition's text cannot be a folder's name."""
    texts = [name for name in partition_by if isinstance(df.schema[name].dataType, T.StringType)]
    message = F.lit("a partition column holds a text that is no folder's name")
    return df.withColumns(
        {
            name: F.when(F.col(name).rlike(r'["#%\'*/:=?\\\x00-\x1F\x7F{\[\]^]'), F.raise_error(message))
            .otherwise(F.col(name))
            for name in texts
        }
    )


def _literal(value: object) -> str:
    if value is None:
        return "null"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _declare(store: VersionedStore, spark: SparkSession, version: int) -> None:
    """The table of a version: its partitions at the folders of the map."""
    table = f"{store.name}_v{version}"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in store.schema.fields)
    layout = ", ".join(f"`{name}`" for name in store.partition_by)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({layout}) "
        f"LOCATION '{store.path}/tables/{version}'"
    )
    found = spark.read.schema(_map_schema(store)).parquet(_map_path(store, version)).collect()
    for start in range(0, len(found), DECLARED):
        parts = []
        for row in found[start : start + DECLARED]:
            spec = ", ".join(f"`{name}` = {_literal(row[name])}" for name in store.partition_by)
            parts.append(f"PARTITION ({spec}) LOCATION '{row['_folder']}'")
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(parts)}")


def _publish(store: VersionedStore, spark: SparkSession, version: int) -> None:
    """Swap the view to a version: one step of the catalog."""
    columns = ", ".join(f"`{name}`" for name in store.schema.fieldNames())
    spark.sql(
        f"CREATE OR REPLACE VIEW {store.name} TBLPROPERTIES ('version' = '{version}') "
        f"AS SELECT {columns} FROM {store.name}_v{version}"
    )


def _qualified(spark: SparkSession, path: str) -> str:
    location, files = _located(spark, path)
    return files.makeQualified(location).toString()


def upsert_versioned(
    store: VersionedStore, changes: DataFrame, stage: str | None = None
) -> Published:
    """Bring ``changes`` into the store and publish them at once; ``stage`` is a name.

    Readers see all rows of before or all of after. A partition whose merged
    rows are those stored keeps its folder; with no other, nothing is written
    and no version made. Until the view is swapped an attempt that dies changes
    nothing that is read, and may be repeated; with the same ``stage`` what it
    had written is used again. One writer at a time.
    """
    spark = changes.sparkSession
    partition_by = list(store.partition_by)
    stage = _qualified(spark, f"{store.path}/data/{STAGE}={stage or uuid.uuid4().hex}")
    held_version = current_version(store, spark)
    with scratch(spark):
        held = settle(partition_map(store, spark), "map")
        changes = _plain_partitions(changes.select(*store.schema.fieldNames()), partition_by)
        changes = settle(latest_by_key(changes, store.keys, store.order), "changes")
        touched = settle(changes.select(*partition_by).distinct(), "touched")
        stored_parts = held.join(F.broadcast(touched), _equal(held, touched, partition_by), "left_semi")
        stored = _read_folders(store, spark, stored_parts)
        merged = latest_by_key(stored.unionByName(changes), store.keys, store.order)

        found = settle(fingerprints(merged, partition_by), "fingerprints")
        same = _equal(found, held, [*partition_by, "_rows", "_fingerprint"])
        altered = settle(found.join(held, same, "left_anti"), "altered")
        n_touched, n_altered = touched.count(), altered.count()
        if not n_altered:
            return Published(held_version, n_touched, 0)

        if not folder_is_complete(spark, stage):
            wanted = altered.select(*partition_by)
            rows = merged.join(F.broadcast(wanted), _equal(merged, wanted, partition_by), "left_semi")
            rows = no_empty_partition(rows, partition_by)
            clustered(rows, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(stage)
        version = held_version + 1
        kept = held.join(F.broadcast(altered), _equal(held, altered, partition_by), "left_anti")
        new = altered.withColumn("_folder", _partition_folder(store, stage)).select(*held.columns)
        kept.unionByName(new).coalesce(1).write.mode("overwrite").parquet(_map_path(store, version))
    _declare(store, spark, version)
    _publish(store, spark, version)
    return Published(version, n_touched, n_altered)


def remove_old_versions(store: VersionedStore, spark: SparkSession, keep: int = 1) -> int:
    """Drop all but the last ``keep`` versions and the folders only they use; gives
    how many folders were deleted. Call it when no query of before is running."""
    last = current_version(store, spark)
    alive: set[str] = set()
    dead: set[str] = set()
    for version in range(1, last + 1):
        path = _map_path(store, version)
        if not folder_is_complete(spark, path):
            continue
        rows = spark.read.schema(_map_schema(store)).parquet(path).select("_folder").collect()
        folders = {row["_folder"] for row in rows}
        if version > last - keep:
            alive |= folders
        else:
            dead |= folders
            spark.sql(f"DROP TABLE IF EXISTS {store.name}_v{version}")
            discard(spark, path)
    for folder in sorted(dead - alive):
        discard(spark, folder)
    return len(dead - alive)
