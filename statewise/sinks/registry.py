"""Lasting surrogate keys: a registry of natural keys and their numbers.

A key keeps its number whatever is loaded later. Only keys that the registry
does not hold are numbered. Their numbers come from blocks, each taken by
creating a file that must not exist yet, so two loads at once never use one
block. A load that dies leaves a gap, never a number used twice.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewise.operators.ordering import number_rows
from statewise.workspace import _located, folder_exists, settle

BLOCK = 1_000_000


@dataclass(frozen=True)
class KeyRegistry:
    """A Parquet folder of the natural keys ``keys`` with their number ``name``.

    Numbers start at 1; each load takes whole blocks of ``block`` numbers.
    """

    path: str
    keys: T.StructType
    name: str = "id"
    block: int = BLOCK

    def read(self, spark: SparkSession) -> DataFrame:
        """One row per key. Of two loads that numbered a key at once, the lower holds."""
        schema = T.StructType([*self.keys.fields, T.StructField(self.name, T.LongType())])
        rows = f"{self.path}/rows"
        if not folder_exists(spark, rows):
            return spark.createDataFrame([], schema)
        stored = spark.read.schema(schema).parquet(rows)
        return stored.groupBy(*self.keys.fieldNames()).agg(F.min(self.name).alias(self.name))


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]):
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[f"_{n}"]) for n in names])


def _renamed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({name: f"_{name}" for name in names})


def _created(spark: SparkSession, path: str) -> bool:
    """Whether this call made the file, in one step of the store.

    The store must refuse to create a file that is there, as HDFS does. Hadoop's
    own local file system looks first and creates then, which two loads can do at once.
    """
    place, files = _located(spark, path)
    try:
        if files.getUri().getScheme() == "file":
            open(place.toUri().getPath(), "x").close()
        else:
            files.create(place, False).close()
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def take_blocks(spark: SparkSession, registry: KeyRegistry, n: int) -> list[int]:
    """Numbers of ``n`` blocks that no other load has or will get."""
    folder, files = _located(spark, f"{registry.path}/blocks")
    files.mkdirs(folder)
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    taken = [int(found[1]) for name in names if (found := re.fullmatch(r"block-(\d+)", name))]
    following = max(taken, default=-1) + 1
    ours: list[int] = []
    while len(ours) < n:
        if _created(spark, f"{registry.path}/blocks/block-{following}"):
            ours.append(following)
        following += 1
    return ours


def register(registry: KeyRegistry, rows: DataFrame, order: Sequence | None = None) -> int:
    """Number the keys of ``rows`` that are new, in ``order``; gives how many.

    NULL is a value of a key like any other. What is stored is never rewritten.
    Only the number of new keys and the blocks' numbers reach the driver.
    """
    spark = rows.sparkSession
    names = registry.keys.fieldNames()
    wanted = rows.select(*[F.col(f.name).cast(f.dataType) for f in registry.keys.fields]).distinct()
    stored = _renamed(registry.read(spark).select(*names), names)
    new = settle(wanted.join(stored, _same(wanted, stored, names), "left_anti"), "new_keys")
    n_new = new.count()
    if not n_new:
        return 0
    blocks = take_blocks(spark, registry, -(-n_new // registry.block))
    numbered = number_rows(new, order or names, "_n")
    at = F.col("_n") - 1
    starts = F.array(*[F.lit(block * registry.block).cast("bigint") for block in blocks])
    start = F.element_at(starts, (F.floor(at / registry.block) + 1).cast("int"))
    number = (start + at % registry.block + 1).cast("bigint").alias(registry.name)
    # One committed job: a load that dies appends nothing.
    settle(numbered.select(*names, number), "numbered").write.mode("append").parquet(
        f"{registry.path}/rows"
    )
    return n_new


def with_registered(registry: KeyRegistry, rows: DataFrame, order: Sequence | None = None) -> DataFrame:
    """``rows`` with the lasting number of their key; new keys are registered first."""
    register(registry, rows, order)
    names = registry.keys.fieldNames()
    stored = _renamed(settle(registry.read(rows.sparkSession), "registry"), names)
    joined = rows.join(stored, _same(rows, stored, names), "left")
    return joined.select(registry.name, *rows.columns)
