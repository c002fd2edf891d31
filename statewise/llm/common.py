"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statewise.workspace import settle

BATCH_BYTES = 16 * 2**20
WORD = "[^\\x20\\x09-\\x0D]+"
_LOCAL = 2**33  # monotonically_increasing_id counts partitions in units of this
_CONTINUES = bytes(range(0x80, 0xC0))


def map_batches(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with batches of bounded bytes, however long the texts are."""
    conf = df.sparkSession.conf
    _find_package(df.sparkSession.sparkContext)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(conf.get(name).rstrip("b")) > BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def _find_package(context) -> None:
    """Let workers look for this package where the driver has it.

    On a cluster it is installed or shipped as usual, and the path does nothing.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = [path for path in context.environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def unlike(columns: Sequence[str], *names: str) -> list[str]:
    """``names``, each with underscores before it until no column has that name."""
    taken = {column.lower() for column in columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        free.append(name)
    return free


def as_bytes(name: str = "text") -> Column:
    """Text as UTF-8 bytes, NULL as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def ascii_words(text: bytes) -> list[bytes]:
    """Maximal runs without the ASCII white space 0x20 and 0x09 to 0x0D."""
    return text.split()


def code_points(text: bytes) -> int:
    """Number of code points of UTF-8 bytes."""
    if text.isascii():
        return len(text)
    return len(text.translate(None, _CONTINUES))


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A fixed bijection of 64-bit values that scatters them (splitmix64)."""
    with np.errstate(over="ignore"):
        z = values.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


ROLL = np.uint64(0x5851F42D4C957F2D)


def rolling(tokens: np.ndarray, lengths: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(n, hash of each n-gram of the scattered ``tokens``), n rising.

    One hash is rolled on: that of n tokens is that of the first n - 1 times a
    constant plus the last token.
    """
    wanted = sorted(set(lengths))
    current = tokens.copy()
    n = 1
    with np.errstate(over="ignore"):
        for length in wanted:
            while n < length and len(current):
                current = current[:-1] * ROLL + tokens[n:]
                n += 1
            yield length, current if n == length else current[:0]


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Mask of the positions inside any run of ``n`` that begins in ``starts``."""
    inside = np.zeros(size, dtype=bool)
    for step in range(n):
        inside[starts + step] = True
    return inside


def running_total(
    df: DataFrame, order: Sequence, size: Column, name: str, group: str | None = None
) -> DataFrame:
    """Add ``name``: total of ``size`` up to and with each row, in the given order.

    With ``group`` every group has its own total. Rows are range-sorted and
    written, summed inside each sort partition, and one offset per sort
    partition and group is added; no group passes through one task. ``order``
    must begin with ``group`` where that is given.
    """
    keys = ["_part"] if group is None else [group, "_part"]
    ordered = settle(
        df.withColumn("_size", size)
        .orderBy(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "running",
    ).withColumn("_part", F.floor(F.col("_at") / _LOCAL))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    if group is not None:
        earlier = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = ordered.groupBy(*keys).agg(F.sum("_size").alias("_total"))
    offsets = offsets.select(
        *[F.col(key).alias(f"_of{key}") for key in keys],
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"),
    )
    local = W.partitionBy(*keys).orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    same = [F.col(key).eqNullSafe(F.col(f"_of{key}")) for key in keys]
    condition = same[0] if len(same) == 1 else same[0] & same[1]
    return (
        ordered.withColumn("_local", F.sum("_size").over(local))
        .join(offsets, condition)
        .select(*df.columns, (F.col("_local") + F.col("_offset")).cast("bigint").alias(name))
    )
