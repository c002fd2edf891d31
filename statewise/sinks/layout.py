"""Physical order and distribution of files.

``write_sorted``: one compound order over all files, so that files do not
overlap. ``write_z_ordered``: rows close in several columns lie in one file.
``save_spread``: two tables bucketed by a key of which some values are very
frequent, so that they join without a shuffle and without one full bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewise.sinks.tables import save_bucketed
from statewise.workspace import settle

#: Bits per column of a Z-order key: 255 splitters each.
Z_BITS = 8
#: Heavy keys looked for: those with more than this share of the rows.
HEAVY_SHARE = 0.01
SALT = "salt"


def write_sorted(df: DataFrame, path: str, sort_by: Sequence[str], files: int) -> None:
    """``files`` Parquet files in the compound order ``sort_by``.

    The ranges are sampled over the whole key, so a first column of few values
    does not limit the number of files. Rows of one key stay in one file; give
    further columns where one key holds a large share.
    """
    df.repartitionByRange(files, *sort_by).sortWithinPartitions(*sort_by).write.mode(
        "overwrite"
    ).parquet(path)


def _rank(name: str, kind: T.DataType, splitters: Sequence) -> Column:
    """How many of the rising ``splitters`` are at most the value: a binary search
    in as many steps as there are bits. NULL is 0."""
    held = F.array(*[F.lit(splitter) for splitter in splitters]).cast(T.ArrayType(kind))
    halves = F.array(*[F.lit(2**bit) for bit in reversed(range(len(splitters).bit_length()))])

    def narrowed(rank: Column, step: Column) -> Column:
        # Beyond the end, and for NULL, the comparison is NULL and the rank stays.
        return F.when(F.get(held, rank + step - 1) <= F.col(name), rank + step).otherwise(rank)

    return F.aggregate(halves, F.lit(0), narrowed)


def z_order_key(df: DataFrame, columns: Sequence[str], bits: int = Z_BITS) -> Column:
    """The interleaved bits of the columns' ranks among ``2 ** bits - 1`` splitters.

    The splitters are quantiles, one aggregation over ``df``; only they reach
    the driver. A rank, unlike the value, takes every column's spread into account.
    """
    shares = F.array(*[F.lit(i / 2**bits) for i in range(1, 2**bits)])
    found = df.agg(*[F.percentile_approx(name, shares, 10_000).alias(name) for name in columns]).first()
    ranks = [
        _rank(name, df.schema[name].dataType, sorted(found[name])) if found[name] else F.lit(0)
        for name in columns
    ]
    parts = []
    for bit in range(bits):
        for place, rank in enumerate(ranks):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint")
            parts.append(F.shiftleft(one, bit * len(columns) + place))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def write_z_ordered(df: DataFrame, path: str, columns: Sequence[str], files: int) -> None:
    """``files`` Parquet files, each holding a box of the columns' value ranges.

    A query for a range of any of the columns opens few files. Values must be
    numbers, dates or times.
    """
    key = settle(df, "z_order").withColumn("_z", z_order_key(df, columns))
    ordered = key.repartitionByRange(files, "_z", *columns).sortWithinPartitions("_z", *columns)
    ordered.drop("_z").write.mode("overwrite").parquet(path)


def file_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Least and greatest value of each column per file that ``df`` reads."""
    ranges = []
    for name in columns:
        ranges += [F.min(name).alias(f"{name}_least"), F.max(name).alias(f"{name}_greatest")]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(*ranges)


def heavy_keys(df: DataFrame, key: str, share: float = HEAVY_SHARE) -> list[tuple[object, int]]:
    """(value, rows) of the values with more than ``share`` of the rows.

    A mergeable summary of frequent items, made in each task and merged, names
    the candidates in one pass; a second pass counts them. There are fewer than
    ``1 / share`` of them. NULL is not counted: it joins nothing.
    """
    most = int(1 / share)
    # With so many items tracked the summary's error stays below the share looked for.
    tracked = 1 << max(10, (8 * most - 1).bit_length())
    present = df.where(F.col(key).isNotNull())
    rows, top = present.agg(
        F.count("*"), F.expr(f"approx_top_k(`{key}`, {most}, {tracked})")
    ).first()
    candidates = [item["item"] for item in top or []]
    if not candidates:
        return []
    counted = present.where(F.col(key).isin(candidates)).groupBy(key).count().collect()
    return sorted((row[key], row["count"]) for row in counted if row["count"] > share * rows)


def save_spread(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    tables: tuple[str, str],
    paths: tuple[str, str],
    buckets: int,
    share: float = HEAVY_SHARE,
) -> list[tuple[object, int]]:
    """Save facts and their one-row-per-key lookup bucketed by ``key`` and ``salt``.

    A key with more than ``share`` of the facts is dealt over as many salts as it
    has shares, at most ``buckets``, and its lookup row is copied to each; any other key has salt
    0. Joined on key and salt the tables need no shuffle, and no task reads much
    more than ``share`` of the rows of one key. Gives the heavy keys.
    """
    heavy = heavy_keys(facts, key, share)
    rows = sum(n for _, n in heavy) if heavy else 0
    total = facts.count() if heavy else rows
    salts = F.lit(1)
    for value, n in heavy:
        dealt = min(buckets, max(2, round(n / (share * total))))
        salts = F.when(F.col(key) == F.lit(value), F.lit(dealt)).otherwise(salts)
    others = [F.col(name) for name in facts.columns if name != key]
    dealt = F.pmod(F.xxhash64(*(others or [F.col(key)])), salts).cast("int")
    dealt = F.when(F.col(key).isNull(), F.lit(0)).otherwise(dealt)
    copies = F.explode(F.sequence(F.lit(0), salts - 1))
    save_bucketed(facts.withColumn(SALT, dealt), tables[0], paths[0], [key, SALT], buckets)
    save_bucketed(lookup.withColumn(SALT, copies), tables[1], paths[1], [key, SALT], buckets)
    return heavy
