"""Joins of a large relation with a keyed lookup."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewise.workspace import folder_exists, settle

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 2**20


def has_at_most(df: DataFrame, rows: int, n_bytes: int | None = None) -> bool:
    """Size check by an aggregate, so that no rows are moved for it.

    With ``n_bytes`` the rows' text and a fixed share per column must also fit.
    """
    if n_bytes is None:
        return df.count() <= rows
    wide = [
        F.coalesce(F.octet_length(F.col(field.name).cast("string")), F.lit(0))
        for field in df.schema.fields
        if not isinstance(field.dataType, (T.NumericType, T.DatetimeType, T.BooleanType))
    ]
    width = sum(wide, F.lit(16 * len(df.columns)))
    size = df.agg(F.count("*").alias("rows"), F.sum(width).alias("bytes")).first()
    return size["rows"] <= rows and (size["bytes"] or 0) <= n_bytes


def join_lookup(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join ``rows`` (any size, any skew) with one-row-per-key ``lookup``.

    A plain join: hand in a written lookup, whose true size the planner knows,
    and it is broadcast when small. Otherwise both sides are shuffled, and
    adaptive execution splits the partition of a key that holds a third of
    ``rows``; the lookup is neither copied nor are rows told apart.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a lookup join is inner or left, not {how}")
    return rows.join(lookup, list(keys), how)


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    rows: int = BROADCAST_ROWS,
    n_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join facts with a small dimension where they lie, without shuffling them.

    The dimension is counted and measured first and broadcast only within the
    given bounds; beyond them it is a plain join.
    """
    if has_at_most(dimension, rows, n_bytes):
        dimension = F.broadcast(dimension)
    return join_lookup(facts, dimension, keys, how)


def only_new_keys(
    wanted: DataFrame, stored: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Keys that the stored lookup does not hold yet."""
    return wanted.join(stored.select(*keys), list(keys), "left_anti")


def build_lookup(
    rows: DataFrame,
    keys: Sequence[str],
    enrich: Callable[[DataFrame], DataFrame],
    stored: DataFrame | None = None,
) -> DataFrame:
    """Enrich every distinct key once; answers are a written table.

    ``enrich`` maps a frame of distinct keys to the same keys with further
    columns. With ``stored``, only keys missing there are enriched; a column
    that the stored answers lack is NULL for them.
    """
    wanted = rows.select(*keys).dropna(subset=list(keys)).distinct()
    if stored is None:
        return settle(enrich(wanted), "lookup")
    answers = settle(enrich(only_new_keys(wanted, stored, keys)), "lookup")
    return answers.unionByName(stored, allowMissingColumns=True)


def extend_lookup(
    path: str,
    rows: DataFrame,
    keys: Sequence[str],
    enrich: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """A lasting lookup at ``path``: keys of ``rows`` not yet there are enriched
    and appended. What is stored is never rewritten. Gives the whole lookup."""
    spark = rows.sparkSession
    wanted = rows.select(*keys).dropna(subset=list(keys)).distinct()
    if folder_exists(spark, path):
        wanted = only_new_keys(wanted, spark.read.parquet(path), keys)
    # Settled first: an append must not read the table it appends to.
    settle(enrich(wanted), "answers").write.mode("append").parquet(path)
    return spark.read.parquet(path)


def enrich_by_key(
    rows: DataFrame,
    keys: Sequence[str],
    enrich: Callable[[DataFrame], DataFrame],
    stored: DataFrame | None = None,
    how: str = "inner",
) -> DataFrame:
    """Add columns that depend on ``keys`` only, computing them once per key."""
    return join_lookup(rows, build_lookup(rows, keys, enrich, stored), keys, how)
