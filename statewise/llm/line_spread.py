"""Removal of lines that many sites share, by DataFrame functions alone.

HyperLogLog sketches of each line's sites are built in every task and merged
by the aggregation. Lines whose estimate is near the threshold get an exact
count of distinct sites, so an estimate decides only what it cannot get wrong.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewise.llm.common import unlike
from statewise.workspace import settle

LEAST_SITES = 10
SKETCH_BITS = 12  # 2^12 registers: a relative error of about 1.6 percent
NEAR_SHARE = 0.15  # about nine such errors to each side
WHITE = " \t\x0b\x0c\r"


def _lines():
    return F.split(F.coalesce(F.col("text"), F.lit("")), "\n")


def _key(key: str = "_key", size: str = "_bytes"):
    """A row's identity: repeated rows share it, and lose the same lines."""
    return [
        F.xxhash64("doc_id", "text").alias(key),
        F.octet_length(F.coalesce(F.col("text"), F.lit(""))).alias(size),
    ]


def _without(gone):
    """The text without the lines at the places ``gone``, in time linear in its lines."""

    def joined(lines):
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(places, lambda at: F.get(lines, at)), "\n")

    # As the variable of an outer array of one, the text is split once, not per line.
    return F.get(F.transform(F.array(_lines()), joined), 0)


def shared_lines(lines: DataFrame, least_sites: int = LEAST_SITES) -> DataFrame:
    """Hashes of the lines found on ``least_sites`` distinct sites or more.

    ``lines`` has ``line`` (a hash) and ``site``; a NULL site counts for none.
    """
    known = lines.where(F.col("site").isNotNull())
    spread = settle(
        known.groupBy("line")
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("sites"))
        .where(F.col("sites") >= F.lit(least_sites * (1 - NEAR_SHARE) - 1)),
        "spread",
    )
    far = F.col("sites") > F.lit(least_sites * (1 + NEAR_SHARE) + 1)
    exact = (
        known.join(spread.where(~far).select("line"), "line", "left_semi")
        .groupBy("line", "site")
        .agg(F.lit(1).alias("one"))
        .groupBy("line")
        .agg(F.sum("one").alias("n"))
        .where(F.col("n") >= least_sites)
    )
    return spread.where(far).select("line").unionByName(exact.select("line"))


def remove_shared_lines(
    docs: DataFrame, site: str = "source", least_sites: int = LEAST_SITES
) -> DataFrame:
    """``docs`` without cross-site lines, plus ``n_lines`` and ``n_removed``.

    Lines are cut at ``\\n`` and compared without white space at their ends;
    blank lines are never counted or removed. A removed line goes from every
    document that holds it. NULL texts stay NULL, a text may become empty, a row
    never goes. ``n_chars``, where present, follows the text. Texts are taken
    whole, in time linear in their lines. Columns named ``n_lines`` or
    ``n_removed`` are replaced, all others kept, whatever their names.
    """
    kept = [name for name in docs.columns if name.lower() not in ("n_lines", "n_removed")]
    names = unlike(docs.columns, "_row", "_size", "_of_row", "_of_size", "_removed")
    key, size, of_key, of_size, removed_at = names
    trimmed = F.trim(F.col("_line"), F.lit(WHITE))
    lines = settle(
        docs.select(*_key(), F.col(site).cast("string").alias("site"), F.posexplode(_lines()).alias("at", "_line"))
        .where(trimmed != "")
        .select("_key", "_bytes", "at", "site", F.xxhash64(trimmed).alias("line")),
        "lines",
    )
    shared = settle(shared_lines(lines, least_sites), "shared")
    removed = (
        lines.join(shared, "line", "left_semi")
        .groupBy("_key", "_bytes")
        .agg(F.collect_set("at").alias(removed_at))
        .withColumnsRenamed({"_key": of_key, "_bytes": of_size})
    )
    keyed = docs.select(*kept, *_key(key, size))
    same = (F.col(key) == F.col(of_key)) & (F.col(size) == F.col(of_size))
    joined = keyed.join(removed, same, "left")
    gone = F.coalesce(F.col(removed_at), F.array().cast("array<int>"))
    rest = _without(gone)
    text = F.when(F.size(gone) > 0, rest).otherwise(F.col("text"))
    n_lines = F.size(F.filter(_lines(), lambda line: F.trim(line, F.lit(WHITE)) != ""))
    result = joined.withColumns(
        {
            "n_lines": n_lines.cast("bigint"),
            "n_removed": F.size(gone).cast("bigint"),
            "text": text,
        }
    )
    if "n_chars" in kept:
        changed = F.col("n_removed") > 0
        count = F.length("text").cast(docs.schema["n_chars"].dataType)
        result = result.withColumn("n_chars", F.when(changed, count).otherwise(F.col("n_chars")))
    return result.select(*kept, "n_lines", "n_removed")
