"""Fixity audit of WARC replicas by Merkle trees over ordered offset ranges.

Every record is hashed; hashes of the records that begin in one range of
offsets are hashed together, ranges again in groups, up to a root. Two replicas
whose roots agree are equal; otherwise only branches that differ are followed
down to the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statewise.llm.common import running_total
from statewise.workspace import settle

RANGE = 64 * 2**10  # bytes of archive under one lowest node
FANOUT = 16


def warc_record(url: Column, payload: Column) -> Column:
    """Bytes of a response record; NULL url and payload are empty."""
    body = F.coalesce(payload.cast("string"), F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        F.coalesce(url.cast("string"), F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    ).cast("binary")


def with_offsets(records: DataFrame, order: list) -> DataFrame:
    """Add ``offset``, where each record begins when they are written in order."""
    ended = running_total(records, order, F.col("n_bytes"), "_end")
    return ended.withColumn("offset", F.col("_end") - F.col("n_bytes")).drop("_end")


def _parents(children: DataFrame, width: int) -> DataFrame:
    """Nodes over ``width`` units of ``at``; a node holds at most that many children."""
    pair = F.struct("at", "hash")
    below = F.array_sort(F.collect_list(pair))
    text = F.array_join(
        F.transform(below, lambda x: F.concat_ws(" ", x["at"].cast("string"), x["hash"])), "\n"
    )
    return (
        children.groupBy(F.floor(F.col("at") / width).cast("bigint").alias("node"))
        .agg(F.sha2(text.cast("binary"), 256).alias("hash"))
        .withColumnRenamed("node", "at")
    )


def merkle_levels(leaves: DataFrame, end: int, width: int = RANGE, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels of the tree over ``leaves`` (``at``: offset, ``hash``), lowest first.

    The last level is the root alone. ``end`` is the archive's length, so that
    two replicas get trees of one shape. An empty archive has empty levels.
    """
    levels = [leaves]
    while True:
        levels.append(settle(_parents(levels[-1], width), "tree"))
        if end <= width:
            return levels
        end, width = -(-end // width), fanout


def audit(
    primary: DataFrame, replica: DataFrame, width: int = RANGE, fanout: int = FANOUT
) -> DataFrame:
    """Offsets at which the replicas differ: ``at`` and ``status``.

    Both have one row per record: ``at``, the offset in the shared index, and
    ``hash``. ``status`` is changed, missing (in the replica) or extra. Records
    that share an offset (repeated index rows) differ when their sets differ. Rows
    with a NULL offset are in no range and are not audited; a NULL hash
    compares as ''. Two empty replicas do not differ.
    """
    sides = [
        settle(
            side.where(F.col("at").isNotNull())
            .groupBy("at")
            .agg(F.array_join(F.sort_array(F.collect_list(F.coalesce("hash", F.lit("")))), " ").alias("hash")),
            "leaves",
        )
        for side in (primary, replica)
    ]
    ends = [side.agg(F.coalesce(F.max("at") + 1, F.lit(0))).first()[0] for side in sides]
    ours, theirs = (merkle_levels(side, max(ends), width, fanout) for side in sides)
    suspects = None  # all nodes of the level: the root
    for depth in range(len(ours) - 1, -1, -1):
        mine, other = ours[depth], theirs[depth]
        if suspects is not None:
            step = width if depth == 0 else fanout
            parent = F.floor(F.col("at") / step).cast("bigint")
            wanted = suspects.withColumnRenamed("at", "_parent")
            mine, other = (
                level.withColumn("_parent", parent).join(wanted, "_parent", "left_semi").drop("_parent")
                for level in (mine, other)
            )
        differ = mine.withColumnRenamed("hash", "ours").join(
            other.withColumnRenamed("hash", "theirs"), "at", "full_outer"
        ).where(~F.col("ours").eqNullSafe(F.col("theirs")))
        if depth == 0:
            status = (
                F.when(F.col("theirs").isNull(), "missing")
                .when(F.col("ours").isNull(), "extra")
                .otherwise("changed")
            )
            return differ.select("at", status.alias("status"))
        suspects = settle(differ.select("at"), "suspects")
    raise AssertionError("a tree has at least its leaves")


def audit_pages(pages: DataFrame, replica_html: Column, lost: Column) -> DataFrame:
    """Audit a replica of ``pages`` written as WARC records in order of page_id.

    The replica holds ``replica_html`` in place of ``html`` and lacks the rows
    for which ``lost`` is true. Gives ``page_id, offset, n_bytes, status``.
    """
    record = warc_record(F.col("url"), F.col("html"))
    hashed = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.octet_length(record).cast("bigint").alias("n_bytes"),
        F.sha2(record, 256).alias("ours"),
        F.when(~lost, F.sha2(warc_record(F.col("url"), replica_html), 256)).alias("theirs"),
    )
    order = [F.col("page_id").asc_nulls_last(), "ours", "theirs"]
    index = settle(with_offsets(hashed, order), "index")
    ours = index.select(F.col("offset").alias("at"), F.col("ours").alias("hash"))
    theirs = index.where(F.col("theirs").isNotNull())
    found = audit(ours, theirs.select(F.col("offset").alias("at"), F.col("theirs").alias("hash")))
    return found.join(index, F.col("at") == F.col("offset")).select(
        "page_id", "offset", "n_bytes", "status"
    )
