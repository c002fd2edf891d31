"""Exact copies by an extendible-hash index; DataFrame functions only.

The index key of a text is a 64-bit hash, its leading bits are its slot in a
directory. A bucket that holds more than its share of bytes is split by one more
bit, and the directory doubles when that bit is new to it; each directory is a
table in the shared folder. Runs of whole buckets, in order of their keys, are
dealt to owner tasks. An owner sorts its buckets by key and bytes: texts of one
key form a chain, and only rows with equal bytes are a group.

At scale: the bucket size grows with the table, so that the directory has at
most ``2 ** MOST_BITS`` slots and can be broadcast. Splitting cannot part the
copies of one text. Keys that fill half a bucket or more, at most
``2 * MOST_BUCKETS`` of them, are therefore kept out of the buckets: their rows
are counted per text where they lie, then in several tasks, and only the counts
meet. No other key can fill an owner. Every text moves once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statewise.workspace import settle, settle_result

BUCKET_BYTES = 16 * 2**20
OWNER_BYTES = 64 * 2**20
MOST_BUCKETS = 2**13
MOST_BITS = 16
#: Bytes of a row beside its text.
ROW_BYTES = 64
#: Tasks over which the rows of one heavy key are spread before they meet.
SPREAD = 32


def _slot(key: str | Column, bits: int) -> Column:
    """The leading ``bits`` bits of a 64-bit key."""
    if bits == 0:
        return F.lit(0).cast("bigint")
    return F.shiftrightunsigned(key, 64 - bits)


def grow_directory(sizes: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """(directory, bits): a row ``slot, bucket, bytes`` for each of 2^bits slots.

    ``sizes`` has the ``bytes`` of each slot of ``MOST_BITS`` bits. ``bucket`` is
    named by the first of all slots of the finest directory that it covers.
    Doubles until no bucket holds more than ``capacity`` or the bits are used up.
    """
    spark = sizes.sparkSession

    def filled(directory: DataFrame, bits: int) -> DataFrame:
        """``directory`` with the bytes of each slot's bucket."""
        fine = F.shiftright("slot", MOST_BITS - bits).alias("of")
        held = sizes.groupBy(fine).agg(F.sum("bytes").alias("held"))
        joined = directory.join(held, F.col("slot") == F.col("of"), "left")
        joined = joined.withColumn("held", F.coalesce("held", F.lit(0).cast("bigint")))
        totals = joined.groupBy("bucket").agg(F.sum("held").alias("bytes"))
        return settle(joined.select("slot", "depth", "bucket").join(totals, "bucket"), "directory")

    first = spark.range(1).select(
        F.col("id").alias("slot"), F.lit(0).alias("depth"), F.lit(0).cast("bigint").alias("bucket")
    )
    bits = 0
    directory = filled(first, bits)
    while bits < MOST_BITS and not directory.where(F.col("bytes") > capacity).isEmpty():
        bits += 1
        half = F.explode(F.array(F.lit(0), F.lit(1))).alias("half")
        doubled = directory.select("*", half).withColumn("slot", F.col("slot") * 2 + F.col("half"))
        overfull = F.col("bytes") > capacity
        # In a split bucket the new bit is the one that tells its two halves apart.
        depth = F.when(overfull, F.lit(bits)).otherwise(F.col("depth"))
        covered = F.call_function("shiftright", F.col("slot"), F.lit(bits) - F.col("depth"))
        start = F.call_function("shiftleft", covered, F.lit(MOST_BITS) - F.col("depth"))
        doubled = doubled.withColumn("depth", depth).withColumn("bucket", start)
        directory = filled(doubled.select("slot", "depth", "bucket"), bits)
    return directory, bits


def _owners(directory: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """``slot, bucket, owner``: neighbouring buckets of about ``capacity`` bytes together.

    The window runs over at most ``2 ** MOST_BITS`` buckets.
    """
    buckets = directory.groupBy("bucket").agg(F.first("bytes").alias("bytes"))
    before = F.sum("bytes").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    share = F.floor(F.coalesce(before, F.lit(0)) / F.lit(capacity)).cast("int").alias("owner")
    dealt = settle(
        directory.join(buckets.select("bucket", share), "bucket").select("slot", "bucket", "owner"),
        "owners",
    )
    return dealt, (dealt.agg(F.max("owner")).first()[0] or 0) + 1


def _heavy_groups(rows: DataFrame) -> DataFrame:
    """``key, text, keep, size, chain`` per different text of the heavy keys.

    ``chain`` is the number of different texts of the key. Equal rows are merged
    in each task, then in ``SPREAD`` tasks a text, then in one.
    """
    latest = F.max(F.struct("id", "row"))
    spread = rows.withColumn("part", F.spark_partition_id() % SPREAD)
    merged = spread.groupBy("key", "text", "part").agg(
        latest.alias("keep"), F.count("*").alias("size")
    )
    texts = merged.groupBy("key", "text").agg(F.max("keep").alias("keep"), F.sum("size").alias("size"))
    texts = settle(texts, "heavy_texts")
    chains = texts.groupBy("key").agg(F.count("*").alias("chain"))
    return texts.join(chains, "key")


def find_copies(
    docs: DataFrame,
    columns: Sequence[str] = (),
    id: str = "doc_id",
    text: str = "text",
    key_of: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """Each row of ``docs``: ``id, keep_id, group_size, kept, text_sha256, row``.

    ``row`` is a struct of the named ``columns``. NULL counts as the empty text,
    texts are compared by their bytes with no change. Of equal texts the row with
    the largest id stays, NULL being the least; of repeated rows of that id just
    one. Long texts are compared whole. An empty table gives no rows. Other
    columns, whatever their names, are not read. ``key_of`` hashes a text to a
    bigint; a poor one gives long chains and the same result.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id).alias("id"),
        F.struct(*[F.col(name) for name in columns], F.lit(0).alias("_")).alias("payload"),
        whole.alias("text"),
    ).withColumn("key", key_of(F.col("text")).cast("bigint"))

    size = (F.octet_length("text") + F.lit(ROW_BYTES)).cast("bigint")
    weights = settle(rows.groupBy("key").agg(F.sum(size).alias("bytes")), "weights")
    total = weights.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    bucket = max(BUCKET_BYTES, total // MOST_BUCKETS)
    # At most 2 * MOST_BUCKETS keys hold half a bucket each.
    heavy = settle(weights.where(F.col("bytes") * 2 >= bucket).select("key"), "heavy")
    light = weights.join(F.broadcast(heavy), "key", "left_anti")
    sizes = settle(
        light.groupBy(_slot("key", MOST_BITS).alias("slot")).agg(F.sum("bytes").alias("bytes")),
        "sizes",
    )
    directory, bits = grow_directory(sizes, bucket)
    owners, n_owners = _owners(directory, max(OWNER_BYTES, bucket))

    sha = F.sha2("text", 256).alias("text_sha256")
    found = ["id", "keep_id", "group_size", "kept", "text_sha256", "payload"]

    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    dealt = (
        numbered.join(F.broadcast(heavy), "key", "left_anti")
        .withColumn("slot", _slot("key", bits))
        .join(F.broadcast(owners), "slot")
        .repartitionById(n_owners, F.col("owner"))
    )
    # Owner, bucket and key bring the rows of a chain together, the text parts them.
    chained = W.partitionBy("owner", "bucket", "key", "text")
    first = chained.orderBy(F.col("id").desc_nulls_last(), F.col("row"))
    in_buckets = dealt.select(
        "id",
        F.first("id").over(first).alias("keep_id"),
        F.count("*").over(chained).alias("group_size"),
        (F.row_number().over(first) == 1).alias("kept"),
        sha,
        "payload",
    )

    apart = settle(numbered.join(F.broadcast(heavy), "key"), "heavy_rows")
    groups = settle(_heavy_groups(apart), "heavy_groups")
    result = [F.col("keep.id").alias("keep_id"), F.col("size").alias("group_size")]
    result.append((F.col("row") == F.col("keep.row")).alias("kept"))
    # A chain of one text, as all are but for colliding hashes, is told by its key.
    single = groups.where("chain = 1").select("key", "keep", "size")
    by_key = apart.join(F.broadcast(single), "key").select("id", *result, sha, "payload")
    several = groups.where("chain > 1").select("key", "text", "keep", "size")
    by_text = apart.join(several, ["key", "text"]).select("id", *result, sha, "payload")
    united = in_buckets.select(*found).union(by_key.select(*found)).union(by_text.select(*found))
    return united.withColumnRenamed("payload", "row")


def exact_copies(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id, keep_id, group_size, kept, text_sha256``; see ``find_copies``."""

    def found() -> DataFrame:
        return find_copies(docs).withColumnRenamed("id", "doc_id").drop("row")

    return settle_result(docs.sparkSession, found, "exact_copies")


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they are."""

    def kept() -> DataFrame:
        rows = find_copies(docs, docs.columns).where("kept")
        return rows.select(*[F.col("row").getField(name).alias(name) for name in docs.columns])

    return settle_result(docs.sparkSession, kept, "without_copies")
