"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, ``MOST_COPIES`` times
over, cut into packets of at most ``PACKET`` words. The virtual finish time of a
packet is the number of its source's words up to and with it, divided by the
source's weight; that of a document is that of its last packet. One range sort
brings the packets of all sources in order of these times, and the mix ends at
the total budget. Nothing else decides what is taken: a source that has given
all of its copies has no more packets, and so leaves its share to the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewise.llm.common import WORD, running_total
from statewise.operators.ordering import number_rows
from statewise.workspace import settle

MOST_COPIES = 3
PACKET = 100  # words
WEIGHTS = (1, 2, 3)
SEED = "mix"


def count_words(name: str = "text"):
    text = F.coalesce(F.col(name).cast("string"), F.lit(""))
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def source_targets(
    queue: DataFrame, weights=WEIGHTS, most_copies: int = MOST_COPIES, budget: int | None = None
) -> tuple[DataFrame, int]:
    """Target of every source of ``queue`` (``source``, ``size``) and the budget.

    Sources by code point, NULL last, take ``weights`` in turn and share the
    budget (all words unless given). A source's target ends at ``most_copies``
    times its words; the rest is shared by weight among the others until none
    is above. Only sums over the sources reach the driver.
    """
    sizes = queue.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = number_rows(sizes, [F.col("source").asc_nulls_last()], "source_rank")
    turns = F.array(*[F.lit(weight) for weight in weights])
    turn = F.pmod(F.col("source_rank") - 1, F.lit(len(weights))).cast("int")
    sources = settle(ranked.withColumn("weight", turns[turn].cast("bigint")), "sources")
    limit = F.lit(most_copies) * F.col("source_size")
    all_words, all_weights, most = sources.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)),
        F.coalesce(F.sum("weight"), F.lit(0)),
        F.coalesce(F.sum(limit), F.lit(0)),
    ).first()
    budget = min(all_words if budget is None else budget, most)
    level, full = 0.0, None
    while True:  # each turn fills at least one further source
        level_column = F.lit(level)
        is_full = limit <= F.col("weight") * level_column if full is not None else F.lit(False)
        n, words, weight = sources.agg(
            F.coalesce(F.sum(is_full.cast("bigint")), F.lit(0)),
            F.coalesce(F.sum(F.when(is_full, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(is_full, F.col("weight"))), F.lit(0)),
        ).first()
        if n == full or weight == all_weights:
            break
        full = n
        level = (budget - words) / (all_weights - weight)
    served = F.when(is_full, limit.cast("double")).otherwise(F.col("weight") * F.lit(level))
    return sources.withColumn("target", served), budget


def mix_schedule(
    docs: DataFrame, weights=WEIGHTS, most_copies: int = MOST_COPIES, budget: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(queue, schedule). ``queue``: a row per document with ``row``, ``doc_id``,
    ``source``, ``size``, ``source_size``, ``target``. ``schedule``: a row for
    each packet served, with ``row``, ``copy``, ``begin`` (words of the document
    before it), ``finish``, ``words`` and ``mix_end``, the words of the mix up to
    and with it.

    A source takes its target to within a packet. Of the document that it is
    serving when the mix ends the first words are taken, all others are whole.
    """
    key = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    queue = settle(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.col("source").cast("string").alias("source"),
            count_words().alias("size"),
        ),
        "queue",
    )
    sources, budget = source_targets(queue, weights, most_copies, budget)
    sources = sources.withColumnRenamed("source", "_source")
    queue = queue.join(sources, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    waiting = queue.where(F.col("size") > 0).withColumn("key", key)
    order = ["source_rank", "key", "doc_id", "size", "row"]
    waiting = running_total(waiting, order, F.col("size"), "so_far", "source_rank")
    copies = F.sequence(F.lit(0), F.lit(most_copies - 1))
    begins = F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(PACKET).cast("bigint"))
    passed = F.col("copy") * F.col("source_size") + F.col("so_far") - F.col("size") + F.col("begin")
    packets = (
        waiting.withColumn("copy", F.explode(copies))
        .withColumn("begin", F.explode(begins))
        .withColumn("words", F.least(F.lit(PACKET), F.col("size") - F.col("begin")))
        .withColumn("passed", passed + F.col("words"))
        .withColumn("finish", F.col("passed") / F.col("weight"))
        .select("row", "copy", "begin", "words", "finish", "source_rank", "passed")
    )
    served = running_total(packets, ["finish", "source_rank", "passed"], F.col("words"), "mix_end")
    over = F.greatest(F.col("mix_end") - F.lit(budget), F.lit(0))
    schedule = (
        served.withColumn("words", F.col("words") - over)
        .withColumn("mix_end", F.col("mix_end") - over)
        .where(F.col("words") > 0)
        .select("row", "copy", "begin", "finish", "words", "mix_end")
    )
    return queue, schedule


def mix(docs: DataFrame, weights=WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """Per row ``doc_id, size, source_size, target, taken``.

    ``taken`` counts the words the mix takes of the document, repeats included.
    NULL and empty texts have size 0 and are never taken; rows with a NULL
    source form the last source; repeated rows each stand in the queue. Every
    order is total, and the shuffle is a hash of the id, so reruns agree.
    """
    queue, schedule = mix_schedule(docs, weights, most_copies)
    taken = schedule.groupBy("row").agg(F.sum("words").alias("taken"))
    return queue.join(taken, "row", "left").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
    )
