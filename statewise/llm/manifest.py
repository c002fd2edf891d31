"""Merkle manifest of a dataset, and a recursive query that checks every row.

Rows are leaves. The leaves of a group (a source, say) are put in order and
hashed in runs of ``FAN_OUT`` until one node is left, the group's subroot; the
subroots are hashed likewise into the root. Each level is written as node rows
which hold their children's digests and a link to their parent. ``climb`` is a
Spark recursive query over these rows: every leaf goes from parent to parent and
folds its claimed digest with the siblings that it meets. They are appended once
for each run of leaves, as all leaves of a run meet the same ones above it.

At scale: a leaf's place is found by a range sort with one offset per sort
partition, so a group with a third of the rows is built by all tasks; a level
has a sixteenth of the rows of the one below. A leaf's row holds three digests
at every step; its siblings are put together when the digest of the proof is
taken and never written. The nodes that many leaves
pass, at most ``HIGH_NODES``, are broadcast; below them a node is met by few
leaves, so that join has no hot key.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statewise.llm.common import running_total
from statewise.operators.ordering import number_rows
from statewise.workspace import settle, settle_result

FAN_OUT = 16
#: A node row takes about 700 bytes at most, so these take 14 MB.
HIGH_NODES = 20_000
TOP = "^"
DIGEST = 32  # bytes


@dataclass
class Manifest:
    """``leaves``: ``row, id, hash, claim`` and their link; ``nodes``: ``tree, level,
    pos, hash, children, leaves_below`` and their link. A link is ``up_tree,
    up_level, up_pos, slot``: the parent and the place among its children; NULL at
    the root. The tree of a group is named ``=`` and the group, or ``-`` for NULL;
    that of the subroots ``^``. ``children`` are their digests in binary.
    """

    leaves: DataFrame
    nodes: DataFrame


def row_digest(*values: Column) -> Column:
    """SHA-256 in hex of the values, each as byte count, colon and text, or ``-``."""
    parts = []
    for value in values:
        text = value.cast("string")
        size = F.octet_length(text).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _levels(rows: DataFrame, tallest: int) -> list[DataFrame]:
    """All levels above ``rows`` (``tree, pos, hash, below, n``), each written.

    ``n`` is the number of nodes of the tree on that level. A tree with a single
    node is finished and goes no higher.
    """
    levels = []
    while tallest > 1:
        runs = rows.where(F.col("n") > 1).groupBy("tree", F.floor(F.col("pos") / FAN_OUT).alias("up"))
        grouped = runs.agg(
            F.array_sort(F.collect_list(F.struct("pos", "hash"))).alias("run"),
            F.sum("below").alias("below"),
            F.first("n").alias("n"),
        )
        joined = F.array_join(F.col("run.hash"), "")
        level = grouped.select(
            "tree",
            F.lit(len(levels) + 1).alias("level"),
            F.col("up").alias("pos"),
            F.sha2(joined, 256).alias("hash"),
            F.unhex(joined).alias("children"),
            "below",
            F.ceil(F.col("n") / FAN_OUT).alias("n"),
        )
        rows = settle(level, "level")
        levels.append(rows)
        tallest = -(-tallest // FAN_OUT)
    return levels


def _inside(rows: DataFrame) -> DataFrame:
    """Link of the rows that are not alone on their level: a run of their own tree."""
    return rows.where(F.col("n") > 1).withColumns(
        {
            "up_tree": F.col("tree"),
            "up_level": F.col("level") + 1,
            "up_pos": F.floor(F.col("pos") / FAN_OUT),
            "slot": (F.col("pos") % FAN_OUT).cast("int"),
        }
    )


def build_manifest(
    docs: DataFrame, digest: Column, claim: Column, id: str = "doc_id", group: str = "source"
) -> Manifest:
    """The tree over all rows of ``docs``.

    ``digest`` is the digest of a row, ``claim`` the digest that ``climb`` is to
    test. Leaves ascend by id, NULL first, rows of one id by digest; groups by
    their UTF-8 bytes, NULL first. Repeated rows are leaves of their own. An
    empty table gives no leaf and no node. Only the named columns are read.
    """
    key = F.col(group).cast("string")
    taken = docs.select(
        F.coalesce(F.concat(F.lit("="), key), F.lit("-")).alias("tree"),
        F.col(id).alias("id"),
        digest.alias("hash"),
        claim.alias("claim"),
        F.lit(1).cast("bigint").alias("below"),
    )
    order = ["tree", F.col("id").asc_nulls_first(), "hash", "claim"]
    placed = running_total(taken, order, F.lit(1), "place", "tree")
    placed = settle(
        placed.withColumns(
            {
                "pos": F.col("place") - 1,
                "level": F.lit(0),
                "row": F.monotonically_increasing_id(),
            }
        ),
        "leaves",
    )
    trees = settle(placed.groupBy("tree").agg(F.count("*").alias("n")), "trees")
    most, n_trees = trees.agg(F.coalesce(F.max("n"), F.lit(0)), F.count("*")).first()
    leaves = placed.join(trees.withColumnRenamed("tree", "of"), F.col("tree") == F.col("of")).drop("of")
    levels = _levels(leaves, most)

    columns = ["tree", "level", "pos", "hash", "below"]
    ends = [rows.where(F.col("n") == 1).select(*columns) for rows in [leaves, *levels]]
    subroots = reduce(DataFrame.union, ends)
    nulls_first = [(F.col("tree") != "-").cast("int"), "tree"]
    ranked = number_rows(subroots, nulls_first, "rank")
    ranked = settle(ranked.withColumn("rank", F.col("rank") - 1), "subroots")
    tops = ranked.select(
        F.lit(TOP).alias("tree"),
        F.lit(0).alias("level"),
        F.col("rank").alias("pos"),
        "hash",
        "below",
        F.lit(n_trees).cast("bigint").alias("n"),
    )
    above = _levels(tops, n_trees)

    several = F.lit(n_trees > 1)
    links = ranked.select(
        F.col("tree").alias("of"),
        F.when(several, F.lit(TOP)).alias("up_tree"),
        F.when(several, F.lit(1)).alias("up_level"),
        F.when(several, F.floor(F.col("rank") / FAN_OUT)).alias("up_pos"),
        F.when(several, (F.col("rank") % FAN_OUT).cast("int")).alias("slot"),
    )

    def linked(rows: DataFrame) -> DataFrame:
        alone = rows.where(F.col("n") == 1).join(links, F.col("tree") == F.col("of")).drop("of")
        return _inside(rows).unionByName(alone)

    nodes = [linked(rows) for rows in levels]
    for rows in above:
        no_link = {
            "up_tree": F.lit(None).cast("string"),
            "up_level": F.lit(None).cast("int"),
            "up_pos": F.lit(None).cast("bigint"),
            "slot": F.lit(None).cast("int"),
        }
        nodes += [_inside(rows), rows.where(F.col("n") == 1).withColumns(no_link)]
    link = ["up_tree", "up_level", "up_pos", "slot"]
    wanted = ["tree", "level", "pos", "hash", "children", "below", *link]
    if nodes:
        table = reduce(DataFrame.union, [rows.select(*wanted) for rows in nodes])
    else:
        table = linked(leaves.limit(0)).withColumn("children", F.unhex("hash")).select(*wanted)
    table = table.withColumnRenamed("below", "leaves_below")
    found = linked(leaves).select("row", "id", "tree", "hash", "claim", *link)
    return Manifest(settle(found, "linked"), settle(table, "nodes"))


def _high_from(nodes: DataFrame) -> int:
    """Least number of leaves below a node with which it is one of the high ones.

    Only the number of nodes per power of two reaches the driver.
    """
    power = F.floor(F.log2(F.col("leaves_below").cast("double"))).alias("power")
    counts = dict(nodes.groupBy(power).count().collect())
    total = 0
    for power in sorted(counts, reverse=True):
        total += counts[power]
        if total > HIGH_NODES:
            return 2 ** (power + 1)
    return 1


_CLIMB = """
WITH RECURSIVE climb AS (
  SELECT * FROM {start}
  UNION ALL
  SELECT {hint}
    c.id, c.leaf, c.run_tree, c.run_level, c.run_pos, c.place, c.run,
    n.up_tree, n.up_level, n.up_pos, n.slot,
    unhex(sha2(concat(lower(hex(substring(n.children, 1, {digest} * c.slot))),
                      lower(hex(c.folded)),
                      lower(hex(substring(n.children, {digest} * (c.slot + 1) + 1)))), 256)) AS folded,
    CASE WHEN c.run IS NOT NULL THEN
      concat(c.siblings, array(concat(substring(n.children, 1, {digest} * c.slot),
                                      substring(n.children, {digest} * (c.slot + 1) + 1)))) END AS siblings,
    CASE WHEN n.tree <> '{top}' AND coalesce(n.up_tree, '{top}') = '{top}'
      THEN n.hash ELSE c.subroot END AS subroot,
    CASE WHEN n.up_tree IS NULL THEN n.hash END AS root
  FROM climb c JOIN {nodes} n
    ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_pos = n.pos
)
SELECT * FROM climb LIMIT ALL
"""


def _ascend(start: DataFrame, nodes: DataFrame, hint: str) -> DataFrame:
    """All steps from ``start`` up through ``nodes``."""
    spark = start.sparkSession
    names = {"start": f"climb_start_{uuid.uuid4().hex}", "nodes": f"climb_nodes_{uuid.uuid4().hex}"}
    start.createOrReplaceTempView(names["start"])
    nodes.createOrReplaceTempView(names["nodes"])
    try:
        return spark.sql(_CLIMB.format(**names, hint=hint, digest=DIGEST, top=TOP))
    finally:
        for name in names.values():
            spark.catalog.dropTempView(name)


def _climbers(manifest: Manifest) -> DataFrame:
    """The rows that climb: every leaf, and every run of leaves.

    A leaf's row folds its claim with the siblings that it meets. The siblings
    above a run are the same for all of its leaves, so the row of the run, which
    holds the ``run``'s digests, appends them once.
    """
    leaf = manifest.leaves.select(
        "id",
        F.unhex("hash").alias("leaf"),
        F.col("up_tree").alias("run_tree"),
        F.col("up_level").alias("run_level"),
        F.col("up_pos").alias("run_pos"),
        F.col("slot").alias("place"),
        F.lit(None).cast("binary").alias("run"),
        "up_tree",
        "up_level",
        "up_pos",
        "slot",
        F.unhex("claim").alias("folded"),
        F.lit(None).cast("array<binary>").alias("siblings"),
        F.lit(None).cast("string").alias("subroot"),
        F.lit(None).cast("string").alias("root"),
    )
    # Level 1 holds all runs of leaves, in the top tree those with the only leaf of a group.
    run = manifest.nodes.where(F.col("level") == 1).select(
        F.lit(None).cast(leaf.schema["id"].dataType).alias("id"),
        F.lit(None).cast("binary").alias("leaf"),
        F.col("tree").alias("run_tree"),
        F.col("level").alias("run_level"),
        F.col("pos").alias("run_pos"),
        F.lit(None).cast("int").alias("place"),
        F.col("children").alias("run"),
        "up_tree",
        "up_level",
        "up_pos",
        "slot",
        F.lit(None).cast("binary").alias("folded"),
        F.array().cast("array<binary>").alias("siblings"),
        F.when((F.col("tree") != TOP) & (F.coalesce("up_tree", F.lit(TOP)) == TOP), F.col("hash")).alias(
            "subroot"
        ),
        F.when(F.col("up_tree").isNull(), F.col("hash")).alias("root"),
    )
    return leaf.union(run)


def _at_the_root(manifest: Manifest) -> DataFrame:
    """The rows of ``_climbers`` when they have reached the root, written."""
    nodes, start = manifest.nodes, _climbers(manifest)
    arrived = F.col("up_tree").isNull()
    least = _high_from(nodes)
    is_high = F.col("leaves_below") >= least
    if least == 1:
        return settle(_ascend(start, nodes, "/*+ BROADCAST(n) */").where(arrived), "climbed")
    # Only rows whose parent is a high node go on; every leaf has one, the root at last.
    high = nodes.where(is_high)
    meets = high.select(
        F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("pos").alias("up_pos")
    )
    lower = _ascend(start, nodes.where(~is_high), "")
    halt = lower.join(F.broadcast(meets), ["up_tree", "up_level", "up_pos"], "left_semi")
    halt = settle(halt.select(*lower.columns), "halfway")
    upper = _ascend(halt, high, "/*+ BROADCAST(n) */").where(arrived)
    # Runs that are the root itself do not climb at all.
    return settle(upper.union(start.where(arrived)), "climbed")


def climb(manifest: Manifest) -> DataFrame:
    """Per leaf ``id, leaf, subroot, root, folded_root, proof``.

    ``proof`` is the list of the siblings' digests in hex, from the leaf's run to
    the root, left to right, all of a step in one string. A claim that is the
    leaf's own digest folds to the root, any other does not.
    """
    done = _at_the_root(manifest)
    tails = done.where(F.col("run").isNotNull()).select(
        F.col("run_tree").alias("tail_tree"),
        F.col("run_level").alias("tail_level"),
        F.col("run_pos").alias("tail_pos"),
        F.col("run").alias("others"),
        F.col("siblings").alias("above"),
        F.col("subroot").alias("tail_subroot"),
        F.col("root").alias("tail_root"),
    )
    leaves = done.where(F.col("leaf").isNotNull()).drop("run", "siblings", "subroot", "root")
    same = (
        (F.col("run_tree") == F.col("tail_tree"))
        & (F.col("run_level") == F.col("tail_level"))
        & (F.col("run_pos") == F.col("tail_pos"))
    )
    own = F.concat(
        F.substring("others", F.lit(1), F.col("place") * DIGEST),
        F.substring("others", (F.col("place") + 1) * DIGEST + 1, F.lit(FAN_OUT * DIGEST)),
    )
    leaf = F.lower(F.hex("leaf"))
    proof = F.transform(F.concat(F.array(own), F.col("above")), lambda step: F.lower(F.hex(step)))
    # The only leaf of a group is its subroot, the only leaf of all is the root.
    return leaves.join(tails, same, "left").select(
        "id",
        leaf.alias("leaf"),
        F.coalesce("tail_subroot", leaf).alias("subroot"),
        F.coalesce("tail_root", leaf).alias("root"),
        F.lower(F.hex("folded")).alias("folded_root"),
        F.coalesce(proof, F.array().cast("array<string>")).alias("proof"),
    )


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit_documents(docs: DataFrame) -> DataFrame:
    """Every row of ``documents`` against a copy with tampered texts.

    Per row ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.
    Where 5 divides the CRC-32 of the decimal id, the claimed digest is that of
    the row with its text in lower case; other claims, those of NULL ids
    included, are the row's own. A tampered text without A-Z is the same text
    and is verified. NULL columns are hashed as ``-`` and long texts whole;
    repeated rows are leaves of their own; an empty table gives no rows; other
    columns, whatever their names, are not read.
    """
    rest = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars")]
    digest = row_digest(*rest, F.col("text"))
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    claim = F.when(tampered, row_digest(*rest, lower_ascii(F.col("text")))).otherwise(digest)

    def audited() -> DataFrame:
        found = climb(build_manifest(docs, digest, claim))
        return found.select(
            F.col("id").alias("doc_id"),
            "leaf",
            "subroot",
            "root",
            F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"),
            "folded_root",
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )

    return settle_result(docs.sparkSession, audited, "manifest")
