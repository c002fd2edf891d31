"""N-gram Jaccard self-join by chosen paths.

A document is the set of its word n-grams. Equal sets are one node. Nodes are
embedded as minhash tokens, and each of several runs splits them recursively on
sampled shared tokens until a bucket is small (Christiani and Pagh, 2017;
Christiani, Pagh and Sivertsen, 2018). Buckets are compared by brute force: a
sketch drops the pairs that cannot be similar, the rest are compared exactly.
A pair counts in the first of the buckets that it shares, so no list of pairs
is ever made; a bucket that stays large is cut into blocks compared two by two.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewise.llm.common import as_bytes, ascii_words, map_batches, mix, rolling, unlike
from statewise.llm.components import components
from statewise.workspace import settle, settle_result

WORDS = 5
SIMILAR = 0.8
TOKENS = 64  # minhash tokens of a set
RUNS = 6
CHILDREN = 2  # tokens sampled at each bucket of a path
SMALL = 64  # nodes in a bucket that is not split further
DEPTH = 4
DENSE = 0.5  # a bucket with this share of its parent's nodes is not split further
BLOCK = 512  # nodes of a large bucket compared at a time
LEAST_AGREEING = 36  # tokens: below the mean at 0.8, 51, by nearly 5 deviations
CACHE = 400_000  # words whose hashes a task remembers

_SLOPES = mix(np.arange(TOKENS), 7) | np.uint64(1)
_SHIFTS = mix(np.arange(TOKENS), 11)


class Shingler:
    """Sets of hashed n-grams; a text of fewer words is one n-gram."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        if len(self.known) > CACHE:
            self.known.clear()
        known, hashes = self.known, []
        for word in ascii_words(text):
            value = known.get(word)
            if value is None:
                value = known[word] = xxhash.xxh3_64_intdigest(word)
            hashes.append(value)
        if not hashes:
            return np.empty(0, dtype=np.uint64)
        tokens = np.array(hashes, dtype=np.uint64)
        [(_, grams)] = rolling(tokens, [min(self.words, len(tokens))])
        return np.unique(mix(grams, min(self.words, len(tokens))))


def minhash(grams: np.ndarray) -> np.ndarray:
    """``TOKENS`` minima of the set under different scatterings, 32 bits each."""
    least = np.full(TOKENS, 2**32 - 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for start in range(0, len(grams), 4096):
            part = grams[start : start + 4096, None] * _SLOPES + _SHIFTS
            np.minimum(least, (part >> np.uint64(32)).min(axis=0), out=least)
    return least.astype(np.uint32)


def _child_paths(paths: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Paths of the children of every row's bucket: sampled tokens added to the path.

    ``paths`` has a row per node, ``tokens`` its minhash; the result a column per
    child. Which tokens are sampled depends on the path alone.
    """
    with np.errstate(over="ignore"):
        seed = mix(paths, 3)
        step = (seed >> np.uint64(40)) * np.uint64(2) + np.uint64(1)  # odd: no token twice
        child = np.arange(CHILDREN, dtype=np.uint64)
        places = (seed[:, None] + child * step[:, None]) % np.uint64(TOKENS)
        values = tokens[np.arange(len(paths))[:, None], places.astype(np.int64)].astype(np.uint64)
        return mix(mix(values * np.uint64(TOKENS) + places, 5) ^ seed[:, None])


def set_features(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row ``doc_id, key, node, n, tokens``.

    ``key`` identifies the row by id and text, ``node`` its set (NULL when the
    text has no words), ``n`` the set's size, ``tokens`` its minhash.
    """

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in batches:
            nodes, sizes, tokens = [], [], []
            for text in batch.column(2):
                grams = shingle(text.as_py())
                sizes.append(len(grams))
                some = len(grams) > 0
                nodes.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if some else None)
                tokens.append(minhash(grams).tobytes() if some else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(nodes, pa.binary()),
                    pa.array(sizes, pa.int32()),
                    pa.array(tokens, pa.binary()),
                ],
                names=["doc_id", "key", "node", "n", "tokens"],
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), _row_key().alias("key"), as_bytes().alias("text")
    )
    return map_batches(rows, features, "doc_id long, key long, node binary, n int, tokens binary")


def _row_key():
    return F.xxhash64("doc_id", "text")


def _paths(frontier: DataFrame) -> DataFrame:
    """Rows ``path, parent_size, node`` of the children of every row's bucket."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_numpy().view(np.uint64)
            tokens = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.uint32)
            children = _child_paths(paths, tokens.reshape(len(paths), TOKENS)).view(np.int64)
            parents = pa.array(np.repeat(np.arange(len(paths)), CHILDREN))
            yield pa.RecordBatch.from_arrays(
                [pa.array(children.ravel()), batch.column(1).take(parents), batch.column(2).take(parents)],
                names=["path", "parent_size", "node"],
            )

    rows = frontier.select("path", "size", "node", "tokens")
    return map_batches(rows, split, "path long, parent_size long, node binary")


def buckets(nodes: DataFrame, runs: int = RUNS) -> DataFrame:
    """Rows ``path, size, node`` of all final buckets with two nodes or more."""
    roots = F.array(*[F.lit(int(value)) for value in mix(np.arange(runs), 13).astype(np.int64)])
    n_nodes = F.lit(2**62)
    frontier = nodes.select(F.explode(roots).alias("path"), n_nodes.alias("size"), "node", "tokens")
    final = []
    for depth in range(1, DEPTH + 1):
        rows = settle(_paths(frontier), "paths")
        sizes = rows.groupBy("path").agg(F.count("*").alias("size")).where("size > 1")
        sized = settle(rows.join(sizes, "path"), "sized")
        done = F.col("size") <= SMALL
        if depth > 1:
            done |= F.col("size") >= DENSE * F.col("parent_size")
        if depth == DEPTH:
            done = F.lit(True)
        final.append(sized.where(done).select("path", "size", "node"))
        crowded = sized.where(~done)
        if depth == DEPTH or crowded.isEmpty():
            break
        frontier = crowded.join(nodes.select("node", "tokens"), "node")
    found = final[0]
    for more in final[1:]:
        found = found.unionByName(more)
    return found


def _blocks(rows: DataFrame) -> DataFrame:
    """Deal large buckets into blocks; every two blocks meet in one part."""
    n = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("_n")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    return (
        rows.withColumn("_n", n)
        .withColumn("_own", own)
        .withColumn("_other", others)
        .withColumns(
            {
                "low": F.least("_own", "_other"),
                "high": F.greatest("_own", "_other"),
                "upper": F.col("_own") > F.col("_other"),
            }
        )
        .drop("_n", "_own", "_other", "size")
    )


def _by_part(rows: DataFrame, work: Callable, schema: str, payload: list[str]) -> DataFrame:
    """``work(part rows) -> output rows`` for every part of a bucket.

    A part holds at most about two blocks of nodes.
    """
    keys = ["path", "low", "high"]
    columns = [*keys, "upper", "node", *payload]
    dealt = rows.select(*columns).repartition(*keys).sortWithinPartitions(*keys, "node")
    names = [column.split()[0] for column in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    types = [kinds[column.split()[1]] for column in schema.split(", ")]

    def worked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            out = []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if row[:3] != key:
                    if len(held) > 1:
                        out += work(held)
                    held, key = [], row[:3]
                held.append(row)
            yield _table(out)
        if len(held) > 1:
            yield _table(work(held))

    def _table(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in zip(columns, types)], names=names
        )

    return map_batches(dealt, worked, schema)


def _meeting(rows: list[tuple], similar: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs marked in ``similar`` that this part is the one to compare.

    In a part of two different blocks only nodes of different blocks meet. Of
    all buckets two nodes share, the one with the smallest path counts.
    """
    path, low, high = rows[0][:3]
    upper = np.array([row[3] for row in rows])
    similar &= np.triu(np.ones_like(similar, dtype=bool), 1)
    if low != high:
        similar &= upper[:, None] != upper[None, :]
    shared = {}
    for one, other in zip(*np.nonzero(similar)):
        for at in (one, other):
            if at not in shared:
                shared[at] = set(rows[at][5])
        if min(shared[one] & shared[other]) == path:
            yield int(one), int(other)


def _candidates(rows: list[tuple]) -> list[tuple]:
    """Nodes of a part with a partner that the sketch cannot rule out."""
    tokens = np.frombuffer(b"".join(row[7] for row in rows), dtype=np.uint32).reshape(len(rows), TOKENS)
    sizes = np.array([row[6] for row in rows], dtype=np.float64)
    agreeing = np.zeros((len(rows), len(rows)), dtype=np.uint8)
    for column in tokens.T:
        agreeing += column[:, None] == column[None, :]
    near = np.minimum(sizes[:, None], sizes) >= SIMILAR * np.maximum(sizes[:, None], sizes) - 1e-9
    wanted = {at for pair in _meeting(rows, (agreeing >= LEAST_AGREEING) & near) for at in pair}
    return [rows[at][:5] for at in sorted(wanted)]


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of a part's sets."""
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place = np.unique(flat, return_inverse=True)
    counts = np.bincount(place)
    common = np.flatnonzero(counts > 1)  # an n-gram of one set meets nothing
    number = np.full(len(counts), -1)
    number[common] = np.arange(len(common))
    held = number[place]
    overlap = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for start in range(0, len(common), 4096):
        inside = (held >= start) & (held < start + 4096)
        incidence = np.zeros((len(sets), 4096), dtype=np.float32)
        incidence[owner[inside], held[inside] - start] = 1
        overlap += incidence @ incidence.T
    return overlap


def _links(rows: list[tuple]) -> list[tuple]:
    """Links of a part's nodes: number of linked documents, and a spanning forest."""
    sets = [np.frombuffer(row[7], dtype=np.uint64) for row in rows]
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    overlap = _overlaps(sets)
    union = sizes[:, None] + sizes - overlap
    similar = overlap >= SIMILAR * union - 1e-9
    parent, count = list(range(len(rows))), [0] * len(rows)

    def root(at: int) -> int:
        while parent[at] != at:
            parent[at] = parent[parent[at]]
            at = parent[at]
        return at

    found = []
    for one, other in _meeting(rows, similar):
        count[one] += rows[other][6]
        count[other] += rows[one][6]
        if root(one) != root(other):
            parent[root(one)] = root(other)
            found.append((rows[one][4], 0, rows[other][4]))
    return found + [(rows[at][4], n, None) for at, n in enumerate(count) if n]


def _with_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``node, grams`` of the wanted nodes (``node, key``), read from the texts again."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in batches:
            sets = [shingle(text.as_py()).tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.binary())], names=["node", "grams"]
            )

    texts = docs.select(_row_key().alias("key"), as_bytes().alias("text"))
    rows = texts.join(wanted, "key").select("node", "text").dropDuplicates(["node"])
    return map_batches(rows, grams, "node binary, grams binary")


def similar_sets(docs: DataFrame, features: DataFrame, words: int = WORDS, runs: int = RUNS) -> DataFrame:
    """Per node ``node, copies, n_linked, least_node``.

    ``copies`` counts the rows of the node, ``n_linked`` the rows of other
    nodes at a similarity of ``SIMILAR`` or more, ``least_node`` names the
    component of links.
    """
    nodes = settle(
        features.where(F.col("node").isNotNull())
        .groupBy("node", "n", "tokens")
        .agg(F.min("key").alias("key"), F.count("*").alias("copies")),
        "nodes",
    )
    rows = settle(buckets(nodes, runs), "buckets")
    paths = rows.groupBy("node").agg(F.collect_list("path").alias("paths"))
    about = settle(paths.join(nodes, "node"), "about")
    near = settle(
        _by_part(
            _blocks(rows).join(about.select("node", "paths", "n", "tokens"), "node"),
            _candidates,
            "path long, low int, high int, upper boolean, node binary",
            ["paths", "n", "tokens"],
        ),
        "near",
    )
    wanted = near.select("node").distinct().join(nodes.select("node", "key"), "node")
    sets = settle(_with_sets(docs, wanted, words), "sets")
    linked = settle(
        _by_part(
            near.join(about.select("node", "paths", "copies"), "node").join(sets, "node"),
            _links,
            "node binary, n long, other binary",
            ["paths", "copies", "grams"],
        ),
        "linked",
    )
    forest = linked.where(F.col("other").isNotNull())
    classes = components(forest.select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = linked.where(F.col("other").isNull()).groupBy("node").agg(F.sum("n").alias("n_linked"))
    return (
        nodes.select("node", "copies")
        .join(counts, "node", "left")
        .join(classes.select(F.col("a").alias("node"), "least"), "node", "left")
        .select(
            "node",
            "copies",
            F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
            F.coalesce("least", "node").alias("least_node"),
        )
    )


def _classed(docs: DataFrame, words: int, runs: int) -> DataFrame:
    features = settle(set_features(docs, words), "features")
    sets = settle(similar_sets(docs, features, words, runs), "sets")
    return features.select("doc_id", "key", "node").join(sets, "node", "left")


def near_duplicates(docs: DataFrame, words: int = WORDS, runs: int = RUNS) -> DataFrame:
    """Per row ``doc_id, class_id, n_links``.

    ``class_id`` is the smallest doc_id among the rows that links join, one
    after another; ``n_links`` counts the other rows whose set of ``words``-word
    n-grams has a Jaccard similarity of ``SIMILAR`` or more, equal texts included.
    Words are runs without ASCII white space; a text of fewer words is one
    n-gram. NULL and empty texts are linked to nothing and are classes of their
    own. Repeated rows link to each other. Other columns are not read.
    """
    texts = docs.select("doc_id", "text")
    rows = settle_result(docs.sparkSession, lambda: _classed(texts, words, runs), "classed")
    least = rows.groupBy("least_node").agg(F.min("doc_id").alias("_class"))
    return rows.join(least, "least_node", "left").select(
        "doc_id",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("_class")).alias("class_id"),
        F.coalesce(F.col("copies") - 1 + F.col("n_linked"), F.lit(0)).cast("bigint").alias("n_links"),
    )


def keep_one_of_each(docs: DataFrame, words: int = WORDS, runs: int = RUNS) -> DataFrame:
    """``docs`` with one row of every class, all columns as they are.

    The row with the smallest doc_id stays (of several, that with the smallest
    hash). Texts without words all stay, but rows with the same id and text
    count as one.
    """
    texts = docs.select("doc_id", "text")
    rows = settle_result(docs.sparkSession, lambda: _classed(texts, words, runs), "classed")
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), "key")).alias("first")
    chosen = (
        rows.where(F.col("node").isNotNull()).groupBy("least_node").agg(first).select("first.key")
    ).unionByName(rows.where(F.col("node").isNull()).select("key"))
    key, wanted = unlike(docs.columns, "_row_key", "_chosen")
    kept = docs.withColumn(key, _row_key()).join(
        chosen.distinct().withColumnRenamed("key", wanted), F.col(key) == F.col(wanted)
    )
    return kept.dropDuplicates([key]).select(*docs.columns)
