"""Removal of repeated byte strings by sampled, partitioned and sorted suffixes.

A string of ``LENGTH`` bytes that occurs twice holds, at the same place in both
occurrences, the same smallest ``GRAM``-byte gram. Suffixes are therefore taken
only where a gram is the smallest of some string (about one start in 35): the
sample loses no repeat. Suffixes are partitioned by a hash of their leading
gram, which is even by itself, and every partition is sorted by the gram and
by the stretch of text that the suffix stands for, all strings whose smallest
gram it is. Neighbours that agree in both repeat the whole stretch. Stretches
that share the gram alone are compared string by string in a second round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewise.llm.common import as_bytes, map_batches, mix
from statewise.workspace import settle

LENGTH = 100
GRAM = 24
PIECE = 500_000  # bytes hashed at a time; longer texts are cut with an overlap
ROUND = 20_000  # stretches compared at a time in the second round
CROWDED = 100_000  # stretches of one gram that are taken apart into strings
_PLACES = np.uint64(20)  # bits of a place inside a piece
_BASE = np.uint64(0x9E3779B97F4A7C15)


def hash_runs(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` bytes, put together from runs of powers of two."""
    current, size, power = mix(data), 1, _BASE
    found, done = None, 0
    rest = length
    with np.errstate(over="ignore"):
        while True:
            if rest & 1:
                if found is None:
                    found = current
                else:
                    n = max(0, len(data) - (done + size) + 1)
                    found = found[:n] * power + current[done : done + n]
                done += size
            rest >>= 1
            if not rest:
                return mix(found, 1)
            n = max(0, len(current) - size)
            current = current[:n] * power + current[size : size + n]
            power, size = power * power, 2 * size


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[: len(values) - size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def sampled_suffixes(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text number, gram hash, stretch hash, first start, number of starts, place of the gram).

    A stretch is a run of starts whose strings share one smallest gram; ``place``
    counts from the first start. Texts together are at most about a piece.
    """
    lengths = np.array([len(text) for text in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if len(data) < LENGTH:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(6))
    begins = np.cumsum(lengths) - lengths
    grams = hash_runs(data, GRAM)
    ranked = ((mix(grams, 2) >> _PLACES) << _PLACES) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_min(ranked, LENGTH - GRAM + 1)
    place = (least & ((np.uint64(1) << _PLACES) - np.uint64(1))).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)[: len(place)]
    start = np.arange(len(place))
    whole = start + LENGTH <= (begins + lengths)[owner]
    start, place, owner = start[whole], place[whole], owner[whole]
    if not len(start):
        return tuple(np.empty(0, dtype=np.int64) for _ in range(6))
    change = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    first = np.concatenate([[0], np.flatnonzero(change) + 1])
    last = np.concatenate([first[1:], [len(start)]]) - 1
    from_, to, at = start[first], start[last], place[first]
    strings = hash_runs(data, LENGTH)
    with np.errstate(over="ignore"):
        shape = mix(((to - from_) * 128 + (at - from_)).astype(np.uint64), 3)
        stretch = mix(strings[from_] + shape, 4) ^ mix(strings[to] + shape, 5)
    return (
        owner[first],
        grams[at].astype(np.int64),
        stretch.astype(np.int64),
        from_ - begins[owner[first]],
        to - from_ + 1,
        at - from_,
    )


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Groups of (row, offset in its text, bytes), each group about a piece at most."""
    rows, offsets, parts, size = [], [], [], 0
    for row, text in enumerate(texts):
        for offset in range(0, max(1, len(text)), PIECE):
            part = text[offset : offset + PIECE + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            if size and size + len(part) > PIECE + LENGTH:
                yield rows, offsets, parts
                rows, offsets, parts, size = [], [], [], 0
            rows.append(row)
            offsets.append(offset)
            parts.append(part)
            size += len(part)
    if rows:
        yield rows, offsets, parts


def _doc():
    """Order of the documents."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(2**63 - 1))


# A stretch's place packed into one long, in the order of first starts:
# first start in units of one byte, 7 bits each for starts and place.
def _pack(start, n, place):
    return (start << 14) | (n << 7) | place


def _unpack(span: np.ndarray) -> tuple[np.ndarray, ...]:
    return span >> 14, (span >> 7) & 127, span & 127


def suffix_rows(docs: DataFrame) -> DataFrame:
    """``gram, stretch, doc, mark, span`` of every sampled suffix of ``doc, mark, text``."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, mark = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for rows, offsets, parts in _pieces(batch.column(2).to_pylist()):
                owner, gram, stretch, start, n, place = sampled_suffixes(parts)
                row, offset = np.array(rows)[owner], np.array(offsets)[owner]
                span = _pack(start + offset, n, place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column) for column in (gram, stretch, doc[row], mark[row], span)],
                    names=["gram", "stretch", "doc", "mark", "span"],
                )

    return map_batches(docs, sample, "gram long, stretch long, doc long, mark long, span long")


def compare_neighbours(suffixes: DataFrame) -> DataFrame:
    """``gram, doc, mark, span, whole`` of the suffixes whose gram occurs more than once.

    ``whole`` marks stretches that stand before, all of them. The others are the
    first of their kind under a gram that has several kinds. A sorted partition
    streams through; nothing but the row before is held.
    """
    ordered = suffixes.repartition("gram").sortWithinPartitions("gram", "stretch", "doc", "mark", "span")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (gram, stretch) of the row before
        held = None  # the gram's first row, until its gram has a second kind
        for batch in batches:
            gram, stretch, doc, mark, span = (column.to_numpy() for column in batch.columns)
            if not len(gram):
                continue
            before_gram = np.concatenate([[last[0] if last else ~gram[0]], gram[:-1]])
            before_stretch = np.concatenate([[last[1] if last else 0], stretch[:-1]])
            same_gram = gram == before_gram
            whole = same_gram & (stretch == before_stretch)
            later_kind = same_gram & ~whole
            firsts = np.flatnonzero(~same_gram)
            # a gram's first row is wanted when a later kind follows it
            group = np.searchsorted(firsts, np.arange(len(gram)), side="right") - 1
            kinds = np.zeros(len(firsts) + 1, dtype=bool)  # at -1: the gram carried over
            kinds[group[later_kind]] = True
            columns = (gram, doc, mark, span)
            out, out_whole = [[] for _ in columns], []
            if held is not None and kinds[-1]:
                for values, value in zip(out, held):
                    values.append(np.array([value]))
                out_whole.append(np.array([False]))
                held = None
            wanted = whole | later_kind
            wanted[firsts[kinds[:-1]]] = True
            for values, column in zip(out, columns):
                values.append(column[wanted])
            out_whole.append(whole[wanted])
            if len(firsts):
                at = firsts[-1]
                held = None if kinds[len(firsts) - 1] else tuple(column[at] for column in columns)
            last = (gram[-1], stretch[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(v)) for v in (*out, out_whole)],
                names=["gram", "doc", "mark", "span", "whole"],
            )

    return map_batches(ordered, compare, "gram long, doc long, mark long, span long, whole boolean")


def _stretches(docs: DataFrame, several: DataFrame) -> DataFrame:
    """``gram, doc, mark, span, alone, bytes`` of stretches, cut out of the texts.

    Under a gram with very many kinds of stretches, each string is a row of its
    own, ``alone`` is true and ``gram`` is a hash of the string: the strings of
    a common gram then spread over all tasks.
    """
    crowded = several.groupBy("gram").count().where(F.col("count") > CROWDED)
    several = several.join(crowded.select("gram", F.lit(True).alias("alone")), "gram", "left")
    one = F.struct("gram", "span", F.coalesce("alone", F.lit(False)).alias("alone"))
    lists = (
        several.select(F.col("doc").alias("_doc"), F.col("mark").alias("_mark"), one.alias("one"))
        .groupBy("_doc", "_mark")
        .agg(F.collect_list("one").alias("wanted"))
    )
    same = (F.col("doc") == F.col("_doc")) & (F.col("mark") == F.col("_mark"))
    rows = docs.join(lists, same).select(
        "doc", "mark", "text", *[F.col(f"wanted.{name}").alias(name) for name in ("gram", "span", "alone")]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, mark, text, *wanted in zip(*(column.to_pylist() for column in batch.columns)):
                for gram, span, alone in zip(*wanted):
                    start, n, place = (int(x) for x in _unpack(np.int64(span)))
                    part = text[start : start + n + LENGTH - 1]
                    if not alone:
                        out.append((gram, doc, mark, span, False, part))
                        continue
                    for step in range(n):
                        string = part[step : step + LENGTH]
                        key = b"%d %d " % (gram, place - step) + string
                        number = int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "big", signed=True)
                        out.append((number, doc, mark, _pack(start + step, 1, 0), True, None))
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(columns, kinds)],
                names=["gram", "doc", "mark", "span", "alone", "bytes"],
            )

    return map_batches(
        rows, cut, "gram long, doc long, mark long, span long, alone boolean, bytes binary"
    )


def repeated_strings(gram, span, parts: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """(row, first start, below last start) of strings that an earlier row holds too.

    Rows are stretches of one or several grams, sorted by gram, doc, mark and span.
    Strings under one gram are equal only at the same distance from it.
    """
    start, n, place = _unpack(span)
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    begins = np.cumsum([0, *(len(part) for part in parts)])[:-1]
    strings = hash_runs(data, LENGTH)
    row = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    with np.errstate(over="ignore"):
        key = mix(strings[begins[row] + step] + mix(gram[row], 6)) ^ mix((place[row] - step), 7)
    order = np.argsort(key, kind="stable")  # equal strings stay in order of rows
    ranked = key[order]
    repeated = np.zeros(len(key), dtype=bool)
    repeated[order[1:]] = ranked[1:] == ranked[:-1]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], repeated.view(np.int8), [0]])))
    for first, below in zip(edge[::2].tolist(), edge[1::2].tolist()):
        while first < below:  # a run may pass from one row into the next
            at = row[first]
            stop = min(below, first + int(n[at]) - int(step[first]))
            yield int(at), int(start[at] + step[first]), int(start[at] + step[first] + stop - first)
            first = stop


def compare_strings(stretches: DataFrame) -> DataFrame:
    """``doc, mark, from, below``: runs of bytes that repeat an earlier string."""
    order = ["alone", "gram", "doc", "mark", "span"]
    ordered = stretches.repartition("alone", "gram").sortWithinPartitions(*order).select(
        "gram", "doc", "mark", "span", "alone", "bytes"
    )

    def found(rows: list[tuple]) -> pa.RecordBatch:
        gram, doc, mark, span = (np.array([row[at] for row in rows], dtype=np.int64) for at in range(4))
        runs = list(repeated_strings(gram, span, [row[5] for row in rows]))
        return told(doc, mark, runs)

    def told(doc: np.ndarray, mark: np.ndarray, runs: list[tuple]) -> pa.RecordBatch:
        at = np.array([run[0] for run in runs], dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(doc[at]),
                pa.array(mark[at]),
                pa.array([run[1] for run in runs], pa.int64()),
                pa.array([run[2] + LENGTH - 1 for run in runs], pa.int64()),
            ],
            names=["doc", "mark", "from", "below"],
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        before = None  # the last string that was a row of its own
        for batch in batches:
            single = batch.filter(batch.column(4))
            if single.num_rows:
                gram, doc, mark, span = (single.column(at).to_numpy() for at in range(4))
                last = np.concatenate([[~gram[0] if before is None else before], gram[:-1]])
                again, before = np.flatnonzero(gram == last), gram[-1]
                start = _unpack(span)[0]
                yield told(doc, mark, [(at, start[at], start[at] + 1) for at in again])
            grouped = batch.filter(pa.compute.invert(batch.column(4)))
            for row in zip(*(column.to_pylist() for column in grouped.columns)):
                if len(held) >= ROUND and held[-1][0] != row[0]:
                    yield found(held)
                    held = []
                held.append(row)
        if held:
            yield found(held)

    return map_batches(ordered, compare, "doc long, mark long, from long, below long")


def _joined(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows ``doc, mark, text``; runs ``doc, mark, runs`` of repeated bytes)."""
    doubled = docs.groupBy(_doc().alias("doc")).count().where("count > 1").limit(1).count()
    # a hash of the text tells rows of one id apart; without such rows it need not be carried
    mark = F.xxhash64("text") if doubled else F.lit(0).cast("bigint")
    rows = docs.select(_doc().alias("doc"), mark.alias("mark"), as_bytes().alias("text"))
    # repeated rows share a key and must count once
    distinct_rows = rows.dropDuplicates(["doc", "mark"]) if doubled else rows
    compared = settle(compare_neighbours(suffix_rows(distinct_rows)), "suffixes")
    start, n = F.shiftright("span", 14), F.shiftright("span", 7).bitwiseAND(127)
    whole = compared.where("whole").select(
        "doc",
        "mark",
        start.alias("from"),
        (start + n + LENGTH - 1).alias("below"),
    )
    several = compared.where("not whole").select("gram", "doc", "mark", "span")
    partly = compare_strings(_stretches(distinct_rows, several))
    runs = (
        whole.unionByName(partly)
        .groupBy("doc", "mark")
        .agg(F.collect_list(F.struct("from", "below")).alias("runs"))
        .withColumnsRenamed({"doc": "_doc", "mark": "_mark"})
    )
    return rows, runs


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of byte runs; runs that touch or overlap become one."""
    found: list[tuple[int, int]] = []
    for first, below in sorted(runs):
        if found and first <= found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], below))
        else:
            found.append((first, below))
    return found


def cut_runs(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for first, below in runs:
        kept.append(text[at:first])
        at = below
    return b"".join([*kept, text[at:]])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, runs, kept``.

    A byte goes when a string of ``LENGTH`` bytes over it also starts earlier: in
    a document with a smaller doc_id, or earlier in its own. ``runs`` lists the
    removed runs [from, below), ``kept`` is what is left, as bytes. NULL texts are
    empty. Rows with a NULL doc_id come last; rows with the same id and the
    same text are one document and get the same result, rows with the same id
    and other texts come in order of a hash. Other columns are not read.
    """
    rows, runs = _joined(docs.select("doc_id", "text"))
    same = (F.col("doc") == F.col("_doc")) & (F.col("mark") == F.col("_mark"))
    joined = rows.join(runs, same, "left").select(
        "doc", "text", F.col("runs.from").alias("firsts"), F.col("runs.below").alias("belows")
    )

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, firsts, belows in zip(*(column.to_pylist() for column in batch.columns)):
                gone = merged(list(zip(firsts or (), belows or ())))
                kept = cut_runs(text, gone)
                out.append(
                    (
                        None if doc == 2**63 - 1 else doc, len(text), len(text) - len(kept), len(gone),
                        hashlib.sha256(kept).hexdigest(), [x for run in gone for x in run], kept,
                    )
                )
            columns = list(zip(*out)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(columns, kinds)], names=names
            )

    schema = (
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "runs array<long>, kept binary"
    )
    names = [column.split()[0] for column in schema.split(", ")]
    return map_batches(joined, told, schema)
