"""Benchmark decontamination: benchmark windows looked up in document windows.

The distinct normalised windows of the benchmark are a broadcast hash set of
bounded size; each document is scanned once per set with rolling hashes, and
every hash hit is compared word by word. A benchmark too large for one set is
cut into several, scanned one after the other over all documents.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewise.llm.common import as_bytes, covered, map_batches, mix, rolling, unlike
from statewise.workspace import settle

WINDOW = 13
SET_WINDOWS = 200_000  # windows in one broadcast set
SET_BYTES = 32 * 2**20  # and bytes of their words and item ids

_WORD_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_NORMAL = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if byte in _WORD_BYTES else 0x20
    for byte in range(256)
)
_SPAN = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def normal_words(text: bytes) -> list[bytes]:
    """Words of lower-cased UTF-8: digits, a to z and all code points from U+0080."""
    return text.translate(_NORMAL).split()


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows with their item ids: ``window`` binary, ``n`` int, ``items``.

    An item of fewer words than ``window`` is one window; an item without words
    has none. Items are sorted distinct ids as text; a NULL id names no item.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ns, ids = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = normal_words(text)
                n = min(window, len(words))
                for start in range(len(words) - n + 1 if n else 0):
                    found.append(b" ".join(words[start : start + n]))
                    ns.append(n)
                    ids.append(item)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), pa.array(ns, pa.int32()), pa.array(ids, pa.string())],
                names=["window", "n", "item"],
            )

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), as_bytes().alias("text"))
    return (
        map_batches(rows, cut, "window binary, n int, item string")
        .groupBy("window", "n")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


class WindowSet:
    """Windows of one broadcast set, ready for scanning."""

    def __init__(self, rows):
        self.items = {bytes(row["window"]): tuple(row["items"]) for row in rows}
        words = sorted({word for window in self.items for word in window.split(b" ")})
        self.ids = {word: number for number, word in enumerate(words, start=1)}
        hashes: dict[int, list] = {}
        for row in rows:
            hashes.setdefault(row["n"], []).append(self._hash(bytes(row["window"]).split(b" ")))
        self.hashes = {n: np.unique(np.array(h, dtype=np.uint64)) for n, h in hashes.items()}

    def _tokens(self, words: list[bytes]) -> np.ndarray:
        get = self.ids.get
        return mix(np.array([get(word, 0) for word in words], dtype=np.int64))

    def _hash(self, words: list[bytes]) -> int:
        [(_, value)] = rolling(self._tokens(words), [len(words)])
        return int(value[0])

    def scan(self, words: list[bytes], hit: np.ndarray, items: set[str]) -> None:
        """Mark in ``hit`` every word inside a window; add the windows' items."""
        if not words or not self.hashes:
            return
        for n, hashes in rolling(self._tokens(words), self.hashes):
            known = self.hashes[n]
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            starts = []
            for start in np.flatnonzero(known[at] == hashes):
                of = self.items.get(b" ".join(words[start : start + n]))
                if of is not None:
                    starts.append(start)
                    items.update(of)
            if starts:
                hit |= covered(np.array(starts), n, len(words))


def _sets(benchmark: DataFrame, window: int) -> list:
    """Broadcast window sets, each of at most the bounds above."""
    windows = settle(benchmark_windows(benchmark, window), "windows")
    weight = F.octet_length("window") + F.coalesce(F.octet_length(F.array_join("items", ",")), F.lit(0))
    size = windows.agg(F.count("*").alias("rows"), F.sum(weight).alias("bytes")).first()
    parts = max(-(-size["rows"] // SET_WINDOWS), -(-(size["bytes"] or 0) // SET_BYTES), 1)
    parts = parts if parts == 1 else 2 * parts  # hashing does not cut evenly
    context = benchmark.sparkSession.sparkContext
    part = F.pmod(F.xxhash64("window"), F.lit(parts))
    return [
        context.broadcast(WindowSet(windows.where(part == number).collect()))
        for number in range(parts)
    ]


def _scan(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """``docs`` with two last columns: hits (word numbers in pairs: from, below) and items."""
    sets = _sets(benchmark, window)
    columns = docs.columns
    hits, items = unlike(columns, "_hits", "_items")
    found = docs.select(
        *columns,
        F.array().cast("array<int>").alias(hits),
        F.array().cast("array<string>").alias(items),
    )
    text_at = columns.index("text")

    def scanner(window_set):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                all_hits, all_items = [], []
                for text, hits, items in zip(
                    batch.column(text_at), batch.column(-2).to_pylist(), batch.column(-1).to_pylist()
                ):
                    words = normal_words((text.as_py() or "").encode())
                    hit, named = np.zeros(len(words), dtype=bool), set(items)
                    for first, below in zip(hits[::2], hits[1::2]):
                        hit[first:below] = True
                    window_set.value.scan(words, hit, named)
                    all_hits.append(_runs(hit))
                    all_items.append(sorted(named))
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:-2],
                        pa.array(all_hits, pa.list_(pa.int32())),
                        pa.array(all_items, pa.list_(pa.string())),
                    ],
                    names=batch.schema.names,
                )

        return scan

    for number, window_set in enumerate(sets):
        if number:
            found = settle(found, "scanned")  # one set at a time in memory
        found = map_batches(found, scanner(window_set), found.schema)
    return found


def _runs(hit: np.ndarray) -> list[int]:
    if not hit.any():
        return []
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return edges.tolist()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A document is contaminated when at least one word and at least a twentieth
    of its words lie inside benchmark windows. NULL and empty texts have no
    words; an empty benchmark hits nothing. Every row gives a row, also repeated
    ones; other columns are not read.
    """
    found = _scan(docs.select("doc_id", "text"), benchmark, window)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, hits, items in zip(
                batch.column(0).to_pylist(), batch.column(1), *(c.to_pylist() for c in batch.columns[2:])
            ):
                n_words = len(normal_words((text.as_py() or "").encode()))
                n_hit = sum(hits[1::2]) - sum(hits[::2])
                named = hashlib.sha256(",".join(items).encode()).hexdigest()
                rows.append(
                    (doc_id, n_words, n_hit, len(items), named, is_contaminated(n_words, n_hit))
                )
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(columns, kinds)], names=names
            )

    schema = (
        "doc_id long, n_words long, n_hit long, n_items long, "
        "items_sha256 string, contaminated boolean"
    )
    names = [column.split()[0] for column in schema.split(", ")]
    return map_batches(found, told, schema)


def is_contaminated(n_words: int, n_hit: int) -> bool:
    return n_hit > 0 and 20 * n_hit >= n_words


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW
) -> DataFrame:
    """``docs`` without contamination, all other columns as they are.

    ``remove="documents"`` drops contaminated documents and leaves all others
    untouched; ``"spans"`` keeps every document and cuts each hit run of words
    out of its text (``n_chars``, where present, follows). NULL texts stay.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove documents or spans, not {remove}")
    found = _scan(docs, benchmark, window)
    columns = docs.columns
    schema = docs.schema
    text_at = columns.index("text")
    count_at = columns.index("n_chars") if "n_chars" in columns else None

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = batch.column(-2).to_pylist()
            plain = batch.select(columns)
            if remove == "documents":
                clean = []
                for text, runs in zip(plain.column(text_at), hits):
                    n_hit = sum(runs[1::2]) - sum(runs[::2])
                    bad = n_hit and is_contaminated(len(normal_words(text.as_py().encode())), n_hit)
                    clean.append(not bad)
                yield plain.filter(pa.array(clean, pa.bool_()))
                continue
            texts = [cut_words(text, runs) for text, runs in zip(plain.column(text_at).to_pylist(), hits)]
            arrays = list(plain.columns)
            arrays[text_at] = pa.array(texts, pa.string())
            if count_at is not None:
                counts = [
                    len(text) if runs else count
                    for text, runs, count in zip(texts, hits, plain.column(count_at).to_pylist())
                ]
                arrays[count_at] = pa.array(counts, plain.schema.field(count_at).type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return map_batches(found, without, schema)


def cut_words(text: str | None, runs: list[int]) -> str | None:
    """``text`` without the words of the given runs and what stands between them."""
    if not runs:
        return text
    raw = text.encode()
    spans = [match.span() for match in _SPAN.finditer(raw)]
    kept, at = [], 0
    for first, below in zip(runs[::2], runs[1::2]):
        kept.append(raw[at : spans[first][0]])
        at = spans[below - 1][1]
    return b"".join([*kept, raw[at:]]).decode()
