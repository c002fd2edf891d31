"""Quality rules by repetition coverage.

How many characters of a text lie inside n-grams or lines that the same text
holds more than once. n-grams are found by rolling hashes in numpy; equal
hashes are compared word by word, so the counts are exact.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from statewise.llm.common import as_bytes, ascii_words, code_points, covered, map_batches, mix, rolling

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

#: Percent of a text's word characters that may lie in n-grams found twice.
MOST_COVERED = {5: 50, 7: 45, 10: 40}
#: Percent of them that may lie in lines equal to an earlier line.
MOST_IN_LINES = 40

MEASURES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, dup_line_chars long, "
)


@dataclass
class Repetition:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    dup_line_chars: int
    n_repeat_words: int
    dup_chars: dict[int, int]

    def base_failed(self) -> bool:
        return (
            self.n_words < LEAST_WORDS
            or 100 * self.n_repeat_words > MOST_REPEATED_PERCENT * self.n_words
        )

    def kept(self, most_covered: Mapping[int, int], most_in_lines: int) -> bool:
        if self.base_failed():
            return False
        if 100 * self.dup_line_chars > most_in_lines * self.word_chars:
            return False
        return all(
            100 * self.dup_chars[n] <= percent * self.word_chars
            for n, percent in most_covered.items()
        )


def _repeated(hashes: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Starts of n-grams that occur at least twice."""
    ranked = np.sort(hashes)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return np.empty(0, dtype=np.int64)
    starts = np.flatnonzero(np.isin(hashes, twice))
    order = starts[np.argsort(hashes[starts], kind="stable")]
    ranked = hashes[order]
    same = np.flatnonzero(ranked[1:] == ranked[:-1])
    first, second = order[same], order[same + 1]
    if all((ids[first + step] == ids[second + step]).all() for step in range(n)):
        return starts
    seen: dict[tuple, list[int]] = {}  # two different n-grams share a hash
    for start in range(len(hashes)):
        seen.setdefault(tuple(ids[start : start + n]), []).append(start)
    return np.array(sorted(s for starts in seen.values() if len(starts) > 1 for s in starts), dtype=np.int64)


def measure_text(text: bytes, lengths=tuple(MOST_COVERED)) -> Repetition:
    words = ascii_words(text)
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in words], dtype=np.int64)
    word_chars = code_points(text.translate(None, WHITE))

    seen: set[bytes] = set()
    n_dup_lines = dup_line_chars = 0
    for line in text.split(b"\n"):
        if not line.strip(WHITE):
            continue
        if line in seen:
            n_dup_lines += 1
            dup_line_chars += code_points(line.translate(None, WHITE))
        seen.add(line)

    n_repeat_words, dup_chars, chars = 0, dict.fromkeys(lengths, 0), None
    for n, hashes in rolling(mix(ids), {3, *lengths}):
        starts = _repeated(hashes, ids, n) if len(hashes) > 1 else hashes[:0]
        if not len(starts):
            break  # a longer n-gram found twice would hold a shorter one found twice
        inside = covered(starts, n, len(ids))
        if n == 3:
            n_repeat_words = int(inside.sum())
        if n in dup_chars:
            if chars is None:
                chars = np.array([code_points(word) for word in numbers], dtype=np.int64)[ids]
            dup_chars[n] = int(chars[inside].sum())
    return Repetition(
        n_words=len(words),
        word_chars=word_chars,
        n_symbols=len(text) - len(text.translate(None, SYMBOLS)),
        n_dup_lines=n_dup_lines,
        dup_line_chars=dup_line_chars,
        n_repeat_words=n_repeat_words,
        dup_chars=dup_chars,
    )


def repetition_measures(
    docs: DataFrame,
    most_covered: Mapping[int, int] = MOST_COVERED,
    most_in_lines: int = MOST_IN_LINES,
) -> DataFrame:
    """Measures and verdict of every row: ``doc_id``, counts, ``base_failed``, ``kept``.

    ``dup<n>_chars`` counts the word characters inside n-grams found twice or
    more, ``dup_line_chars`` those in lines equal to an earlier line. NULL and
    empty texts have no words and fail. Rows are judged one by one: repeated
    rows and repeated or NULL ids each give a row. Columns other than
    ``doc_id`` and ``text`` are not read.
    """
    lengths = tuple(most_covered)
    schema = MEASURES + ", ".join(f"dup{n}_chars long" for n in lengths)
    names = [column.split()[0] for column in schema.split(", ")]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = measure_text(text.as_py(), lengths)
                rows.append(
                    (
                        doc_id, found.n_words, found.word_chars, found.n_symbols,
                        found.n_dup_lines, found.n_repeat_words, found.base_failed(),
                        found.kept(most_covered, most_in_lines), found.dup_line_chars,
                        *(found.dup_chars[n] for n in lengths),
                    )
                )
            kinds = [pa.bool_() if n in ("base_failed", "kept") else pa.int64() for n in names]
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(columns, kinds)], names=names
            )

    return map_batches(docs.select("doc_id", as_bytes().alias("text")), measured, schema)


def keep_by_repetition(
    docs: DataFrame,
    most_covered: Mapping[int, int] = MOST_COVERED,
    most_in_lines: int = MOST_IN_LINES,
) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns, in one pass.

    NULL and empty texts do not pass; any further columns are handed through.
    """
    at = docs.columns.index("text")
    lengths = tuple(most_covered)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [
                measure_text((text.as_py() or "").encode(), lengths).kept(most_covered, most_in_lines)
                for text in batch.column(at)
            ]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return map_batches(docs, passing, docs.schema)
