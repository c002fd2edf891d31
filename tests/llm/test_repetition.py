from __future__ import annotations

import collections
import re

import numpy as np
from conftest import rows
from corpus_cases import documents, prose  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from statewise.llm import repetition
from statewise.llm.repetition import keep_by_repetition, measure_text, repetition_measures

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """The contract's counts, written as it says them."""
    words = WORD.findall(text)
    inside = {}
    for n in (3, 5, 7, 10):
        times = collections.Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        marked = set()
        for i in range(len(words) - n + 1):
            if times[tuple(words[i : i + n])] > 1:
                marked |= set(range(i, i + n))
        inside[n] = marked
    seen, dup = set(), []
    for line in text.split("\n"):
        if WORD.search(line):
            dup += [line] if line in seen else []
            seen.add(line)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(dup),
        sum(len(w) for line in dup for w in WORD.findall(line)), len(inside[3]),
        {n: sum(len(words[i]) for i in inside[n]) for n in (5, 7, 10)},
    )


def counts(text):
    found = measure_text(text.encode())
    return (
        found.n_words, found.word_chars, found.n_symbols, found.n_dup_lines,
        found.dup_line_chars, found.n_repeat_words, found.dup_chars,
    )


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é\n\t\x0b\x0c\r\x1f# ", max_size=120))
def test_counts_equal_the_plain_ones(text):
    assert counts(text) == plain(text)


def test_long_repeats(prose):
    text = prose(1, 300) + "\n" + prose(2, 80) + "\n" + prose(2, 80) + " " + prose(1, 40)
    assert counts(text) == plain(text)


def test_equal_hashes_of_different_grams_are_told_apart(monkeypatch, prose):
    def one_hash(tokens, lengths):
        for n in sorted(set(lengths)):
            yield n, np.zeros(max(0, len(tokens) - n + 1), dtype=np.uint64)

    monkeypatch.setattr(repetition, "rolling", one_hash)
    text = prose(3, 60) + " " + prose(4, 12) + " " + prose(4, 12)
    assert counts(text) == plain(text)


def test_verdicts_and_edge_rows(spark, documents, prose):
    good, short = prose(5, 200), prose(6, 49)
    half = " ".join([prose(7, 10)] * 20)
    lines = prose(8, 60) + "\n" + "\n".join([prose(9, 55)] * 4)
    frame = documents(
        [(1, good, "a"), (1, good, "a"), (2, short, "a"), (3, half, "b"), (4, None, None), (5, "", "b"), (None, good, "b"), (6, lines, "b")]
    )
    found = repetition_measures(frame)
    assert rows(found.select("doc_id", "base_failed", "kept")) == rows(
        spark.createDataFrame(
            [(1, False, True), (1, False, True), (2, True, False), (3, True, False), (4, True, False), (5, True, False), (None, False, True), (6, True, False)],
            "a long, b boolean, c boolean",
        )
    )
    assert rows(found.where("doc_id in (4, 5)").select("n_words", "word_chars", "dup5_chars")) == [(0, 0, 0)] * 2
    kept = keep_by_repetition(frame)
    assert kept.columns == frame.columns
    assert rows(kept.select("doc_id", "n_words", "kept")) == [(1, 7, "x"), (1, 7, "x"), (None, 7, "x")]
    assert repetition_measures(frame.limit(0)).count() == 0 and keep_by_repetition(frame.limit(0)).count() == 0


def test_coverage_alone_can_reject(documents, prose):
    # Half of the words in windows found twice passes the base; coverage is stricter here.
    text = prose(10, 120) + " " + prose(11, 50) + " " + prose(12, 30) + " " + prose(11, 50)
    found = measure_text(text.encode())
    assert not found.base_failed() and found.kept({5: 50}, 40) and not found.kept({5: 30}, 40)
