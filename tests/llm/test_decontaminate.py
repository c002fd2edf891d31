from __future__ import annotations

import hashlib
import re

import pytest
from conftest import rows
from corpus_cases import documents, prose  # noqa: F401

from statewise.llm import decontaminate as module
from statewise.llm.decontaminate import contamination, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain(docs, items):
    windows = {}
    for item, text in items:
        words = WORD.findall(lower(text))
        n = min(13, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).update([] if item is None else [str(item)])
    found = []
    for doc, text in docs:
        words, hit, named = WORD.findall(lower(text)), set(), set()
        for window, of in windows.items():
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    named |= of
        sha = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        found.append((doc, len(words), len(hit), len(named), sha, bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(found, key=str)


@pytest.fixture
def case(spark, documents, prose):
    items = [(10, prose(1, 40)), (9, "Zwei Wörter"), (11, prose(2, 13)), (12, ""), (13, None), (None, prose(3, 15)), (14, prose(2, 13))]
    docs = [
        (1, prose(1, 40), "a"),
        (2, prose(20, 30) + " " + prose(2, 13).upper().replace("É", "é") + ". " + prose(21, 30), "a"),
        (3, prose(22, 400) + " zwei, WöRTER! " + prose(23, 400), "b"),
        (4, prose(24, 200), "b"),
        (5, None, None),
        (6, "", "b"),
        (7, " ".join(prose(1, 40).split()[5:17]), "b"),  # twelve words of an item
        (8, prose(3, 15) + prose(25, 50), None),
        (8, prose(3, 15) + prose(25, 50), None),
        (None, "zwei wörter", "c"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return documents(docs), benchmark, [(d, t) for d, t, _ in docs], items


@pytest.mark.parametrize("set_windows", [200_000, 10])
def test_equals_the_plain_search(case, monkeypatch, set_windows):
    monkeypatch.setattr(module, "SET_WINDOWS", set_windows)  # many sets, one after the other
    docs, benchmark, texts, items = case
    assert rows(contamination(docs, benchmark)) == plain(texts, items)


def test_documents_or_spans_go(case):
    docs, benchmark, texts, items = case
    bad = {row[0] for row in plain(texts, items) if row[5]}
    kept = decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 5, 6, 7, 8, None} - bad
    spans = decontaminate(docs, benchmark, remove="spans")
    assert spans.count() == docs.count()
    by_id = {r.doc_id: r for r in spans.collect()}
    assert by_id[1].text == "" and by_id[1].n_chars == 0
    assert "zwei" not in by_id[3].text and by_id[3].text.endswith(texts[2][1][-100:])
    assert by_id[4].text == texts[3][1] and by_id[5].text is None
    again = contamination(spans.where("doc_id <> 8"), benchmark)
    assert again.agg({"n_hit": "sum"}).first()[0] == 0
    with pytest.raises(ValueError):
        decontaminate(docs, benchmark, remove="words")


def test_empty_tables(case):
    docs, benchmark, texts, _ = case
    assert contamination(docs.limit(0), benchmark).count() == 0
    assert rows(contamination(docs, benchmark.limit(0))) == plain(texts, [])
