from __future__ import annotations

import itertools
import random

import pytest
from conftest import rows
from corpus_cases import documents, prose  # noqa: F401

from statewise.llm import ngram_join as module
from statewise.llm.components import components
from statewise.llm.ngram_join import keep_one_of_each, near_duplicates


def edited(text, generator, n):
    words = text.split()
    for _ in range(n):
        words[generator.randrange(len(words))] = f"new{generator.randrange(10**6)}"
    return " ".join(words)


def grams(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(data):
    """Links by comparing all pairs of rows; classes by joining links."""
    sets = [grams(text) for _, text in data]
    parent, links = list(range(len(data))), [0] * len(data)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(data)), 2):
        common = len(sets[i] & sets[j])
        if common and common >= 0.8 * (len(sets[i]) + len(sets[j]) - common) - 1e-9:
            links[i] += 1
            links[j] += 1
            parent[root(i)] = root(j)
    classes = {}
    for i, (doc, _) in enumerate(data):
        if doc is not None:
            classes[root(i)] = min(classes.get(root(i), doc), doc)
    return sorted(((doc, classes.get(root(i)), links[i]) for i, (doc, _) in enumerate(data)), key=str)


@pytest.fixture
def case(prose):
    generator = random.Random(4)
    data, doc = [], 0
    passage = prose(999, 30)
    for group in range(12):
        base = prose(group, generator.randrange(40, 200))
        for _ in range(generator.randrange(1, 8)):
            data.append((doc, edited(base, generator, generator.randrange(0, 5))))
            doc += 1
    crowd = prose(500, 120)
    data += [(1000 + i, edited(crowd, generator, 1 + i % 4)) for i in range(90)]
    data += [(2000 + i, prose(3000 + i, 60) + " " + passage) for i in range(90)]
    data += [(3000, prose(1, 4)), (3001, prose(1, 4)), (3002, prose(1, 3)), (3003, None), (3004, "")]
    data += [(3005, prose(60, 50)), (3005, prose(60, 50)), (None, prose(61, 50)), (3006, prose(61, 50))]
    return data


@pytest.mark.parametrize("small, block", [(64, 512), (4, 16)])
def test_equals_all_pairs(documents, case, monkeypatch, small, block):
    monkeypatch.setattr(module, "SMALL", small)  # deep paths and cut buckets
    monkeypatch.setattr(module, "BLOCK", block)
    frame = documents([(i, t, "a") for i, t in case])
    assert rows(near_duplicates(frame)) == plain(case)


def test_one_of_each_stays(documents, case):
    frame = documents([(i, t, "a") for i, t in case if i is not None])
    kept = keep_one_of_each(frame)
    assert kept.columns == frame.columns
    found = sorted(r.doc_id for r in kept.collect())
    classes = {c for _, c, _ in plain([(i, t) for i, t in case if i is not None])}
    assert found == sorted(classes)


def test_empty_table(documents):
    assert near_duplicates(documents([])).count() == 0
    assert keep_one_of_each(documents([])).count() == 0
    assert rows(near_duplicates(documents([(1, None, "a"), (2, "", None)]))) == [(1, 1, 0), (2, 2, 0)]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (None, 3), (200, 199), (199, 200)], "a int, b int")
    expected = [(i, 0) for i in range(41)] + [(100 + i, 100) for i in range(30)] + [(199, 199), (200, 199)]
    assert rows(components(links)) == sorted(expected, key=str)
    assert components(links.limit(0)).count() == 0
