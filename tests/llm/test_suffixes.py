from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from corpus_cases import documents, prose  # noqa: F401

from statewise.llm import suffixes
from statewise.llm.suffixes import hash_runs, merged, remove_repeats, sliding_min


def plain(data):
    """Every 100-byte string in order of doc_id and start."""
    seen, found = set(), []
    for doc, text in sorted(data, key=lambda row: row[0]):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for start in range(len(raw) - 99):
            string = raw[start : start + 100]
            if string in seen:
                gone[start : start + 100] = [True] * 100
            seen.add(string)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        found.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return found


def result(frame):
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return [tuple(r) for r in remove_repeats(frame).select(*columns).orderBy("doc_id").collect()]


@pytest.fixture
def case(prose):
    generator = random.Random(9)
    passage, other = prose(1, 70), prose(2, 25)
    data = []
    for i in range(60):
        words = prose(100 + i, generator.randrange(5, 80)).split()
        at = generator.randrange(len(words))
        if i % 2:
            words[at:at] = passage.split()[generator.randrange(20) :]
        if i % 3 == 0:
            words[0:0] = other.split()
        data.append((i, " ".join(words)))
    data += [(70, data[5][1]), (71, data[5][1][3:]), (72, data[5][1].replace("ka", "lo"))]
    data += [(80, "ab" * 400), (81, "ab" * 60), (82, "x" * 100), (83, "x" * 99), (84, "x" * 250)]
    data += [(90, None), (91, ""), (92, "é" * 130), (93, "é" * 50), (94, "\n" + "é" * 50)]
    data += [(95, prose(3, 200) + prose(4, 30) + prose(3, 200))]
    return data


@pytest.mark.parametrize(
    "piece, rows_at_once, crowded", [(500_000, 20_000, 100_000), (150, 1, 100_000), (500_000, 20_000, 4)]
)
def test_equals_the_plain_search(documents, case, monkeypatch, piece, rows_at_once, crowded):
    monkeypatch.setattr(suffixes, "CROWDED", crowded)
    monkeypatch.setattr(suffixes, "PIECE", piece)
    monkeypatch.setattr(suffixes, "ROUND", rows_at_once)
    frame = documents([(i, t, "a") for i, t in case]).repartition(5)
    assert result(frame) == plain(case)


def test_runs_and_kept_text(documents, prose):
    text = prose(1, 60)
    frame = documents([(1, text, "a"), (2, "start " + text + " end", "a")])
    [one] = remove_repeats(frame).where("doc_id = 2").collect()
    assert one.runs == [6, 6 + len(text.encode())] and bytes(one.kept) == b"start  end"


def test_repeated_and_missing_ids(documents, prose):
    text, other = prose(1, 60), prose(2, 60)
    frame = documents([(1, text, "a"), (1, text, "a"), (2, text, "a"), (None, other, "a"), (3, other, "a")])
    n = len(text.encode())
    found = {(r.doc_id, r.n_removed) for r in remove_repeats(frame).collect()}
    assert found == {(1, 0), (2, n), (3, 0), (None, len(other.encode()))}
    assert remove_repeats(frame).count() == 5
    assert remove_repeats(documents([])).count() == 0


def test_many_texts_under_one_id(documents, prose):
    """3,000 texts without an id and 3,000 of one id: the first 18 bits of a hash are not enough."""
    texts = [f"{i} " + prose(i, 25) for i in range(3000)]
    assert min(len(text.encode()) for text in texts) >= 100
    data = [(None, text, "a") for text in texts] + [(7, text, "a") for text in texts]
    found = remove_repeats(documents(data)).select("doc_id", "n_bytes", "n_removed", "kept").collect()
    assert len(found) == 6000
    # every text without an id stands under id 7 before it and goes as a whole
    assert all(r.n_removed == r.n_bytes and not r.kept for r in found if r.doc_id is None)
    # texts of one id have no repeats among themselves
    kept = sorted(bytes(r.kept).decode() for r in found if r.doc_id == 7)
    assert kept == sorted(texts)


def test_parts():
    data = np.frombuffer(b"abcabcabd", dtype=np.uint8)
    hashes = hash_runs(data, 3)
    assert len(hashes) == 7 and hashes[0] == hashes[3] and len(set(hashes.tolist())) == 4
    assert len(hash_runs(data, 10)) == 0
    values = np.array([5, 3, 4, 1, 2, 6])
    assert sliding_min(values, 3).tolist() == [3, 1, 1, 1] and sliding_min(values, 1).tolist() == values.tolist()
    assert merged([(5, 9), (0, 3), (3, 4), (8, 12)]) == [(0, 4), (5, 12)]
