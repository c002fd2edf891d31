from __future__ import annotations

import hashlib
from collections import defaultdict
from zlib import crc32

import pytest

from statewise.llm import manifest
from statewise.llm.manifest import audit_documents


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    values = (doc_id, source, lang, n_chars, text)
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(hashes):
    found = [hashes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([digest(*last[i : i + 16]) for i in range(0, len(last), 16)])
    return found


def path(found, place):
    """(siblings to the left, to the right) on each level."""
    for level in found[:-1]:
        run = level[place // 16 * 16 :][:16]
        yield run[: place % 16], run[place % 16 + 1 :]
        place //= 16


def plain(rows):
    """The audit by walking every path; rows are (doc_id, text, lang, source, n_chars)."""
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        own = leaf(doc_id, source, lang, n_chars, text)
        folded = own
        if doc_id is not None and crc32(str(doc_id).encode()) % 5 == 0 and text is not None:
            lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf(doc_id, source, lang, n_chars, lowered)
        groups[source].append(((doc_id is not None, doc_id, own, folded)))
    order = sorted(groups, key=lambda source: (source is not None, (source or "").encode()))
    trees = {source: levels([row[2] for row in sorted(groups[source])]) for source in order}
    top = levels([trees[source][-1][0] for source in order])
    found = []
    for rank, source in enumerate(order):
        for place, (_, doc_id, own, folded) in enumerate(sorted(groups[source])):
            siblings = [*path(trees[source], place), *path(top, rank)]
            for left, right in siblings:
                folded = digest(*left, folded, *right)
            proof = digest(*(h for left, right in siblings for h in left + right))
            root = top[-1][0]
            found.append((doc_id, own, trees[source][-1][0], root, proof, folded, folded == root))
    return sorted(found, key=str)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(n, sources):
    return [
        (i * 3, f"Text number {i}" if i % 7 else f"lower {i}", "en", sources[i % len(sources)], i)
        for i in range(n)
    ]


ODD = [
    (1, None, None, None, None),
    (None, "X", "en", "a", 1),
    (2, "", "", "", 0),
    (3, "É" * 50_000, "fr", "a", 7),
    *[(5, "Same", "en", "a", 4)] * 20,
]


@pytest.mark.parametrize(
    "rows, high",
    [
        (corpus(1, ["a"]), 20_000),
        (corpus(40, [None]), 20_000),
        (corpus(600, ["a", "a", "a", "Ä", None, "-", "="]), 3),
        (corpus(60, [f"s{i}" for i in range(40)]), 20_000),
        (ODD, 3),
    ],
    ids=["one", "null source", "hot source", "many sources", "nulls and repeats"],
)
def test_equals_walking_every_path(spark, monkeypatch, rows, high):
    monkeypatch.setattr(manifest, "HIGH_NODES", high)
    got = audit_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(row) for row in got), key=str) == plain(rows)


def test_reads_no_other_columns_and_takes_an_empty_table(spark):
    rows = corpus(30, ["a", "b"])
    names = ["row", "tree", "pos", "hash", "claim", "id", "n", "level", "place", "slot", "step"]
    wide = spark.createDataFrame([(*row, *["x"] * len(names)) for row in rows], SCHEMA + "".join(f", {n} string" for n in names))
    assert sorted((tuple(row) for row in audit_documents(wide).collect()), key=str) == plain(rows)
    empty = audit_documents(wide.limit(0))
    assert empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert empty.count() == 0
