from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus_cases import documents, prose  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from statewise.llm import alignment
from statewise.llm.alignment import align_and_score, align_documents, common_ends, linked_pairs

FILES = alignment._contents(alignment.TOKENIZERS, alignment.BYTE_BPE, alignment.PIECE_BPE)


@pytest.fixture(scope="module")
def exact():
    tokenizer = Tokenizer.from_str(FILES[0].decode())
    tokenizer.encode_special_tokens = True
    return tokenizer


def plain_groups(text, exact):
    """[(A ids, B ids)] by walking both token lists byte by byte."""
    (a, _, _), (b, _, _) = alignment._tokenizers(*FILES)
    raw = f" {text}".encode()
    a_ids, b_ids = exact.encode(f" {text}", add_special_tokens=False).ids, b.encode(text or "").tolist()
    if not text or any(b"".join(t.pieces[i] for i in ids) != raw for t, ids in ((a, a_ids), (b, b_ids))):
        return []
    ends = [set(np.cumsum([len(t.pieces[i]) for i in ids]).tolist()) for t, ids in ((a, a_ids), (b, b_ids))]
    cuts = sorted(ends[0] & ends[1])
    groups = [([], []) for _ in cuts]
    for side, (tokenizer, ids) in enumerate(((a, a_ids), (b, b_ids))):
        at = group = 0
        for number in ids:
            at += len(tokenizer.pieces[number])
            groups[group][side].append(number)
            group += at == cuts[group]
    return groups


def plain(rows, exact):
    docs = [(doc_id, plain_groups(text, exact)) for doc_id, text, _ in rows]
    links = [[(a, b) for left, right in groups for a in left for b in right] for _, groups in docs]
    counts = Counter(pair for pairs in links for pair in set(pairs))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    found = []
    for (doc_id, groups), pairs in zip(docs, links):
        text = ";".join(f"{','.join(map(str, left))}|{','.join(map(str, right))}" for left, right in groups)
        found.append((
            doc_id, sum(len(left) for left, _ in groups), sum(len(right) for _, right in groups), len(groups),
            len(pairs), sum(counts[pair] == most[pair[0]] for pair in pairs), sum(counts[pair] for pair in pairs),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return sorted(found, key=str)


@pytest.fixture
def rows(prose):
    texts = [
        None, "", " ", "a", "plain words, twice", "plain words, twice", "  two  spaces\n\n\tand tabs ", "▁ a marker",
        "中文字 и русский 😀😀 ñandú", "<s> <|endoftext|> </s> <0x0A> \x00\x7f", "ﬁ ligature Ⅳ", "a" * 3000,
        "ab " * 2000, "$$$***" * 400, " " * 500, prose(3, 3000), "don't we'll I'VE",
    ]
    many = [(100 + i, prose(i % 40, 30) + " common words", "hot") for i in range(200)]
    return [(i, text, "a") for i, text in enumerate(texts)] + [(None, "no id", None), (7, "same id", "b")] + many


@pytest.mark.parametrize("frequent, block", [(500_000, 2**20), (50, 2**20), (50, 40)])
def test_equals_the_walk_over_bytes(documents, rows, exact, monkeypatch, frequent, block):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    monkeypatch.setattr(alignment, "BLOCK", block)
    got = align_and_score(documents(rows)).collect()
    assert sorted((tuple(row) for row in got), key=str) == plain(rows, exact)


def test_groups_are_given_in_full(documents, exact):
    rows = [(1, "some plain words", "a"), (2, None, "a")]
    got = {r["doc_id"]: r for r in align_documents(documents(rows), with_groups=True).collect()}
    groups = plain_groups("some plain words", exact)
    text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
    assert got[1]["groups"] == text
    assert got[1]["groups_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert (got[2]["groups"], got[2]["groups_sha256"], got[2]["codes"]) == ("", "", [])


def test_empty_table(documents):
    empty = align_and_score(documents([(1, "a", "b")]).limit(0))
    assert empty.columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    ]
    assert empty.count() == 0


@given(st.sets(st.integers(0, 300)), st.sets(st.integers(0, 300)))
def test_galloping_finds_all_common_values(a, b):
    a, b = sorted(a), sorted(b)
    in_a, in_b = common_ends(a, b)
    assert [a[i] for i in in_a] == [b[i] for i in in_b] == sorted(set(a) & set(b))


group = st.tuples(st.lists(st.integers(0, 9), min_size=1, max_size=9), st.lists(st.integers(0, 7), min_size=1, max_size=9))


@given(st.lists(group, max_size=6), st.integers(1, 200))
def test_pairs_in_blocks(groups, block):
    a, b = ([i for pair in groups for i in pair[side]] for side in (0, 1))
    sizes = [np.array([len(pair[side]) for pair in groups], dtype=np.int64) for side in (0, 1)]
    want = Counter(x * 8 + y for left, right in groups for x in left for y in right)
    keep, alignment.BLOCK = alignment.BLOCK, block
    try:
        got = [
            (int(code), int(n))
            for codes, times in linked_pairs(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64), *sizes, 8)
            for code, n in zip(codes, times)
        ]
    finally:
        alignment.BLOCK = keep
    assert len(got) == len(dict(got)) and dict(got) == want


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ranks_and_merges_give_the_same_tokens(exact, text):
    (a, _, _), _ = alignment._tokenizers(*FILES)
    assert a.encode(" " + text).tolist() == exact.encode(" " + text, add_special_tokens=False).ids
    latin = "".join(chr(ord(c) % 0x250) for c in text)
    assert a.encode(" " + latin).tolist() == exact.encode(" " + latin, add_special_tokens=False).ids
