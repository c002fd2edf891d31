from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from corpus_cases import documents, prose  # noqa: F401
from pyspark.sql import functions as F

from statewise.llm import exact_copies
from statewise.llm.exact_copies import drop_copies, find_copies, grow_directory


def plain(rows):
    """(doc_id, keep_id, size, text digest) of each row, sorted."""
    groups = defaultdict(list)
    for doc_id, text, _ in rows:
        groups[text or ""].append(doc_id)
    found = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        found += [(doc_id, keep, len(ids), sha) for doc_id in ids]
    return sorted(found, key=str)


def assert_right(df, rows):
    got = df.collect()
    assert sorted(((r["id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == plain(rows)
    kept = [r for r in got if r["kept"]]
    assert all(r["id"] == r["keep_id"] for r in kept)
    assert len(kept) == len({r["text_sha256"] for r in kept}) == len({text or "" for _, text, _ in rows})


@pytest.fixture
def rows(prose):
    hot = [(i, "the same text", "hot") for i in range(0, 900, 3)]
    pairs = [(i, f"text {i // 7}", "web") for i in range(1, 900, 3)]
    odd = [
        (10_000, None, "a"), (10_001, "", "a"), (10_002, " ", "a"), (10_003, "É", "a"), (10_004, "É", "a"),
        (10_005, "é", "a"), (None, "text 3", None), (None, "no id", None), (None, "no id", None),
        (10_006, "twice", "a"), (10_006, "twice", "a"), (10_006, "another text of this id", "a"),
        (10_007, prose(1, 20_000), "a"), (10_008, prose(1, 20_000), "a"), (10_009, prose(1, 20_000) + " ", "a"),
    ]
    return hot + pairs + odd


@pytest.mark.parametrize("bucket, bits", [(16 * 2**20, 16), (4_000, 16), (4_000, 3)])
@pytest.mark.parametrize("key", ["good", "poor", "same"])
def test_groups_are_the_equal_texts(spark, documents, rows, monkeypatch, bucket, bits, key):
    monkeypatch.setattr(exact_copies, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(exact_copies, "OWNER_BYTES", 3 * bucket)
    monkeypatch.setattr(exact_copies, "MOST_BUCKETS", 64)
    monkeypatch.setattr(exact_copies, "MOST_BITS", bits)
    keys = {
        "good": F.xxhash64,
        "poor": lambda text: F.shiftleft((F.length(text) % 8).cast("bigint"), 61),
        "same": lambda text: F.lit(5),
    }
    assert_right(find_copies(documents(rows), key_of=keys[key]), rows)


def test_overfull_buckets_are_split_and_the_directory_doubles(spark, monkeypatch):
    monkeypatch.setattr(exact_copies, "MOST_BITS", 6)
    sizes = spark.createDataFrame([(slot, 100 if slot < 8 else 1) for slot in range(64)], "slot long, bytes long")
    directory, bits = grow_directory(sizes, 210)
    got = {row["slot"]: (row["bucket"], row["bytes"]) for row in directory.collect()}
    # The crowded eighth is split down to buckets of two fine slots, the rest to what fits.
    assert bits == 5 and len(got) == 32
    assert [got[slot] for slot in range(4)] == [(0, 200), (2, 200), (4, 200), (6, 200)]
    assert {got[slot] for slot in range(4, 8)} == {(8, 8)}
    assert {got[slot] for slot in range(16, 32)} == {(32, 32)}
    assert grow_directory(sizes, 10)[1] == 6  # no bits are left, the crowded slots stay


def test_extra_columns_stay_as_they_are(spark, documents, rows):
    names = ["id", "key", "row", "text_sha256", "payload", "owner", "bucket", "slot", "keep", "size", "part"]
    docs = documents(rows).withColumns({name: F.concat(F.lit(name), F.col("source")) for name in names})
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    assert kept.exceptAll(docs).count() == 0
    assert kept.count() == len({text or "" for _, text, _ in rows})


def test_empty_table(documents):
    empty = exact_copies.exact_copies(documents([(1, "a", "b")]).limit(0))
    assert empty.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert empty.count() == 0


def test_no_python_in_the_plan(documents, rows, plan_of):
    plan = plan_of(find_copies(documents(rows)))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
