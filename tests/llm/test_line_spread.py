from __future__ import annotations

import collections

import pytest
from conftest import rows
from corpus_cases import documents, prose  # noqa: F401

from statewise.llm import line_spread
from statewise.llm.line_spread import remove_shared_lines


def plain(data, least):
    sites = collections.defaultdict(set)
    for _, text, source in data:
        for line in (text or "").split("\n"):
            if source is not None:
                sites[line.strip(" \t\x0b\x0c\r")].add(source)
    found = []
    for i, text, _ in data:
        lines = (text or "").split("\n")
        bodies = [line.strip(" \t\x0b\x0c\r") for line in lines]
        gone = [body != "" and len(sites[body]) >= least for body in bodies]
        kept = text if not any(gone) else "\n".join(x for x, g in zip(lines, gone) if not g)
        found.append((i, kept, sum(b != "" for b in bodies), sum(gone)))
    return sorted(found, key=str)


@pytest.mark.parametrize("near_share", [0.15, 0.0])
def test_equals_the_plain_count(documents, prose, monkeypatch, near_share):
    monkeypatch.setattr(line_spread, "NEAR_SHARE", near_share)
    data = []
    for i in range(300):
        lines = [prose(1000 + i, 8), "  shared by many\t" if i % 2 else "shared by many", ""]
        lines += [f"line of {i % 60} sites"] if i % 60 < 12 else []
        lines += ["only nine"] if i % 30 < 9 else []
        lines += [prose(7, 5)] if i % 30 < 10 else []
        data.append((i, "\n".join(lines), f"site{i % 30}"))
    data += [(900, None, "x"), (901, "", "x"), (902, "shared by many", None), (903, "\n \n", None)]
    data += [(904, "a\nshared by many\nb\n", "y")] * 2 + [(904, "shared by many", "z"), (None, "only nine", "w")]
    frame = documents(data)
    found = remove_shared_lines(frame, least_sites=10)
    assert found.columns == [*frame.columns, "n_lines", "n_removed"]
    assert rows(found.select("doc_id", "text", "n_lines", "n_removed")) == plain(data, 10)
    for row in found.collect():
        assert row.n_chars == (None if row.text is None else len(row.text))


def test_no_python_and_empty_table(documents, plan_of):
    frame = documents([])
    found = remove_shared_lines(frame)
    assert found.count() == 0
    assert not any(word in plan_of(found) for word in ("Python", "Arrow", "Pandas"))
