"""Fixtures of the corpus tests."""

from __future__ import annotations

import random

import pytest


@pytest.fixture
def documents(spark):
    """A frame of documents from (doc_id, text, source) rows, with clashing columns."""

    def make(rows):
        data = [(i, t, "en", s, None if t is None else len(t), 7, "x") for i, t, s in rows]
        return spark.createDataFrame(
            data,
            "doc_id long, text string, lang string, source string, n_chars long, "
            "n_words long, kept string",
        )

    return make


@pytest.fixture
def prose():
    """prose(seed, n): n invented words, the same for the same seed."""

    def make(seed, n):
        generator = random.Random(seed)
        parts = ["ka", "lo", "mi", "ré", "tu", "sen", "dor"]
        return " ".join(
            "".join(generator.choice(parts) for _ in range(generator.randint(2, 5))) for _ in range(n)
        )

    return make
