from __future__ import annotations

import random

import pytest

CLASHING = "id string, key string, spans int, size string, h int, fp int, kept string, odd int, rank int, code string, source2 int, `a.b` int"


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture
def odd_texts():
    """Nulls, blanks, one word, ties, repeats, unusual white space, a very long text."""
    base = words(1, 120)
    return [
        None, "", " \n\t ", "word", "two words", base, base, base.upper(), base + " x", "\x1f é😀 a\x0bb\x0cc\rd",
        words(2, 200_000), "a" * 1_500_000, words(3, 60) + "\n" + words(4, 60),
    ]


@pytest.fixture
def documents(spark):
    """Documents of some texts; extra columns have names that operators use themselves."""

    def make(texts, ids=None, sources=None):
        ids = list(range(len(texts))) if ids is None else ids
        sources = [f"s{i % 3}" for i in range(len(texts))] if sources is None else sources
        extra = (None,) * 12
        rows = [(i, t, "en", s, len(t or ""), *extra) for i, t, s in zip(ids, texts, sources)]
        return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")

    return make
