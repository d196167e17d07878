from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from pageloom.llm import phrases as P


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain(rows, longest=4, least=3, first=2000, covered=80):
    """The contract word by word, from (text, lang)."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    f[lang][tuple(ws[i : i + k])] += 1
    out = []
    for lang, of in f.items():
        found = [g for g, a in of.items() if len(g) > 1 and a >= least]
        gone = set()
        for g in found:
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    if 100 * of[g] >= covered * of[g[i : i + k]]:
                        gone.add(g[i : i + k])
        scored = []
        for g in found:
            if g not in gone:
                score, k = min((2_000_000 * of[g] // (of[g[:k]] + of[g[k:]]), k) for k in range(1, len(g)))
                scored.append((-score, -of[g], " ".join(g).encode(), of[g[:k]], of[g[k:]]))
        for rank, (score, a, g, left, right) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, g.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def table(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, p int, s int, shard string, f int, id int, word string, `a.b` int"
    return spark.createDataFrame([(i, t, lang, "s", 1, *(None,) * 7) for i, (t, lang) in enumerate(rows)], schema)


def got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def text(rng, n, vocabulary):
    out = []
    for _ in range(n):
        out.append(rng.choice(vocabulary) + rng.choice([" ", " ", " ", " ", "  ", "\t", ", ", ".\n"]))
    return "".join(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    common = ["the", "of", "Data", "ÉTÉ", "été", "a\x01", "a", "x\x1fy", "zz", " "]
    made = []
    for i in range(60):
        t = text(rng, rng.randint(0, 60), common + [f"w{rng.randint(0, 400)}" for _ in range(4)])
        if i % 3 == 0:
            t += " new york city hall " + "very big very big " * rng.randint(0, 4)
        made.append((t, rng.choice(["en", "en", "en", "de", None, ""])))
    made += [(None, "en"), ("", None), (" \n\t .,", "de"), ("one", "en"), ("NEW YORK, city", "en")]
    return made + made[:7]


@pytest.mark.parametrize("size", [32 << 20, 600])
def test_equals_counting_word_by_word(spark, rows, monkeypatch, size):
    monkeypatch.setattr(P, "SHARD_BYTES", size)
    monkeypatch.setattr(P, "TASK_TOKENS", 200)
    assert got(P.collocations(table(spark, rows).repartition(5), least=3)) == plain(rows)


def test_first_rows_and_ties(spark, rows):
    found = got(P.collocations(table(spark, rows), least=3, first=5))
    assert found == plain(rows, first=5) and len(found) > 10


def test_shorter_and_longer_limits(spark, rows):
    some = rows[:30]
    for longest in (2, 5):
        assert got(P.collocations(table(spark, some), least=2, longest=longest)) == plain(some, longest=longest, least=2)


def test_products_beyond_64_bits(spark):
    row = spark.range(1).selectExpr(f"CAST({P.HIGHEST} AS DECIMAL(18,0)) * CAST(9000000000000000000L AS DECIMAL(20,0)) div CAST(9000000000000000000L AS DECIMAL(20,0)) AS q").first()
    assert row.q == P.HIGHEST


@pytest.mark.parametrize("k", [2, 3, 4, 5])
def test_index_extends_in_both_directions(k):
    rng = np.random.default_rng(k)
    symbols = rng.integers(0, 4, 500).astype(np.int32)
    windows = lambda n: Counter(tuple(symbols[i : i + n]) for i in range(len(symbols) - n + 1) if symbols[i : i + n].all())
    known = np.array(sorted(windows(k - 1)))
    keep = known[rng.random(len(known)) < 0.8]
    first, last, counts = P.longer(symbols, keep)
    found = {(*keep[a], keep[b][-1]): c for a, b, c in zip(first, last, counts)}
    there = set(map(tuple, keep))
    assert len(found) == len(counts)
    assert found == {g: c for g, c in windows(k).items() if g[:-1] in there and g[1:] in there}
    low, high = P.Index(symbols, k).search(known)
    assert list(high - low) == [windows(k - 1)[tuple(g)] for g in known]


def test_long_texts_are_cut_between_pieces():
    raw = b"aa bb. " * 50 + b"c" * 90 + b" dd\n" + b"e " * 60
    parts = list(P.cut_long(raw, 40))
    assert b"".join(parts) == raw and len(parts) > 5
    assert all(p[-1:] in b".,;:!?\n\x0b\x0c\r" for p in parts[:-1])


def test_empty_table(spark, rows):
    none = table(spark, rows).limit(0)
    assert P.collocations(none).count() == 0
    assert P.collocations(table(spark, [(None, None), ("", "en")])).count() == 0
