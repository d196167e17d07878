from __future__ import annotations

import base64
import hashlib
import random
import re

import pytest

from pageloom.llm import warc as W

SCHEMA = "page_id long, url string, html string, digest int, time string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def round_trip(spark, pages, path, **options):
    df = spark.createDataFrame([(*p, 1, "x") for p in pages], SCHEMA)
    n = W.write(df, path, **options)
    rows = sorted(W.capture_histories(spark, path, n).collect(), key=lambda r: (r.part, r.place))
    assert [W.order(tuple(r)) for r in rows] == sorted(W.order(tuple(r)) for r in rows)
    return rows


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "MERGE_ROWS", 5)
    pages = [
        (1, "http://a.b/x\ny", "<p>é\r\n\r\nWARC/1.1\r\n"), (2, None, None), (3, "u", ""), (4, "u", ""), (None, "u", ""),
        (7, "http://a.b/x y", "<p>é\r\n\r\nWARC/1.1\r\n"), (8, "q", "same"), (8, "q", "same"), (9, "http://[bad", "\n"), (10, "http://www.A.b/", "z" * 900_000),
    ]
    rows = round_trip(spark, pages, f"{tmp_path}/w", archive_bytes=2_000)
    assert len({r.archive for r in rows}) > 1
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest) for r in rows), key=str) == sorted(((i, len((h or "").encode()), digest(h)) for i, _, h in pages), key=str)
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in rows}
    assert kinds == {(1, "revisit", 7), (7, "response", None), (2, "revisit", 4), (3, "revisit", 4), (4, "response", None), (None, "revisit", 4), (8, "response", None), (9, "response", None), (10, "response", None)}
    for r in rows:  # the index leads to the record
        raw = open(r.archive.removeprefix("file:"), "rb").read()[r["at"] : r["at"] + r.size]
        (headers, at, size, block), = W.records(raw)
        assert (at, size) == (0, r.size) and headers["WARC-Record-ID"] == f"<urn:page:{'' if r.page_id is None else r.page_id}>"
        html = next(h for i, _, h in pages if i == r.page_id)
        assert block.partition(b"\r\n\r\n")[2] == (b"" if r.record_type == "revisit" else (html or "").encode())


def test_small_payloads_do_not_revisit(spark, tmp_path):
    rows = round_trip(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], f"{tmp_path}/w", min_bytes=3)
    assert [r.record_type for r in sorted(rows, key=lambda r: r.page_id)] == ["response", "response", "revisit", "response"]


def test_large_and_negative_ids(spark, tmp_path):
    ids = [9 * 10**18, -9 * 10**18, 10**13, 10**12, -1, 2**63 - 1, -(2**63)]
    rows = round_trip(spark, [(i, f"http://a/{i}", "same" if i > 0 else str(i)) for i in ids], f"{tmp_path}/w")
    assert {r.page_id for r in rows} == set(ids)
    assert {(r.page_id, r.refers_to) for r in rows if r.record_type == "revisit"} == {(i, 2**63 - 1) for i in ids if 0 < i < 2**63 - 1}
    for r in rows:
        raw = open(r.archive.removeprefix("file:"), "rb").read()[r["at"] : r["at"] + r.size]
        (headers, *_), = W.records(raw)
        assert re.fullmatch(r"20[2-5]\d-\d\d-\d\dT\d\d:\d\d:\d\dZ", headers["WARC-Date"])


def test_empty(spark, tmp_path):
    assert round_trip(spark, [], f"{tmp_path}/w") == []


def test_damaged_archives_are_noticed():
    good = b"WARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    assert len(list(W.records(good * 3))) == 3
    for bad in (good[:-1], good.replace(b"2", b"3"), b"x" + good):
        with pytest.raises((ValueError, IndexError)):
            list(W.records(bad))


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rng = random.Random(k)
    row = lambda i, j: (rng.choice("abc"), str(rng.randint(0, 9)), rng.choice([None, 1, 2]), "", "", 0, 0, "", str(i), j)
    sources = [sorted((row(i, j) for j in range(rng.randint(0, 12))), key=W.order) for i in range(k)]
    assert list(W.LoserTree(sources)) == sorted((x for s in sources for x in s), key=W.order)


def test_url_keys():
    assert W.url_key("http://www.Example.com/A?b=C") == "com,example)/a?b=c" and W.url_key("https://x.y") == "y,x)/"
