from __future__ import annotations

import json
import sys
from datetime import date, timedelta

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pageloom.plans.config import resolve
from pageloom.plans.run import Ingest, masked
from pageloom.sources.paged import Pull, read_pulls
from pageloom.sources.transports import HttpFetch, Response

# Functions of this file run in Python workers, which do not have it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def config(out, table, **shared):
    return {
        "envs": {"dev": {"base_url": "https://h/"}},
        "apis": {"output": {"format": "jsonl", "path": str(out)}, "t": table, **shared},
    }


def run(spark, tmp_path, table, answer, start=None, end=None, **shared):
    """Rows written and the manifest; ``answer(url, params, headers)`` gives a body."""

    def fetch(url, params, headers):
        got = answer(url, params, headers)
        return got if isinstance(got, Response) else Response(
            200, {}, got if isinstance(got, str) else json.dumps(got)
        )

    job = Ingest(spark, config(tmp_path / "out", table, **shared), fetch)
    told = job.run_backfill("t", "dev", start, end) if start else job.run_once("t", "dev")
    rows = spark.read.json(told["path"]).collect() if told["rows"] else []
    return [r.asDict(recursive=True) for r in rows], told


def by(rows, *names):
    return sorted([tuple(r.get(n) for n in names) for r in rows], key=str)


PARSE = {"type": "json", "json_record_path": "data"}


def test_single(spark, tmp_path):
    rows, told = run(spark, tmp_path, {"path": "v1/x", "parse": PARSE},
                     lambda u, p, h: {"data": [{"id": 1}, {"id": 2}]})
    assert by(rows, "id") == [(1,), (2,)]
    assert (told["rows"], told["source_url"], told["pagination_mode"]) == (2, "https://h/v1/x",
                                                                           "none")
    assert told["bytes"] > 0 and told["duration_s"] > 0


def test_page_mode(spark, tmp_path):
    table = {"parse": PARSE, "pagination": {"mode": "page", "stripes": 2}}
    rows, _ = run(spark, tmp_path, table,
                  lambda u, p, h: {"data": [{"id": p["page"]}] if p["page"] < 6 else []})
    assert by(rows, "id") == [(i,) for i in range(1, 6)]


def test_cursor_mode_and_headers(spark, tmp_path):
    def answer(url, params, headers):
        assert headers == {"Authorization": "k", "X": "table"}
        n = int(params.get("cursor", "t0")[1:])
        return {"data": [{"id": n}], "meta": {"next": f"t{n + 1}" if n < 3 else None}}

    table = {
        "parse": PARSE,
        "headers": {"X": "table"},
        "pagination": {"mode": "cursor", "next_cursor_path": "meta.next"},
    }
    rows, _ = run(spark, tmp_path, table, answer,
                  request_defaults={"headers": {"Authorization": "k", "X": "default"}})
    assert by(rows, "id") == [(0,), (1,), (2,), (3,)]


def test_link_header_mode(spark, tmp_path):
    def answer(url, params, headers):
        n = int(url[-1])
        link = {"Link": f'<https://h/p{n + 1}>; rel="next"'} if n < 3 else {}
        return Response(200, link, json.dumps({"data": [{"id": n}]}))

    table = {"path": "p1", "parse": PARSE, "pagination": {"mode": "link-header"}}
    assert by(run(spark, tmp_path, table, answer)[0], "id") == [(1,), (2,), (3,)]


def test_error_status_fails_the_run(spark, tmp_path):
    with pytest.raises(RuntimeError, match="status 503"):
        run(spark, tmp_path, {"parse": PARSE}, lambda u, p, h: Response(503, {}, "busy"))


def test_malformed_body_fails_the_run(spark, tmp_path):
    with pytest.raises(ValueError, match="not JSON"):
        run(spark, tmp_path, {"parse": PARSE}, lambda u, p, h: "<html>")


def test_multi_pull_join(spark, tmp_path):
    table = {
        "path": "v1/base",
        "params": {"all": 1, "k": "table"},
        "multi_pulls": [
            {"name": "l", "parse": PARSE, "params": {"k": "l"}},
            {"name": "r", "path": "v1/r", "parse": {"type": "csv"}},
        ],
        "join": {"how": "left", "on": ["id"],
                 "select_from": {"r": {"keep": ["y"], "rename": {"y": "why"}}}},
    }

    def answer(url, params, headers):
        assert params["all"] == 1
        if url.endswith("v1/r"):
            assert params["k"] == "table"
            return "id,y,z\n1,10,7\n3,30,7\n"
        assert params["k"] == "l"
        return {"data": [{"id": 1}, {"id": 2}]}

    rows, _ = run(spark, tmp_path, table, answer)
    assert by(rows, "id", "why", "z") == [(1, 10, None), (2, None, None)]


def day_echo(url, params, headers):
    a, b = date.fromisoformat(params["start_date"]), date.fromisoformat(params["end_date"])
    return [{"day": str(a + timedelta(days=i))} for i in range((b - a).days + 1)]


def test_date_backfill(spark, tmp_path):
    table = {"backfill": {"enabled": True, "window_days": 2}}
    rows, told = run(spark, tmp_path, table, day_echo, date(2024, 1, 1), date(2024, 1, 5))
    assert by(rows, "day") == [(f"2024-01-0{i}",) for i in range(1, 6)]
    assert (told["windows"], told["strategy"]) == (3, "date")


def test_date_backfill_joined_per_window(spark, tmp_path):
    def answer(url, params, headers):
        # Every window answers the same key; rows must only meet within a window.
        return [{"k": 1, url[-1]: params["start_date"]}]

    table = {
        "multi_pulls": [{"name": "a", "path": "a"}, {"name": "b", "path": "b"}],
        "join": {"on": ["k"]},
        "backfill": {"enabled": True, "window_days": 1},
    }
    rows, _ = run(spark, tmp_path, table, answer, date(2024, 1, 1), date(2024, 1, 3))
    days = [f"2024-01-0{i}" for i in (1, 2, 3)]
    assert by(rows, "a", "b") == [(d, d) for d in days]


def test_half_open_backfill(spark, tmp_path):
    def answer(url, params, headers):
        if "q" in params:
            a = params["q"].split()
            return {"done": False, "nextRecordsUrl": f"/more/{a[0]}",
                    "records": [{"id": params["q"], "attributes": {}}]}
        return {"done": True, "records": [{"id": url}]}

    table = {
        "path": "q",
        "parse": {"json_record_path": "records", "json_drop_keys_any_depth": ["attributes"]},
        "pagination": {"mode": "salesforce"},
        "backfill": {"enabled": True, "strategy": "soql_window", "window_days": 2,
                     "date_format": "%Y-%m-%d", "date_field": "d",
                     "soql_template": "{start} <= {date_field} < {end}"},
    }
    rows, told = run(spark, tmp_path, table, answer, date(2024, 1, 1), date(2024, 1, 3))
    assert by(rows, "id") == [
        ("2024-01-01 <= d < 2024-01-03",), ("2024-01-03 <= d < 2024-01-04",),
        ("https://h/more/2024-01-01",), ("https://h/more/2024-01-03",),
    ]
    assert told["windows"] == 2


def test_cursor_backfill_with_links(spark, tmp_path):
    """Links are expanded page by page: a page without links keeps its rows."""

    def answer(url, params, headers):
        assert headers == {"Authorization": "k"}  # links are asked with the same headers
        if "/d/" in url:
            return {"v": int(url.rsplit("/", 1)[1])}
        n = int(params["cursor"])
        rows = [{"id": 10 * n, "u": f"https://h/d/{n}" if n != 2 else None}]
        return {"data": rows, "meta": {"next": n + 1 if n < 9 else None}}

    table = {
        "parse": PARSE,
        "pagination": {"mode": "cursor", "next_cursor_path": "meta.next"},
        "backfill": {"enabled": True, "strategy": "cursor",
                     "cursor": {"start_value": 1, "stop_at_item": {"field": "id", "value": 40}}},
        "link_expansion": {"enabled": True, "url_fields": ["u"]},
        "headers": {"Authorization": "k"},
    }
    rows, _ = run(spark, tmp_path, table, answer, date(2024, 1, 1), date(2024, 1, 1))
    assert by(rows, "v", "id") == [(1, None), (3, None), (None, 20)]


def test_flush_only(spark, tmp_path):
    def answer(url, params, headers):
        if "/s/" in url:
            return '{"k":1}\n{"k":2}'
        return {"data": [{"u": "https://h/s/one"}, {"u": "https://h/s/two"}]}

    table = {
        "parse": PARSE,
        "link_expansion": {
            "enabled": True, "url_fields": ["u"], "type": "jsonl",
            "session_id": {"regex": "/s/(.*)", "group": 1},
            "flush": {"mode": "per_session", "prefix": "f", "filename": "s_{session_id}",
                      "only": True},
        },
    }
    rows, told = run(spark, tmp_path, table, answer)
    assert (told["rows"], told["path"]) == (0, "")
    back = spark.read.json(str(tmp_path / "out" / "f" / "parts"))
    counts = {r["part"]: r["count"] for r in back.groupBy("part").count().collect()}
    assert counts == {"s_one": 2, "s_two": 2}


def test_session_id_names_the_final_path(spark, tmp_path):
    table = {
        "parse": PARSE,
        "output": {"filename": "{session_id}.jsonl"},
        "link_expansion": {"enabled": True, "url_fields": ["u"],
                           "session_id": {"regex": "s=(\\d+)", "group": 1, "policy": "all"}},
    }

    def answer(url, params, headers):
        return {"v": 1} if "?" in url else {"data": [{"u": f"https://h/?s={i}"} for i in (7, 5)]}

    _, told = run(spark, tmp_path, table, answer)
    assert told["path"].endswith("/5,7.jsonl") and told["rows"] == 2


def test_empty_result(spark, tmp_path):
    rows, told = run(spark, tmp_path, {"parse": PARSE}, lambda u, p, h: {"data": []})
    assert (rows, told["rows"]) == ([], 0)


def test_no_records_anywhere(spark, tmp_path):
    rows, told = run(spark, tmp_path, {"parse": PARSE}, lambda u, p, h: {"other": 1})
    assert (rows, told["rows"], told["bytes"]) == ([], 0, 0)


def test_batch_entry(spark, tmp_path, monkeypatch, capsys):
    from pageloom import job
    from pageloom.plans import run as runs

    body = json.dumps([{"day": "2024-01-01"}])
    fetch = lambda u, p, h: Response(body=body)
    monkeypatch.setattr(runs.Ingest, "_fetcher", lambda self, job: fetch)
    cfg = config(tmp_path / "out", {"backfill": {"enabled": True}})
    (tmp_path / "c.json").write_text(json.dumps(cfg))
    args = ["--config", str(tmp_path / "c.json"), "--table", "t", "--env", "dev"]
    job.main(args)
    job.main([*args, "--mode", "backfill", "--start", "2024-01-01", "--end", "2024-01-31"])
    told = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert [(t["rows"], t["windows"]) for t in told] == [(1, None), (5, 5)]
    for bad in ({"start": "2024-01-01"}, {"start": "01/02/2024", "end": "2024-01-03"}):
        with pytest.raises(ValueError):
            job.run(spark, cfg, "t", "dev", "backfill", **bad)


# ---- options ------------------------------------------------------------------


def test_backfill_guards(tmp_path):
    def strategy(table):
        return resolve(config(tmp_path, table), "t", "dev").strategy()

    with pytest.raises(ValueError, match="not enabled"):
        strategy({"path": "x"})
    with pytest.raises(ValueError, match="done-flag"):
        strategy({"backfill": {"enabled": True, "strategy": "soql_window"}})
    assert strategy({"backfill": {"enabled": True, "strategy": "unheard"}}) == "date"


def test_option_precedence(tmp_path, monkeypatch):
    monkeypatch.setenv("BUCKET", "real")
    table = {"output": {"s3": {"prefix": "p"}}, "pagination": {"page_param": "n"},
             "headers": {"A": "${NOPE}"}, "parse": {"json_record_path": "${BUCKET}"}}
    shared = {
        "path": "base",
        "pagination": {"mode": "page", "page_param": "p"},
        "output": {"format": "csv", "s3": {"bucket": "${BUCKET}"}},
        "request_defaults": {"headers": {"A": "a", "B": "${BUCKET}"}},
    }
    job = resolve(config(tmp_path, table, **shared), "t", "dev")
    assert job.url == "https://h/base"
    assert job.paging == {"mode": "page", "page_param": "n"}
    assert job.headers == {"A": "${NOPE}", "B": "real"}
    assert job.parse.record_path == "${BUCKET}"  # parse options are not expanded
    with pytest.raises(ValueError, match="bucket"):  # the table's s3 block stands alone
        job.sink()
    with pytest.raises(KeyError):
        resolve(config(tmp_path, table), "zz", "dev")
    with pytest.raises(ValueError, match="base_url"):
        resolve(config(tmp_path, table), "t", "prod")


def test_http_options(spark, tmp_path):
    table = {"path": "x", "timeout": 7, "backfill": {"per_request_delay": 2}}
    again = {"total": 4, "backoff_factor": 0.1, "status_forcelist": [500]}
    cfg = config(tmp_path, table, request_defaults={"timeout": 60}, retries=again)
    fetch = Ingest(spark, cfg)._fetcher(resolve(cfg, "t", "dev"))
    assert fetch == HttpFetch(timeout=7, retries=4, backoff=0.1, retry_on=(500,), delay=2)
    bare = config(tmp_path, {"path": "x"})
    assert Ingest(spark, bare)._fetcher(resolve(bare, "t", "dev")).retries == 0


def test_masking():
    assert masked({"Token": "x", "page": 1}, ["token"]) == {"Token": "***REDACTED***", "page": 1}


def test_source_prunes_partitions(spark, tmp_path):
    marks = str(tmp_path)

    def fetch(url, params, headers):
        open(f"{marks}/asked-{params['w']}", "w").close()
        return Response(body="[]")

    pulls = [Pull("p", "u", {"w": i}, window_seq=i) for i in range(4)]
    got = read_pulls(spark, pulls, fetch).where(F.col("window_seq").isin(1, 2)).collect()
    assert sorted(r["window_seq"] for r in got) == [1, 2]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["asked-1", "asked-2"]


def test_http_fetch(monkeypatch):
    import io
    from urllib.error import HTTPError

    from pageloom.sources import transports

    calls = []

    class Got(io.BytesIO):
        status, headers = 200, {"Link": "x"}

    def urlopen(request, timeout):
        calls.append((request.full_url, request.get_header("A")))
        if len(calls) == 1:
            raise HTTPError(request.full_url, 503, "busy", {}, io.BytesIO(b"wait"))
        return Got(b"ok\xff")

    monkeypatch.setattr(transports, "urlopen", urlopen)
    fetch = HttpFetch({"A": "1"}, backoff=0)
    got = fetch("https://h/x?a=1", {"b": "c d"}, {})
    assert (got.status, got.body, got.headers) == (200, "ok\ufffd", {"Link": "x"})
    assert calls == [("https://h/x?a=1&b=c+d", "1")] * 2


def test_errors_past_the_end_do_not_fail_striped_reading(spark, tmp_path):
    def answer(url, params, headers):
        n = int(params["page"])
        if n > 3:
            return Response(404, {}, "no such page")
        return {"data": [{"id": n}] if n < 3 else []}

    table = {"parse": PARSE, "pagination": {"mode": "page", "stripes": 4}}
    rows, told = run(spark, tmp_path, table, answer)
    assert by(rows, "id") == [(1,), (2,)] and told["truncated"] is False


def test_errors_before_the_end_do(spark, tmp_path):
    def answer(url, params, headers):
        return Response(404, {}, "") if int(params["page"]) == 2 else {"data": [{"id": 1}]}

    table = {"parse": PARSE, "pagination": {"mode": "page", "stripes": 2, "max_pages": 4}}
    with pytest.raises(RuntimeError, match="404"):
        run(spark, tmp_path, table, answer)


def test_a_reached_cap_is_told(spark, tmp_path):
    table = {"parse": PARSE, "pagination": {"mode": "page", "max_pages": 3}}
    rows, told = run(spark, tmp_path, table, lambda u, p, h: {"data": [{"id": p["page"]}]})
    assert len(rows) == 3 and told["truncated"] is True


def test_unreadable_bodies_fail_a_run_with_a_schema(spark, tmp_path):
    parse = {**PARSE, "schema": "struct<data:array<struct<id:bigint>>>"}
    with pytest.raises(Exception, match="not JSON"):
        run(spark, tmp_path, {"parse": parse}, lambda u, p, h: '{"data":[{"id":1}')
    lenient = {**parse, "strict": False}
    rows, _ = run(spark, tmp_path, {"parse": lenient}, lambda u, p, h: '{"data":[{"id":1}')
    assert rows == []
