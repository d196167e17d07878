"""Backfills committed in steps: what is committed is kept, and what is not is done anew."""

from __future__ import annotations

import json
from datetime import date
from pathlib import Path

import pytest

from pageloom import Ingest
from pageloom.sinks.snapshots import CommittedElsewhere, SnapshotLog
from pageloom.sources.transports import Response

START, END = date(2024, 1, 1), date(2024, 1, 10)


def days(notes, ends_at=None):
    """One record a day; notes the windows asked for, and can end at one."""
    notes = str(notes)

    def fetch(url, params, headers):
        begin, end = date.fromisoformat(params["start_date"]), date.fromisoformat(params["end_date"])
        if ends_at and str(begin) >= ends_at:
            raise ConnectionError("ended here")
        with open(notes, "a") as f:
            f.write(f"{begin}\n")
        found = [{"day": str(date.fromordinal(d))} for d in range(begin.toordinal(), end.toordinal() + 1)]
        return Response(body=json.dumps({"data": found}))

    return fetch


def chain(notes, pages=7, ends_at=None, field=False):
    """Pages of three ids, newest first; each names the token of the next."""
    notes = str(notes)

    def fetch(url, params, headers):
        token = params.get("cursor") or ""
        page = (int(token[1:]) + (1 if field else 0)) // (3 if field else 1) if token else 0
        if page == ends_at:
            raise ConnectionError("ended here")
        with open(notes, "a") as f:
            f.write(f"{page}\n")
        rows = [{"id": f"i{3 * page + i}", "at": f"2024-01-{28 - page:02d}T00:00:00Z"} for i in range(3)] if page < pages else []
        following = f"t{page + 1}" if page + 1 < pages else None
        return Response(body=json.dumps({"data": rows, "meta": {"next": following}}))

    return fetch


def config(tmp_path, backfill, **options):
    table = {"path": "v1", "parse": {"json_record_path": "data"}, "pagination": {"mode": "none"}, "backfill": {"enabled": True, "log": f"{tmp_path}/log", **backfill}, **options}
    return {"envs": {"qa": {"base_url": "https://h"}}, "apis": {"output": {"format": "parquet", "path": f"{tmp_path}/out"}, "t": table}}


def asked(notes):
    return Path(notes).read_text().split()


def test_windows_once_committed_are_not_asked_again(spark, tmp_path):
    notes = tmp_path / "notes"
    job = config(tmp_path, {"window_days": 2, "commit_every": 2})
    with pytest.raises(Exception, match="ended here"):
        Ingest(spark, job, days(notes, ends_at="2024-01-07")).run_backfill("t", "qa", START, END)
    log = SnapshotLog(spark, f"{tmp_path}/log")
    assert [e["version"] for e in log.entries()] == [0] and len(log.windows()) == 2
    assert sorted(r.day for r in log.read().collect()) == [f"2024-01-0{d}" for d in range(1, 5)]
    before = asked(notes)
    told = Ingest(spark, job, days(notes)).run_backfill("t", "qa", START, END)
    assert (told["rows"], told["windows"], told["path"]) == (10, 5, f"{tmp_path}/log")
    assert asked(notes)[len(before) :].count("2024-01-01") == 0 and "2024-01-09" in asked(notes)[len(before) :]
    assert sorted(r.day for r in log.read().collect()) == [f"2024-01-{d:02d}" for d in range(1, 11)]
    # a third run has nothing to do
    before = asked(notes)
    assert Ingest(spark, job, days(notes)).run_backfill("t", "qa", START, END)["rows"] == 10
    assert asked(notes) == before and len(log.entries()) == 3


def test_rows_that_no_commit_names_are_not_read(spark, tmp_path):
    log = SnapshotLog(spark, f"{tmp_path}/log")
    spark.range(3).write.parquet(f"{tmp_path}/out/rows-a")
    spark.range(5).write.parquet(f"{tmp_path}/out/rows-b")  # its run died before the commit
    log.commit("now", [(START, END)], path=f"{tmp_path}/out/rows-a", rows=3, bytes=1, truncated=False)
    assert log.read().count() == 3


def test_of_two_writers_one_wins(spark, tmp_path):
    a, b = SnapshotLog(spark, f"{tmp_path}/log"), SnapshotLog(spark, f"{tmp_path}/log")
    real, late = b.entries, []

    def overtaken():  # b has read the log when a commits
        found = real()
        if not late:
            late.append(1)
            a.commit("now", [(START, START)], path="x", rows=1)
        return found

    b.entries = overtaken
    assert b.commit("now", [(END, END)], path="y", rows=1) == 1
    assert [e["path"] for e in a.entries()] == ["x", "y"]
    late.clear()
    b.entries = lambda: real() if late else (late.append(1), real(), a.commit("now", [(date(2025, 1, 1), END)], path="z", rows=1))[1]
    with pytest.raises(CommittedElsewhere):
        b.commit("now", [(date(2025, 1, 1), END)], path="w", rows=1)
    assert [e["version"] for e in a.entries()] == [0, 1, 2]
    assert not a._put("commit-000000000002.json", "{}") and not list(Path(f"{tmp_path}/log").glob("_draft*"))


@pytest.mark.parametrize("field", [False, True])
def test_a_chain_goes_on_behind_its_last_committed_page(spark, tmp_path, field):
    notes = tmp_path / "notes"
    how = {"chain_field": "id"} if field else {"next_cursor_path": "meta.next"}
    job = config(tmp_path, {"strategy": "cursor", "commit_every": 2}, pagination={"mode": "cursor", **how})
    with pytest.raises(Exception, match="ended here"):
        Ingest(spark, job, chain(notes, ends_at=5, field=field)).run_backfill("t", "qa", START, END)
    log = SnapshotLog(spark, f"{tmp_path}/log")
    assert [e["pages"] for e in log.entries()] == [2, 2] and not log.entries()[-1]["ended"]
    before = len(asked(notes))
    assert Ingest(spark, job, chain(notes, field=field)).run_backfill("t", "qa", START, END)["rows"] == 21
    assert min(map(int, asked(notes)[before:])) == 4
    assert sorted(int(r.id[1:]) for r in log.read().collect()) == list(range(21))
    assert log.entries()[-1]["ended"]


@pytest.mark.parametrize(("stop", "rows"), [({"stop_at_item": {"field": "id", "value": "i5", "inclusive": True}}, 6), ({"stop_when_older_than": {"field": "at", "value": "2024-01-26T00:00:00Z"}}, 9)])
def test_a_stop_rule_ends_a_chain_for_good(spark, tmp_path, stop, rows):
    notes = tmp_path / "notes"
    job = config(tmp_path, {"strategy": "cursor", "commit_every": 2, "cursor": stop}, pagination={"mode": "cursor", "next_cursor_path": "meta.next"})
    for _ in range(2):
        assert Ingest(spark, job, chain(notes)).run_backfill("t", "qa", START, END)["rows"] == rows
    assert max(map(int, asked(notes))) <= 3


def test_a_cap_holds_over_all_steps(spark, tmp_path):
    notes = tmp_path / "notes"
    job = config(tmp_path, {"strategy": "cursor", "commit_every": 2}, pagination={"mode": "cursor", "next_cursor_path": "meta.next", "max_pages": 3})
    told = Ingest(spark, job, chain(notes)).run_backfill("t", "qa", START, END)
    assert told["rows"] == 9 and told["truncated"] and sorted(set(asked(notes))) == ["0", "1", "2"]
