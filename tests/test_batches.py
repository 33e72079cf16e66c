"""The clustered, compacted stream sink: one parse, one commit a micro-batch, totals over restarts, crashes."""

import datetime as dt
import json
from collections import Counter
from pathlib import Path

import pytest

from headway.__main__ import main
from headway.operators.ingest import arrivals_from_schedules, as_rejects, outcomes, rejected_documents
from headway.sources import batches
from headway.sources.schedules import read_schedule_batch, read_schedule_stream
from headway.streaming import ingest as streaming
from tests.conftest import plan_of
from tests.test_streaming import PAIRS, land, rows


@pytest.fixture
def places(tmp_path):
    return tmp_path / "landing", str(tmp_path / "raw"), str(tmp_path / "offsets")


def drain(spark, landing, raw, offsets, files=1, **how):
    stream = read_schedule_stream(spark, str(landing), files)
    query = streaming.start_outcomes(stream, raw, offsets, "once", **how)
    return streaming.follow_outcomes(spark, query, raw)


def expected(spark, landing):
    docs = read_schedule_batch(spark, str(landing))
    return rows(arrivals_from_schedules(docs)), as_text(rejected_documents(docs))


def as_text(df):
    return sorted(map(str, map(tuple, df.collect())))


def check(spark, landing, raw):
    accepted, rejects = expected(spark, landing)
    assert rows(batches.read_accepted(spark, raw)) == accepted
    assert as_text(batches.read_rejects(spark, raw)) == rejects
    assert batches.totals(spark, raw) == {"inserted": len(accepted), "rejected": len(rejects)}


def files(raw, manifest):
    """Files of each day that counts."""
    found = Counter()
    for day in manifest.days:
        folder = Path(raw, "days", f"version={day.version}", f"outcome={day.outcome}", f"ingestion_date={day.day}")
        found[day.outcome, day.day] += len(list(folder.glob("*.parquet")))
    return found


def damaged(landing):
    (landing / "bad.json").write_text('not json\n{"line_code": "TCL", "station_code": "HOK", "payload": "<html>"}\n')


def test_outcomes_are_the_accepted_and_the_rejected_from_one_parse(spark, places):
    landing, *_ = places
    land(landing, "a.json", PAIRS)
    damaged(landing)
    docs = read_schedule_batch(spark, str(landing))
    both = outcomes(docs)
    accepted, rejects = expected(spark, landing)
    assert rows(both.filter("reason is null").drop("reason", "payload")) == accepted
    assert as_text(as_rejects(both.filter("reason is not null"))) == rejects
    assert both.filter("reason is null and payload is not null").count() == 0
    plan = plan_of(both)
    assert plan.count("FileScan json") == 1 and plan.count("Generate") == 1
    chosen = outcomes(docs, lines=["TCL"])
    assert rows(chosen.filter("reason is null").drop("reason", "payload")) == rows(arrivals_from_schedules(docs, lines=["TCL"]))
    assert as_text(as_rejects(chosen.filter("reason is not null"))) == as_text(rejected_documents(docs, lines=["TCL"]))
    pairs = spark.createDataFrame([("TCL", "HOK"), ("TCL", "HOK")], "line_code string, station_code string")
    assert outcomes(docs, pairs).filter("reason is null").count() == arrivals_from_schedules(docs, pairs).count() == 1


def test_many_batches_and_restarts(spark, places):
    landing, raw, offsets = places
    for k in range(4):
        land(landing, f"{k}.json", PAIRS, 1 + k % 2)
    damaged(landing)
    first = drain(spark, landing, raw, offsets)
    assert first["status"] == "success" and len(batches.ledger(spark, raw)) == 5
    check(spark, landing, raw)
    again = drain(spark, landing, raw, offsets)
    assert again == {**first, "inserted": 0, "rejected": 0}
    land(landing, "new.json", PAIRS[:2], 3)
    more = drain(spark, landing, raw, offsets)
    assert (more["inserted"], more["total_inserted"]) == (3, first["inserted"] + 3)
    assert more["total_inserted"] == batches.read_accepted(spark, raw).count()
    check(spark, landing, raw)


def test_compaction_keeps_rows_and_bounds_files(spark, places):
    landing, raw, offsets = places
    for k in range(6):
        land(landing, f"{k}.json", PAIRS, 1 + k // 2)
    drain(spark, landing, raw, offsets)
    assert batches.compact(spark, raw, dt.date(2024, 3, 1))["batches"] == 0  # no day is closed
    done = batches.compact(spark, raw, dt.date(2024, 3, 3))
    assert done["version"] == 1 and done["batches"] == 4 and done["days"] == 4
    check(spark, landing, raw)
    manifest = batches.newest_manifest(spark, raw)
    assert set(files(raw, manifest).values()) == {1}
    # A late batch: its day is written anew, the others stay.
    land(landing, "late.json", PAIRS[:3], 1)
    drain(spark, landing, raw, offsets)
    check(spark, landing, raw)
    assert batches.compact(spark, raw)["batches"] == 3
    check(spark, landing, raw)
    manifest = batches.newest_manifest(spark, raw)
    assert {(d.outcome, d.day): d.version for d in manifest.days}["accepted", "2024-03-02"] == 1
    assert set(files(raw, manifest).values()) == {1}
    assert (manifest.inserted, manifest.rejected) == tuple(batches.totals(spark, raw).values())
    assert batches.compact(spark, raw) == {"version": 2, "batches": 0, "days": 0, "rows": 0}


def test_rows_of_a_file_are_bounded(spark, places):
    landing, raw, offsets = places
    land(landing, "a.json", PAIRS)
    drain(spark, landing, raw, offsets)
    batches.compact(spark, raw, file_rows=3)
    assert files(raw, batches.newest_manifest(spark, raw))["accepted", "2024-03-01"] == 3  # seven rows
    check(spark, landing, raw)


class Crash(Exception):
    pass


def crash(*_):
    raise Crash("the power went")


@pytest.mark.parametrize("step", ["write_clustered", "_one_row"])
def test_crash_between_write_and_commit(spark, places, monkeypatch, step):
    """Before the files, or with the files there and no entry: nothing counts, and the next run adds it once."""
    landing, raw, offsets = places
    land(landing, "a.json", PAIRS, 1)
    drain(spark, landing, raw, offsets)
    land(landing, "b.json", PAIRS, 2)
    with monkeypatch.context() as patch:
        patch.setattr(batches, step, crash)
        failed = drain(spark, landing, raw, offsets)
    assert failed["status"] == "failed" and "the power went" in failed["error"]
    assert failed["total_inserted"] == batches.read_accepted(spark, raw).count() == 7
    assert drain(spark, landing, raw, offsets)["inserted"] == 7
    check(spark, landing, raw)


def test_crash_after_the_entry(spark, places, monkeypatch):
    """The entry is there, but Spark does not know: the batch is offered again and left alone."""
    landing, raw, offsets = places
    land(landing, "a.json", PAIRS, 1)
    commit = batches.commit_batch

    def late(*args):
        commit(*args)
        crash()

    with monkeypatch.context() as patch:
        patch.setattr(streaming, "commit_batch", late)
        assert drain(spark, landing, raw, offsets)["status"] == "failed"
    check(spark, landing, raw)
    written = sorted(Path(raw).rglob("*.parquet"))
    assert drain(spark, landing, raw, offsets)["inserted"] == 0
    assert sorted(Path(raw).rglob("*.parquet")) == written
    check(spark, landing, raw)


@pytest.mark.parametrize("step", ["write_clustered", "_one_row"])
def test_crash_in_compaction(spark, places, monkeypatch, step):
    landing, raw, offsets = places
    land(landing, "a.json", PAIRS, 1)
    drain(spark, landing, raw, offsets)
    with monkeypatch.context() as patch:
        patch.setattr(batches, step, crash)
        with pytest.raises(Crash):
            batches.compact(spark, raw)
    check(spark, landing, raw)
    assert batches.compact(spark, raw)["version"] == 1
    check(spark, landing, raw)


def test_two_streams_into_one_table(spark, places, tmp_path):
    landing, raw, offsets = places
    land(landing, "a.json", PAIRS, 1)
    drain(spark, landing, raw, offsets, lines=["TCL"])
    drain(spark, landing, raw, offsets + "-2", lines=["ISL", "DRL"])
    assert len({e.stream for e in batches.ledger(spark, raw)}) == 2
    accepted = expected(spark, landing)[0]
    assert rows(batches.read_accepted(spark, raw)) == accepted
    batches.compact(spark, raw)
    assert rows(batches.read_accepted(spark, raw)) == accepted


def test_a_day_reads_its_folders_only(spark, places):
    landing, raw, offsets = places
    land(landing, "a.json", PAIRS, 1)
    land(landing, "b.json", PAIRS, 2)
    drain(spark, landing, raw, offsets)
    batches.compact(spark, raw)
    plan = plan_of(batches.read_accepted(spark, raw).filter("ingestion_date = '2024-03-02'"))
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan


def test_archived_documents_leave_and_are_read_once(spark, places, tmp_path):
    landing, raw, offsets = places
    archive = tmp_path / "archive"
    how = ["--landing", str(landing), "--raw", raw, "--checkpoint", offsets, "--archive", str(archive), "--max-bytes", "1000"]
    for k in range(4):
        land(landing, f"{k}.json", PAIRS, 1 + k)
        assert main(["ingest", *how]) == 0
    left = {f.name for f in landing.glob("*.json")}
    gone = {f.name for f in archive.rglob("*.json")}
    assert left | gone == {f"{k}.json" for k in range(4)} and not left & gone and len(gone) >= 2
    assert batches.read_accepted(spark, raw).count() == 28


def test_commands(spark, places, capsys):
    landing, raw, offsets = places
    land(landing, "a.json", PAIRS, 1)
    assert main(["ingest", "--landing", str(landing), "--raw", raw, "--checkpoint", offsets]) == 0
    assert json.loads(capsys.readouterr().out) == {
        "status": "success", "inserted": 7, "rejected": 2, "total_inserted": 7, "total_rejected": 2,
    }
    assert main(["compact", "--raw", raw, "--before", "2024-03-02"]) == 0
    assert json.loads(capsys.readouterr().out)["days"] == 2
    check(spark, landing, raw)


def test_a_failed_command_says_why(spark, places, capsys, monkeypatch):
    landing, raw, offsets = places
    land(landing, "a.json", PAIRS, 1)
    monkeypatch.setattr(batches, "write_clustered", crash)
    assert main(["ingest", "--landing", str(landing), "--raw", raw, "--checkpoint", offsets]) == 1
    assert "the power went" in json.loads(capsys.readouterr().out)["error"]


def test_nothing_yet(spark, tmp_path):
    path = str(tmp_path / "none")
    assert not batches.is_batch_table(spark, path)
    assert batches.read_accepted(spark, path).count() == batches.read_rejects(spark, path).count() == 0
    assert batches.totals(spark, path) == {"inserted": 0, "rejected": 0} and batches.compact(spark, path)["rows"] == 0
