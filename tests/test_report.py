"""The report page and the command line, end to end on landed documents."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import cases
from headway.__main__ import main
from headway.plans.report import build_report
from tests.test_streaming import PAIRS, land

AS_OF = dt.datetime(2024, 1, 30, 12)


@pytest.mark.parametrize("limit", [100_000, None])
def test_report_page(spark, sf_dir, limit):
    rows = cases.raw(spark, sf_dir)
    page = build_report(rows, as_of=AS_OF, limit=limit)
    got = {name: df.toPandas() for name, df in page.frames.items()}
    page.close()
    day = rows.filter("ingestion_date = '2024-01-30'")
    assert got["overview"].total_arrivals[0] == day.count() == got["cdf_steps"].n.sum() == got["histogram"].n.sum()
    assert got["line_ranking"].wait_count.sum() == got["line_boxes"].n.sum() == day.count()
    assert got["anomaly_summary"].total_anomalies[0] == len(got["anomaly_details"]) == len(got["anomaly_points"])
    first = got["station_list"].station_code.min()
    assert len(got["station_hourly"]) == day.filter(day.station_code == first).selectExpr("hour(arrival_time) h").distinct().count()


def test_report_choices(spark, sf_dir):
    rows = cases.raw(spark, sf_dir)
    page = build_report(rows, date="2024-01-28", lines=["Island Line"], hours=(0, 12), as_of=AS_OF)
    summary = page.frames["line_ranking"].collect()
    page.close()
    assert [r.line_name for r in summary] == ["Island Line"]
    want = rows.filter("ingestion_date = '2024-01-28' and line_name = 'Island Line' and hour(arrival_time) <= 12")
    assert summary[0].wait_count == want.count()


@pytest.mark.parametrize(
    "how, note",
    [({}, "no arrivals in the period"), ({"as_of": AS_OF, "lines": ["No Line"]}, "no arrivals match the filters")],
)
def test_nothing_to_report(spark, sf_dir, how, note):
    page = build_report(cases.raw(spark, sf_dir), **how)
    page.close()
    assert (page.note, page.frames) == (note, {})


def test_command_line(spark, tmp_path, capsys):
    land(tmp_path / "landing", "a.json", PAIRS, 1)
    raw, out = str(tmp_path / "raw"), str(tmp_path / "marts")
    ingest = ["ingest", "--landing", str(tmp_path / "landing"), "--raw", raw, "--checkpoint", str(tmp_path / "c")]
    assert main(ingest) == 0
    assert '"inserted": 7' in capsys.readouterr().out
    assert main(["marts", "--raw", raw, "--out", out]) == 0
    assert "dim_stations 4" in capsys.readouterr().out
    assert main(["check", "--raw", raw, "--marts", out]) == 2  # nothing fails, but a column is missing
    printed = capsys.readouterr().out
    assert "stg_arrivals.is_delayed not_null: not run" in printed
    assert printed.count(": 0") == 22
    assert main(["report", "--raw", raw]) == 0
    assert "no arrivals in the period" in capsys.readouterr().out


def test_command_line_with_a_catalog(spark, sf_dir, tmp_path, capsys):
    spark.sql("CREATE DATABASE IF NOT EXISTS transit")
    rows = cases.zoned(cases.raw(spark, sf_dir, extended=True))
    rows.write.mode("overwrite").saveAsTable("transit.raw_arrivals")
    source = ["--table", "transit.raw_arrivals"]
    assert main(["marts", *source, "--database", "transit"]) == 0
    capsys.readouterr()
    assert main(["check", *source, "--database", "transit"]) == 1  # the events have a line that is not listed
    assert "dim_lines.line_code unique: 0" in capsys.readouterr().out
    out = str(tmp_path / "page")
    how = ["--hours-back", "0", "--days-back", "9999", "--delays", "--out", out]
    assert main(["report", *source, "--database", "transit", *how]) == 0
    read = spark.read.parquet
    facts = spark.table("transit.fact_delays")
    assert read(f"{out}/tile_peak_activity").agg(F.sum("total_arrivals")).first() == facts.agg(F.sum("sample_count")).first()
    assert read(f"{out}/tile_wait_by_line").count() == facts.select("line_code").distinct().count()
    delayed = rows.filter("is_delayed").count()
    for tile in ("tile_delay_trend", "tile_delay_share"):
        assert read(f"{out}/{tile}").agg(F.sum("delayed_count")).first()[0] == delayed > 0
