"""Models, extracts, anomalies, checks, tiles and published marts on literal rows."""

import datetime as dt

import pytest

from headway.operators import anomaly, quality, tiles
from headway.operators.frames import newest
from headway.operators.waits import wait_metrics, with_bands, with_wait_category
from headway.plans import extracts, marts, models
from headway.schemas import EXTENDED_RAW, RAW

T0 = dt.datetime(2024, 1, 1, 8, tzinfo=dt.timezone.utc)


def raw(spark, rows, schema=RAW):
    """Rows as dicts of what differs from a sound arrival."""
    base = {
        "arrival_id": "a", "line_code": "TCL", "line_name": "Tung Chung Line", "station_code": "HOK",
        "dest_station": "TUC", "platform": "1", "sequence": 1, "arrival_time": T0, "time_remaining": 60,
        "direction": "UP", "ingestion_timestamp": T0, "ingestion_date": dt.date(2024, 1, 1),
        "station_name": "s", "is_delayed": False, "delay_seconds": 0,
    }
    return spark.createDataFrame(
        [tuple({**base, **r}[f] for f in schema.fieldNames()) for r in rows], schema
    )


def later(**delta):
    return T0 + dt.timedelta(**delta)


def test_staging_keeps_the_latest(spark):
    stg = models.stg_arrivals(
        raw(spark, [
            {"time_remaining": 1}, {"time_remaining": 2, "ingestion_timestamp": later(seconds=1)},
            {"arrival_id": None}, {"arrival_id": "b", "time_remaining": 3},
        ])
    )
    assert {(r.arrival_id, r.time_remaining_seconds, r.row_num) for r in stg.collect()} == {("a", 2, 1), ("b", 3, 1)}
    assert stg.columns == [*models.STAGING_COLUMNS, "row_num"]


def test_staging_ties_keep_one(spark):
    df = raw(spark, [{"time_remaining": i} for i in range(10)])
    assert models.stg_arrivals(df).count() == 1
    assert models.stg_arrivals(df, tie_break=["time_remaining_seconds"]).first().time_remaining_seconds == 9


def test_fact(spark):
    rows = [{"arrival_id": str(i), "time_remaining": w} for i, w in enumerate([60, 120, 180])]
    rows += [{"arrival_id": "n", "station_code": None, "time_remaining": None}]
    rows += [{"arrival_id": "late", "ingestion_timestamp": later(hours=15, minutes=58), "arrival_time": later(hours=16, minutes=2)}]
    fact = {(r.station_code, r.hour): r for r in models.fact_delays(models.stg_arrivals(raw(spark, rows))).collect()}
    r = fact[("HOK", 8)]
    assert (r.sample_count, r.avg_wait_seconds, r.std_wait_seconds, r.min_wait_seconds, r.max_wait_seconds) == (3, 120, 60, 60, 180)
    assert (r.upper_bound_seconds, r.lower_bound_seconds, r.wait_category) == (240, 0, "normal")
    empty = fact[(None, 8)]
    assert (empty.sample_count, empty.avg_wait_seconds, empty.upper_bound_seconds, empty.lower_bound_seconds) == (1, None, None, None)
    assert empty.wait_category == "normal"
    midnight = fact[("HOK", 0)]
    assert midnight.ingestion_date == dt.date(2024, 1, 1)
    assert midnight.std_wait_seconds is None and midnight.upper_bound_seconds == midnight.lower_bound_seconds == 60


def hours(spark, waits):
    """Hourly statistics over one group of waits."""
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 8, "L", "Line", "S", w) for w in waits],
                               "ingestion_date date, hour bigint, line_code string, line_name string, station_code string, time_remaining_seconds bigint")
    return with_bands(wait_metrics(df))


@pytest.mark.parametrize(
    "waits, category, kind",
    [
        ([60, 120], "normal", "Normal"),
        ([-60, -120], "unusually_short", "Unusually Short"),
        ([-60], "normal", "Unusually Short"),  # one row: no deviation, so only the report flags it
        ([-60, -60], "normal", "Unusually Short"),
        ([None], "normal", "Normal"),
        ([0], "normal", "Normal"),
    ],
)
def test_the_two_classifiers(spark, waits, category, kind):
    row = anomaly.flag_anomalies(with_wait_category(hours(spark, waits))).first()
    assert (row.wait_category, row.anomaly_type, row.is_anomaly) == (category, kind, kind != "Normal")


def test_long_label(spark):
    """No mean lies above its own band, so the long branch needs bounds from elsewhere."""
    df = spark.createDataFrame([(100.0, 10.0, 50.0, 0.0)], "avg_wait_seconds double, std_wait_seconds double, upper_bound_seconds double, lower_bound_seconds double")
    row = anomaly.flag_anomalies(with_wait_category(df)).first()
    assert (row.wait_category, row.anomaly_type) == ("unusually_long", "Unusually Long")
    assert tuple(anomaly.anomaly_summary(df).first()) == (1, 1, 0)


def test_dimensions_from_staging_or_fact(spark):
    rows = [
        {"arrival_id": "1"}, {"arrival_id": "2", "line_code": "ISL", "line_name": "Island Line"},
        {"arrival_id": "3", "line_code": "ISL", "line_name": "Other", "station_code": "CEN"},
        {"arrival_id": "4", "line_code": None, "line_name": None, "station_code": "CEN"},
        {"arrival_id": "5", "station_code": None},
    ]
    stg = models.stg_arrivals(raw(spark, rows))
    fact = models.fact_delays(stg)
    lines = {tuple(r) for r in models.dim_lines(stg).collect()}
    assert lines == {tuple(r) for r in models.dim_lines(fact).collect()} == {
        ("TCL", "Tung Chung Line", "#F7943D", False), ("ISL", "Island Line", "#0075C2", True),
        ("ISL", "Other", "#0075C2", True), (None, None, "#808080", False),
    }
    stations = {tuple(r) for r in models.dim_stations(stg).collect()}
    assert stations == {tuple(r) for r in models.dim_stations(fact).collect()} == {
        ("HOK", "TCL", True), ("HOK", "ISL", True), ("CEN", "ISL", False), ("CEN", None, False), (None, "TCL", False),
    }


def test_two_names_for_a_line_fail_uniqueness(spark):
    rows = [{"arrival_id": "1"}, {"arrival_id": "2", "line_name": "Other"}]
    lines = models.dim_lines(models.stg_arrivals(raw(spark, rows)))
    assert [tuple(r) for r in quality.check_unique(lines, "line_code").collect()] == [("TCL", 2)]


def test_extracts(spark):
    rows = [{"arrival_id": str(h), "ingestion_timestamp": later(hours=-h), "ingestion_date": later(hours=-h).date(), "time_remaining": 90} for h in range(0, 60, 10)]
    df = raw(spark, rows)

    def ids(**how):
        return [r.arrival_id for r in extracts.recent_arrivals(df, as_of="2024-01-01 08:00:00", **how).collect()]

    assert ids() == ["0", "10", "20"]
    assert ids(hours_back=20) == ["0", "10", "20"]  # the bound itself is in
    assert ids(hours_back=0) == ["0", "10", "20", "30", "40", "50"]
    assert ids(hours_back=0, limit=2) == ["0", "10"]
    assert sorted(ids(hours_back=-1, limit=None)) == ["0", "10", "20", "30", "40", "50"]
    assert extracts.recent_arrivals(df, limit=5).isEmpty()  # as of now
    row = extracts.recent_arrivals(df, 0).first()
    assert (row.time_remaining_minutes, row.hour, row.date) == (1.5, 8, dt.date(2024, 1, 1))
    assert extracts.hourly_stats(df, 1, as_of="2024-01-01").count() == 2
    assert extracts.hourly_stats(df, 9999).count() == 3
    assert extracts.hourly_stats(df).isEmpty()
    keys = [(r.ingestion_date, r.hour, r.line_code) for r in extracts.hourly_stats(df, 9999).collect()]
    assert keys == sorted(keys)


def test_extract_reads_copies_and_the_fact_does_not(spark):
    df = raw(spark, [{}, {}, {"arrival_id": "b"}])
    assert extracts.hourly_stats(df, 9999).first().sample_count == 3
    assert models.fact_delays(models.stg_arrivals(df)).first().sample_count == 2


@pytest.mark.parametrize("n", [1, 3, 4, 10, 100])
def test_newest_with_ties(spark, n):
    stamps = [later(seconds=-(i // 4), microseconds=(i % 2) * 5) for i in range(40)]
    df = raw(spark, [{"arrival_id": str(i), "ingestion_timestamp": t} for i, t in enumerate(stamps)])
    got = [r.ingestion_timestamp for r in newest(df, n, "ingestion_timestamp", "ingestion_date").collect()]
    want = [r.ingestion_timestamp for r in df.orderBy(df.ingestion_timestamp.desc()).limit(n).collect()]
    assert got == want


def test_newest_of_nothing(spark):
    assert newest(raw(spark, []), 5, "ingestion_timestamp", "ingestion_date").isEmpty()


def test_bad_rows_are_counted(spark):
    df = raw(spark, [{"arrival_id": "1", "line_code": None}, {"arrival_id": "2", "line_code": "XXX", "station_code": None}, {"arrival_id": "3"}])
    stg = models.stg_arrivals(df)
    rows = quality.run_checks({"stg_arrivals": stg}).collect()
    assert len(rows) == len(quality.DECLARED)
    assert {r.failures for r in rows if r.model != "stg_arrivals"} == {None}  # not run, and visible
    report = {(r["column"], r.test): r.failures for r in rows if r.model == "stg_arrivals"}
    assert len(report) == 11
    assert report.pop(("is_delayed", "not_null")) is None  # the column is not there, so not checked
    failing = {k: v for k, v in report.items() if v}
    assert failing == {("line_code", "not_null"): 1, ("line_code", "accepted_values"): 1, ("station_code", "not_null"): 1}


def test_declared_checks():
    kinds = [c.test for c in quality.DECLARED]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values")) == (20, 2, 1)


def test_all_checks_on_built_marts(spark, tmp_path):
    rows = [{"arrival_id": str(i), "station_code": f"S{i % 5}", "ingestion_date": dt.date(2024, 1, 1 + i % 3)} for i in range(30)]
    df = raw(spark, rows, EXTENDED_RAW)
    built = marts.build_marts(spark, df, str(tmp_path))
    stg = models.stg_arrivals(df, extra=["is_delayed"])
    report = quality.run_checks({"stg_arrivals": stg, **built}).collect()
    assert len(report) == 23
    assert {r.failures for r in report} == {0}
    assert built["fact_delays"].columns == models.FACT_COLUMNS
    direct = {tuple(r) for r in models.fact_delays(stg).collect()}
    assert {tuple(r) for r in built["fact_delays"].collect()} == direct
    again = marts.build_marts(spark, df.limit(0), str(tmp_path))
    assert again["fact_delays"].isEmpty()
    assert marts.read_marts(spark, str(tmp_path))["fact_delays"].columns == models.FACT_COLUMNS  # without a file to ask


def test_marts_as_catalog_tables(spark, tmp_path):
    df = raw(spark, [{}])
    spark.sql(f"create database if not exists headway_test location '{tmp_path}'")
    spark.sql("use headway_test")
    try:
        marts.build_marts(spark, df)
        assert spark.table("fact_delays").count() == spark.table("dim_lines").count() == 1
    finally:
        spark.sql("use default")
        spark.sql("drop database headway_test cascade")


def test_views(spark):
    df = raw(spark, [{}, {}])
    marts.register_views(df, {"dim_lines": models.dim_lines(models.stg_arrivals(df))})
    assert spark.sql("select count(*) from raw_arrivals").first()[0] == 2
    assert spark.sql("select count(*) from stg_arrivals join dim_lines using (line_code)").first()[0] == 1


def test_tiles(spark):
    ext = raw(spark, [
        {"arrival_id": "1", "is_delayed": True, "delay_seconds": 400}, {"arrival_id": "2", "time_remaining": 180},
        {"arrival_id": "3", "line_code": "ISL", "is_delayed": None}, {"arrival_id": "4", "line_code": "ISL", "ingestion_date": dt.date(2023, 1, 1)},
    ], EXTENDED_RAW)
    fact = models.fact_delays(models.stg_arrivals(ext))
    assert [tuple(r) for r in tiles.tile_wait_by_line(fact).collect()] == [("TCL", 120.0), ("ISL", 60.0)]
    assert {r.line_code: (r.delayed_count, r.share) for r in tiles.tile_delay_share(ext).collect()} == {"TCL": (1, 1.0), "ISL": (0, 0.0)}
    assert sum(r.delayed_count for r in tiles.tile_delay_trend(ext).collect()) == 1
    assert [tuple(r) for r in tiles.tile_peak_activity(fact).collect()] == [(8, "HOK", 4)]
    assert tiles.tile_filter(ext, as_of="2024-01-05").count() == 3
    assert tiles.tile_filter(ext, days=None, lines=["ISL"], stations=["HOK"]).count() == 2
    assert tiles.tile_filter(ext, days=None, stations=["CEN"]).isEmpty()
    assert tiles.with_delay_flag(ext, 300).filter("is_delayed").count() == 1
    none = tiles.tile_delay_share(ext.filter("not is_delayed")).collect()
    assert {r.share for r in none} == {None}


class Killed(Exception):
    pass


@pytest.mark.parametrize("name", ["dim_lines", "dim_stations"])
def test_marts_change_together_or_not_at_all(spark, tmp_path, monkeypatch, name):
    """A job that dies between two marts leaves the old three; frames that were read stay as they were."""
    out = str(tmp_path / "marts")

    def content(built):
        return {key: sorted(map(str, map(tuple, df.collect()))) for key, df in built.items()}

    def arrivals(line):
        return raw(spark, [{"arrival_id": line, "line_code": line, "line_name": line}])

    with pytest.raises(FileNotFoundError):
        marts.read_marts(spark, out)
    old = content(marts.build_marts(spark, arrivals("TCL"), out))
    before = marts.read_marts(spark, out)
    assert content(before) == old

    def die(*_):
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(marts, name, die)
        with pytest.raises(Killed):
            marts.build_marts(spark, arrivals("ISL"), out)
    assert content(marts.read_marts(spark, out)) == old
    new = content(marts.build_marts(spark, arrivals("ISL"), out))
    assert content(marts.read_marts(spark, out)) == new != old
    assert content(before) == old
