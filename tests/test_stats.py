"""Frame statistics at the edges: empty, one row, nulls, ties, rounding."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from headway.functions import columns as C
from headway.operators import distribution, frames, stats
from headway.operators.distribution import WAIT
from tests.frames_util import frame, waits

MIXED = [
    ("B", "S2", "UP", 9, 4.0),
    ("B", "S2", "DOWN", 9, None),
    ("A", "S1", "UP", 8, 1.0),
    ("A", "S1", "DOWN", 8, 3.0),
    ("A", "S3", "UP", None, 5.0),
    (None, "S3", "UP", 7, 6.0),
    ("C", None, None, 7, None),
]


def as_dict(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_overview(spark):
    row = stats.overview(frame(spark, MIXED)).first()
    values = pd.Series([4.0, 1, 3, 5, 6])
    assert row.total_arrivals == 7
    assert row.active_lines == 3
    assert row.avg_wait == pytest.approx(values.mean())
    assert row.std_wait == pytest.approx(values.std())
    assert row.var_wait == pytest.approx(values.var())


@pytest.mark.parametrize("values", [[], [None], [None, None]])
def test_overview_without_values(spark, values):
    row = stats.overview_text(stats.overview(waits(spark, values))).first()
    assert (row.total_arrivals, row.avg_wait, row.std_wait) == (str(len(values)), "N/A", "N/A")


def test_overview_text(spark):
    row = stats.overview_text(stats.overview(waits(spark, [2.25] * 1200))).first()
    assert (row.total_arrivals, row.avg_wait, row.std_wait) == ("1,200", "2.2 min", "0.0 min")


@pytest.mark.parametrize(
    "values, outliers",
    [([], 0), ([5.0], 0), ([None], 0), ([1.0] * 20 + [50.0], 1), ([0.0] * 20 + [-9.0, None], 1), ([2.0, 2.0], 0), ([0.1] * 3, 0)],
)
def test_outlier_count(spark, values, outliers):
    assert stats.outlier_count(waits(spark, values)).first().outlier_count == outliers


def test_null_keys_are_left_out(spark):
    df = frame(spark, MIXED)
    assert {(r.hour, r.line_name): r.avg_wait for r in stats.hourly_line_avg(df).collect()} == {
        (9, "B"): 4.0, (8, "A"): 2.0, (7, "C"): None,
    }
    assert set(as_dict(stats.station_line_avg(df), "station_code", "line_name")) == {
        ("S1", "A"), ("S2", "B"), ("S3", "A"),
    }


def test_heatmap(spark):
    cells = as_dict(stats.wait_heatmap(frame(spark, MIXED)), "line_name")
    assert set(cells) == {("A",), ("B",), ("C",)}
    assert cells[("A",)]["8"] == 2.0
    assert cells[("A",)]["9"] is None
    assert stats.wait_heatmap(frame(spark, MIXED)).columns == ["line_name", *map(str, range(24))]


def test_line_summary_matches_pandas(spark):
    rows = [(line, "S", "UP", 1, v) for line, vs in {
        "A": [1.0] * 30 + [60.0, -40.0], "B": [0.125, 0.125], "C": [7.0], "D": [None, None], "E": [1.005, None, 3.115], "F": [0.1] * 3,
    }.items() for v in vs]
    found = as_dict(stats.line_summary(frame(spark, rows)), "line_name")
    pdf = pd.DataFrame([(r[0], r[4]) for r in rows], columns=["line", "v"]).astype({"v": float})
    expected = pdf.groupby("line").v.agg(["mean", "std", "var", "min", "max", "count"]).round(2)
    for line, want in expected.iterrows():
        row = found[(line,)]
        got = [row.avg_wait, row.std_wait, row.var_wait, row.min_wait, row.max_wait, row.wait_count]
        assert [np.nan if g is None else g for g in got] == pytest.approx(list(want), nan_ok=True, abs=0)
    assert {k[0]: r.outliers for k, r in found.items()} == {"A": 2, "B": 0, "C": 0, "D": 0, "E": 0, "F": 0}


def test_line_ranking(spark):
    ranked = [r.line_name for r in stats.line_ranking(frame(spark, MIXED)).collect()]
    assert ranked == ["A", "B", "C"]


def test_peak_hours_takes_the_earliest(spark):
    df = frame(spark, [("A", "S", "UP", h, v) for h, v in [(5, 3.0), (4, 3.0), (9, 1.0)]])
    assert [tuple(r) for r in stats.peak_hours(df).collect()] == [("A", 4, 3.0)]


def test_station_direction(spark):
    df = frame(spark, [("A", "S", "UP", 1, 1.0), ("A", "S", "DOWN", 1, 3.0), ("A", "T", "UP", 1, 1.0), ("A", "T", None, 1, 1.0)])
    got = {r.direction: (r.avg_wait, r.share) for r in stats.station_direction(df, "S").collect()}
    assert got == {"UP": (1.0, 0.25), "DOWN": (3.0, 0.75)}
    assert stats.station_direction(df, "T").collect() == []


def test_station_hourly(spark):
    assert [tuple(r) for r in stats.station_hourly(frame(spark, MIXED), "S1").collect()] == [(8, 2.0)]


def test_top_stations_ties(spark):
    df = frame(spark, [("L", f"S{i:02d}", "UP", 1, 5.0) for i in range(20)] + [("L", "Z", "UP", 1, 9.0), ("L", "Y", "UP", 1, None)])
    top = [r.station_code for r in stats.top_stations(df).collect()]
    assert top == ["Z"] + [f"S{i:02d}" for i in range(9)]


# ---- distribution -------------------------------------------------------------------------------
SAMPLES = {
    "one": [4.0],
    "two": [1.0, 2.0],
    "ties": [3.0] * 50 + [1.0, 9.0],
    "spread": [float(v) for v in np.random.default_rng(7).normal(0, 50, 997)],
    "nulls": [None, 2.0, None, 5.0, 5.0],
}


@pytest.mark.parametrize("name", SAMPLES)
def test_percentiles_match_pandas(spark, name):
    got = {r.percentile: r for r in distribution.percentiles(waits(spark, SAMPLES[name])).collect()}
    want = pd.Series(SAMPLES[name], dtype=float).quantile([p / 100 for p in distribution.PERCENTILES])
    for p, v in zip(distribution.PERCENTILES, want):
        assert got[f"{p}th"].wait_minutes == pytest.approx(v, abs=1e-12)
        assert got[f"{p}th"].wait_text == f"{got[f'{p}th'].wait_minutes:.1f}"


def test_percentiles_of_nothing(spark):
    rows = distribution.percentiles(waits(spark, [None])).collect()
    assert [r.wait_minutes for r in rows] == [None] * 7
    assert {r.wait_text for r in rows} == {"N/A"}


def test_percentile_sketch(spark):
    """The sketch gives a value of the data, within a rank of the exact position."""
    ordered = sorted(SAMPLES["spread"])
    sketch = distribution.percentiles(waits(spark, SAMPLES["spread"]), accuracy=10_000)
    for r, p in zip(sketch.collect(), distribution.PERCENTILES):
        position = p / 100 * (len(ordered) - 1)
        assert r.percentile == f"{p}th"
        assert abs(ordered.index(r.wait_minutes) - position) <= 1


@pytest.mark.parametrize("name", SAMPLES)
def test_cdf_matches_pandas(spark, name):
    values = pd.Series(SAMPLES[name], dtype=float).sort_values()
    want = values.rank(method="first") / len(values)
    got = distribution.cdf(waits(spark, SAMPLES[name])).toPandas()
    pairs = sorted(zip(got.iloc[:, 0].fillna(-1e9), got.probability.fillna(-1)))
    assert pairs == sorted(zip(values.fillna(-1e9), want.fillna(-1)))


def test_cdf_of_a_value_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(distribution, "RANK_BLOCK", 10)
    got = distribution.cdf(waits(spark, [1.0] * 25 + [2.0] * 10 + [0.0])).toPandas()
    assert sorted(got.probability) == pytest.approx([i / 36 for i in range(1, 37)])
    assert (got[got.columns[0]] == 1.0).sum() == 25


def test_cdf_steps(spark):
    steps = distribution.cdf_steps(waits(spark, [2.0, 1.0, 2.0, None])).collect()
    assert sorted(tuple(r) for r in steps) == [(1.0, 1, 1, 0.25), (2.0, 2, 3, 0.75)]


@pytest.fixture
def spread(spark):
    """40,000 different values in two groups, and a third of all rows at one value."""
    numbers = spark.range(40_000).select(
        F.when(F.col("id") % 4 == 0, "A").otherwise("B").alias("line_name"),
        (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / 7).alias(WAIT),
    )
    return numbers.unionAll(spark.range(20_000).select(F.lit("B"), F.lit(5e10)))


@pytest.mark.parametrize("by", [[], ["line_name"]])
def test_quantiles_count_few_values(spread, by):
    qs = [0.25, 0.5, 0.9]
    brackets = distribution._brackets(spread, WAIT, by, qs, 3 / distribution.ACCURACY)
    counts = distribution._narrowed(spread, WAIT, by, brackets, len(qs) + 2)
    assert counts.agg(F.sum("n")).first()[0] == 60_000
    assert counts.count() < 0.02 * 60_000
    got = distribution.percentiles(spread, by=by).toPandas()
    pdf = spread.toPandas()
    for p in distribution.PERCENTILES:
        mine = got[got.percentile == f"{p}th"]
        want = pdf.groupby("line_name")[WAIT].quantile(p / 100) if by else pdf[WAIT].quantile(p / 100)
        found = mine.set_index("line_name").wait_minutes.sort_index() if by else mine.wait_minutes.iloc[0]
        assert np.allclose(found, want, rtol=1e-12)


@pytest.mark.parametrize("by", [[], ["line_name"]])
def test_quantiles_widen_brackets_that_miss(spread, by, monkeypatch):
    """With a sketch that is far off, the proof fails until the brackets are as wide as the column."""
    real, margins = distribution._brackets, []

    def off(df, value, by, qs, margin):
        margins.append(margin)
        return real(df, value, by, [q / 3 for q in qs], margin)

    monkeypatch.setattr(distribution, "_brackets", off)
    row = distribution.box_stats(spread.filter("line_name = 'A'"), by=by).first()
    want = spread.filter("line_name = 'A'").toPandas()[WAIT].quantile([0.25, 0.5, 0.75])
    assert np.allclose([row.q1, row.median, row.q3], want, rtol=1e-12)
    assert len(margins) > 1


@pytest.mark.parametrize("few", [True, False])
def test_quantiles_of_many_groups(spread, monkeypatch, few):
    monkeypatch.setattr(distribution, "BROADCAST_BYTES", 8 << 20 if few else 0)
    got = distribution.box_stats(spread, by=["line_name"]).toPandas().set_index("line_name").sort_index()
    groups = spread.toPandas().groupby("line_name")[WAIT]
    assert np.allclose(got[["q1", "median", "q3"]], groups.quantile([0.25, 0.5, 0.75]).unstack())
    assert list(got.n) == list(groups.size())


def test_running_counts_by_group(spark):
    df = frame(spark, [(line, "S", "UP", 1, float(v % 7)) for line in "ABC" for v in range(40)])
    got = distribution.running_counts(df, by=["line_name"]).toPandas()
    for _, group in got.groupby("line_name"):
        group = group.sort_values("time_remaining_minutes")
        assert (group.total == 40).all()
        assert list(group.upto) == list(group.n.cumsum())


def test_histogram(spark):
    got = {r.bin: r.n for r in distribution.histogram(waits(spark, [0.0, 0.9, 1.0, 50.0, 49.0, None])).collect()}
    assert got == {0: 2, 1: 1, 49: 2}
    assert [(r.bin, r.n) for r in distribution.histogram(waits(spark, [3.0, 3.0])).collect()] == [(0, 2)]
    assert distribution.histogram(waits(spark, [None])).collect() == []


def test_box_stats(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    row = distribution.box_stats(waits(spark, values)).first()
    assert (row.least, row.whisker_low, row.q1, row.median, row.q3, row.whisker_high, row.greatest, row.n) == (
        1.0, 1.0, 2.0, 3.0, 4.0, 4.0, 100.0, 5,
    )
    by = distribution.box_stats(waits(spark, values).unionAll(waits(spark, [7.0, None], "B")), by=["line_name"])
    assert {r.line_name: (r.median, r.whisker_high, r.n) for r in by.collect()} == {"A": (3.0, 4.0, 5), "B": (7.0, 7.0, 1)}


# ---- frames -------------------------------------------------------------------------------------
def test_filters(spark):
    df = frame(spark, MIXED)
    assert frames.filter_frame(df).count() == 6  # an unknown hour fits no range
    assert frames.filter_frame(df, lines=["A", "B"]).count() == 4
    assert frames.filter_frame(df, hours=(8, 8)).count() == 2
    assert frames.filter_frame(df, date=dt.date(2024, 1, 1)).count() == 6
    assert frames.filter_frame(df, date="2024-01-02").isEmpty()


def test_domains(spark):
    got = [tuple(r) for r in frames.filter_domains(frame(spark, MIXED)).collect()]
    assert got == [("date", "2024-01-01"), ("hour", "07"), ("hour", "08"), ("hour", "09"),
                   ("line", "A"), ("line", "B"), ("line", "C")]
    assert tuple(frames.filter_defaults(frame(spark, MIXED)).first()) == (dt.date(2024, 1, 1), 7, 9)
    assert [r.station_code for r in frames.station_list(frame(spark, MIXED)).collect()] == ["S1", "S2", "S3"]


def test_statistics_of_an_empty_frame(spark):
    empty = frame(spark, [])
    for operator in (
        stats.hourly_line_avg, stats.wait_heatmap, stats.line_summary, stats.station_line_avg,
        stats.top_stations, stats.peak_hours, distribution.cdf, distribution.cdf_steps, distribution.histogram,
    ):
        assert operator(empty).isEmpty(), operator
    assert distribution.box_stats(empty, by=["line_name"]).isEmpty()


# ---- columns ------------------------------------------------------------------------------------
@pytest.mark.parametrize("value", [0.25, 0.35, 0.05, 0.15, 2.675, 51464.65, -0.25, -1.75, 12.0, 99.95, 0.449999])
def test_one_decimal_text(spark, value):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(C.one_decimal_text(F.col("v"))).first()[0] == f"{value:.1f}"


@pytest.mark.parametrize("value", [0.125, 0.375, 2.675, 0.285, 1.005, -0.125])
def test_round_half_even(spark, value):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(C.round_half_even(F.col("v"), 2)).first()[0] == np.round(value, 2)


def test_colours_and_names(spark):
    df = spark.createDataFrame([("TCL", "Island Line"), ("?", "?"), (None, None)], "code string, name string")
    got = df.select(C.line_color(F.col("code")), C.chart_color(F.col("name")), C.is_urban(F.col("code"))).collect()
    assert [tuple(r) for r in got] == [
        ("#F7943D", "#0075C2", False), ("#808080", "#1f77b4", False), ("#808080", "#1f77b4", False),
    ]


def test_minutes_skip_missing_columns(spark):
    df = spark.createDataFrame([(90, 1)], "a_seconds int, b int")
    out = C.with_minutes(df, ["a_seconds", "z_seconds"])
    assert out.columns == ["a_seconds", "b", "a_minutes"]
    assert out.first().a_minutes == 1.5


def test_headings(spark):
    df = frame(spark, MIXED)
    summary = stats.line_ranking(df).withColumnsRenamed(stats.SUMMARY_HEADINGS)
    assert summary.columns == [
        "line_name", "Avg Wait (min)", "Std Dev", "Variance", "Min (min)", "Max (min)", "Count", "Outliers (±2 SD)",
    ]
    table = distribution.percentiles(df).withColumnsRenamed(distribution.PERCENTILE_HEADINGS)
    assert {"Percentile", "Wait Time (min)"} <= set(table.columns)


def test_lookup_of_awkward_text(spark):
    table = {"it's": "a 'b'", "back\\slash": "c\\d"}
    df = spark.createDataFrame([("it's",), ("back\\slash",), ("x",)], "k string")
    got = [r[0] for r in df.select(C.lookup(F.col("k"), table, "none")).collect()]
    assert got == ["a 'b'", "c\\d", "none"]


@pytest.mark.parametrize("bins", [2, 7, 50])
def test_nice_bins(spark, bins):
    """Against steps tried one after the other in exact fractions."""
    from fractions import Fraction

    samples = [[0.0, 0.3, 0.7, 1.0], [1.0, 50.0], [-3.0, 4.5, 9.99], [1000.0, 1000.2], [5.0, 5.0], [0.1 * k for k in range(51)], [-7e6, 12.0]]
    for values in samples:
        exact = [Fraction(repr(v)) for v in values]
        lo, hi = min(exact), max(exact)
        step = Fraction(1)
        if hi > lo:
            tries = sorted(Fraction(d) * Fraction(10) ** e for d in (1, 2, 5) for e in range(-9, 9))
            step = next(s for s in tries if hi // s - lo // s < bins)
        want = {}
        for v in exact:
            want[v // step] = want.get(v // step, 0) + 1
        got = distribution.histogram(waits(spark, values), bins, nice=True).collect()
        assert {(r.bin, r.n) for r in got} == {(k - lo // step, n) for k, n in want.items()}
        for r in got:
            assert r.bin_start == pytest.approx(float((lo // step + r.bin) * step), abs=1e-9)
            assert r.bin_end - r.bin_start == pytest.approx(float(step))
    assert distribution.histogram(waits(spark, [None]), nice=True).collect() == []
    with pytest.raises(ValueError):
        distribution.histogram(waits(spark, [1.0]), 1, nice=True)


def test_boxes_as_charts_draw_them(spark):
    """Small groups of odd and even sizes, against the public rule: place q * n - 1/2 among the rows in order."""
    groups = {"A": [3.0], "B": [1.0, 2.0], "C": [1.0, 2.0, 4.0], "D": [1.0, 2.0, 4.0, 8.0], "E": [0.0, 1.0, 2.0, 3.0, 100.0], "F": [5.0] * 6 + [900.0], "G": [float(k * k) for k in range(10)]}

    def quartile(v, q):
        place = min(max(q * len(v) - 0.5, 0), len(v) - 1)
        low = int(place)
        return v[low] + (v[min(low + 1, len(v) - 1)] - v[low]) * (place - low)

    rows = [(line, x) for line, v in groups.items() for x in v]
    df = spark.createDataFrame(rows, f"line_name string, {WAIT} double")
    got = {r.line_name: r for r in distribution.box_stats(df, by=["line_name"], chart=True).collect()}
    for line, v in groups.items():
        q1, median, q3 = (quartile(v, q) for q in (0.25, 0.5, 0.75))
        reach = [x for x in v if q1 - 1.5 * (q3 - q1) <= x <= q3 + 1.5 * (q3 - q1)]
        r = got[line]
        assert [r.q1, r.median, r.q3] == pytest.approx([q1, median, q3])
        assert (r.whisker_low, r.whisker_high) == (min([*reach, q1]), max([*reach, q3]))
    one = distribution.box_stats(df.filter("line_name = 'D'"), chart=True).first()
    assert (one.q1, one.median, one.q3) == (1.5, 3.0, 6.0)
    assert distribution.box_stats(df.limit(0), by=["line_name"], chart=True).isEmpty()


def test_chart_quartiles_from_brackets(spread, monkeypatch):
    monkeypatch.setattr(distribution, "FEW_VALUES", 0)
    got = distribution.box_stats(spread, by=["line_name"], chart=True).toPandas().set_index("line_name").sort_index()
    groups = spread.toPandas().groupby("line_name")[WAIT]
    for column, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        want = [np.percentile(v, 100 * q, method="hazen") for _, v in sorted(groups)]
        assert np.allclose(got[column], want, rtol=1e-12)
