"""Many random or combined inputs in one job each, against plain Python and pandas."""

import itertools
import json

import numpy as np
import pandas as pd
import pytest

from headway.operators import distribution, ingest, stats
from headway.schemas import ENVELOPE
from tests.frames_util import frame
from tests.test_ingest import GOOD, NOW, train

# What one direction may hold, and what becomes of it: rows as (wait, destination), or a loss of the
# direction ("lost") or of the whole document ("all").
LISTS = {
    "absent": (..., []),
    "null": (None, []),
    "empty": ([], []),
    "blank train": ([{}], []),
    "one": ([train(dest="A")], [(180, "A")]),
    "out of order": ([train(seq="5", dest="A"), train(seq="2", dest="B", ttnt="7")], [(420, "B")]),
    "tie": ([train(dest="A"), train(dest="B")], [(180, "A")]),
    "no seq wins": ([train(dest="A"), train(seq=..., dest="B")], [(180, "B")]),
    "bad later": ([train(dest="A"), train(seq="9", ttnt="x", time="x")], [(180, "A")]),
    "bad wait": ([train(ttnt="soon")], "lost"),
    "negative": ([train(ttnt="-3")], "lost"),
    "bad time": ([train(time="noon")], "lost"),
    "negative and bad time": ([train(ttnt="-3", time="noon")], "lost"),
    "null seq": ([train(), train(seq=None)], "all"),
    "text seq": ([train(seq="first")], "all"),
    "null wait": ([train(ttnt=None)], "all"),
    "null wait second": ([train(), train(seq="2", ttnt=None)], [(180, "TUC")]),
    "null wait and bad time": ([train(ttnt=None, time="noon")], "all"),
    "only a seq": ([{"seq": "1"}], [(0, "")]),
}


def test_every_pair_of_directions(spark):
    documents, expected = [], set()
    for i, (up, down) in enumerate(itertools.product(LISTS, repeat=2)):
        stop = f"S{i}"
        board = {d: LISTS[k][0] for d, k in (("UP", up), ("DOWN", down)) if LISTS[k][0] is not ...}
        documents.append(("TCL", stop, NOW, json.dumps({"data": {f"TCL-{stop}": board}})))
        if "all" in (LISTS[up][1], LISTS[down][1]):
            continue
        for direction, kind in (("UP", up), ("DOWN", down)):
            if LISTS[kind][1] != "lost":
                expected |= {(stop, direction, wait, dest) for wait, dest in LISTS[kind][1]}
    rows = ingest.parse_arrivals(spark.createDataFrame(documents, ENVELOPE)).collect()
    found = [(r.station_code, r.direction, r.time_remaining, r.dest_station) for r in rows]
    assert len(found) == len(set(found))
    assert set(found) == expected
    assert GOOD == train()  # the shared train was not changed by the variants


@pytest.fixture(scope="module")
def random_groups(spark):
    """300 groups of 1 to 60 waits: few or many distinct values, of either sign, some null."""
    rng = np.random.default_rng(20240101)
    rows = []
    for g in range(300):
        size = int(rng.integers(1, 60))
        kind = g % 4
        values = rng.integers(-5, 40, size) if kind < 2 else rng.normal(10, 30, size).round(3)
        if kind == 1:
            values = np.repeat(values[:1], size)
        nulls = rng.random(size) < (0.2 if g % 3 else 0.0)
        rows += [(f"G{g:03d}", "S", "UP", 1, None if n else float(v)) for v, n in zip(values, nulls)]
    pdf = pd.DataFrame([(r[0], r[4]) for r in rows], columns=["g", "v"]).astype({"v": float})
    return frame(spark, rows), pdf


def test_summaries(random_groups):
    df, pdf = random_groups
    got = stats.line_summary(df).toPandas().set_index("line_name").sort_index().astype(float)
    want = pdf.groupby("g").v.agg(["mean", "std", "var", "min", "max", "count"])
    names = ["avg_wait", "std_wait", "var_wait", "min_wait", "max_wait", "wait_count"]
    # Sums in another order may fall on the other side of a rounding edge: allow one last digit.
    assert np.allclose(got[names], want.round(2), atol=0.0101, equal_nan=True)

    def outliers(v):
        m, s = v.mean(), v.std()
        return 0 if pd.isna(s) else int(((v > m + 2 * s) | (v < m - 2 * s)).sum())

    assert got.outliers.astype(int).tolist() == [outliers(v) for _, v in pdf.groupby("g").v]


def test_quantiles(random_groups):
    df, pdf = random_groups
    got = distribution.percentiles(df, by=["line_name"]).toPandas()
    got = got.pivot(index="line_name", columns="percentile", values="wait_minutes").sort_index()
    known = pdf.dropna().groupby("g").v
    for p in distribution.PERCENTILES:
        assert np.allclose(got[f"{p}th"], known.quantile(p / 100))


def test_boxes(random_groups):
    df, pdf = random_groups
    got = distribution.box_stats(df, by=["line_name"]).toPandas().set_index("line_name").sort_index()
    for (_, row), (_, v) in zip(got.iterrows(), pdf.dropna().groupby("g").v):
        q1, q3 = v.quantile(0.25), v.quantile(0.75)
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        assert (row.least, row.greatest, row.n) == (v.min(), v.max(), len(v))
        assert (row.whisker_low, row.whisker_high) == (inside.min(), inside.max())


def test_whole_distribution(random_groups):
    df, pdf = random_groups
    got = distribution.cdf(df).toPandas()
    values = pdf.v.sort_values()
    want = values.rank(method="first") / len(values)
    assert len(got) == len(pdf)
    assert sorted(zip(got.iloc[:, 0].fillna(-1e9), got.probability.fillna(-1))) == sorted(
        zip(values.fillna(-1e9), want.fillna(-1))
    )
    counts = distribution.histogram(df).toPandas().set_index("bin").n
    assert counts.sum() == pdf.v.count()
