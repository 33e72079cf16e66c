"""One key, value, day or stamp with a third of all rows: results stay whole and exact."""

import pytest
from pyspark.sql import functions as F

from headway.operators import distribution, quality, stats
from headway.operators.dedupe import dedupe_latest
from headway.operators.frames import newest
from headway.sources.raw import append_raw, read_raw

N = 60_000


@pytest.fixture(scope="module")
def skewed(spark):
    """Rows of which a third share one id, line, wait, day and stamp."""
    hot = F.col("id") % 3 == 0
    spread = F.col("id") % 1009
    stamp = F.timestamp_seconds(F.lit(1_704_067_200) + F.when(hot, 500_000).otherwise(F.col("id") * 7))
    return spark.range(N).select(
        F.when(hot, "hot").otherwise(F.col("id").cast("string")).alias("arrival_id"),
        F.when(hot, "A").otherwise(F.concat(F.lit("L"), F.col("id") % 5)).alias("line_name"),
        F.when(hot, 3.0).otherwise(spread / 8).alias("time_remaining_minutes"),
        stamp.alias("ingestion_timestamp"),
        F.to_date(stamp).alias("ingestion_date"),
        F.col("id").alias("event_id"),
    )


@pytest.fixture(scope="module")
def pdf(skewed):
    return skewed.toPandas()


def test_dedupe(skewed, pdf):
    got = dedupe_latest(skewed, ["arrival_id"], [F.col("ingestion_timestamp").desc(), F.col("event_id").desc()])
    rows = got.select("arrival_id", "event_id").toPandas()
    want = pdf.sort_values(["ingestion_timestamp", "event_id"]).groupby("arrival_id").event_id.last()
    assert rows.set_index("arrival_id").event_id.sort_index().equals(want.sort_index())


def test_unique(skewed):
    assert [tuple(r) for r in quality.check_unique(skewed, "arrival_id").collect()] == [("hot", N // 3)]


def test_percentiles(skewed, pdf):
    ps = distribution.PERCENTILES
    got = {r.percentile: r.wait_minutes for r in distribution.percentiles(skewed).collect()}
    want = pdf.time_remaining_minutes.quantile([p / 100 for p in ps])
    assert [got[f"{p}th"] for p in ps] == pytest.approx(list(want))


def test_cdf_is_whole(skewed, pdf):
    got = distribution.cdf(skewed).toPandas().sort_values("probability", ignore_index=True)
    values = pdf.time_remaining_minutes.sort_values(ignore_index=True)
    assert len(got) == N
    assert got.time_remaining_minutes.equals(values)
    assert got.probability.tolist() == pytest.approx([(i + 1) / N for i in range(N)])


def test_line_summary(skewed, pdf):
    got = stats.line_summary(skewed).toPandas().set_index("line_name").sort_index()
    groups = pdf.groupby("line_name").time_remaining_minutes
    assert got.wait_count.tolist() == groups.count().sort_index().tolist()

    def outliers(v):
        return int(((v > v.mean() + 2 * v.std()) | (v < v.mean() - 2 * v.std())).sum())

    assert got.outliers.tolist() == [outliers(v) for _, v in sorted(dict(list(groups)).items())]


@pytest.mark.parametrize("n", [10, N // 2])
def test_newest(skewed, pdf, n):
    got = newest(skewed, n, "ingestion_timestamp", "ingestion_date").select("ingestion_timestamp").toPandas()
    want = pdf.ingestion_timestamp.sort_values(ascending=False, ignore_index=True).head(n)
    assert got.ingestion_timestamp.equals(want.rename("ingestion_timestamp"))


def test_newest_when_the_hot_stamp_is_the_newest(skewed):
    early = skewed.filter("ingestion_timestamp <= timestamp_seconds(1704067200 + 500000)")
    rows = newest(early, 5000, "ingestion_timestamp", "ingestion_date")
    assert rows.agg(F.count_distinct("ingestion_timestamp"), F.count(F.lit(1))).first() == (1, 5000)


def test_append_of_a_hot_day(spark, skewed, tmp_path):
    rows = skewed.select(
        F.sha2(F.col("event_id").cast("string"), 256).alias("arrival_id"), F.col("line_name").alias("line_code"), "line_name", F.lit("S").alias("station_code"),
        F.lit("D").alias("dest_station"), F.lit("1").alias("platform"), F.lit(1).cast("bigint").alias("sequence"),
        F.col("ingestion_timestamp").alias("arrival_time"), F.lit(60).cast("bigint").alias("time_remaining"),
        F.lit("UP").alias("direction"), "ingestion_timestamp", "ingestion_date",
    )
    # A small target size stands in for a day far above the real one.
    target = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(target)
    spark.conf.set(target, "1m")
    try:
        append_raw(rows, str(tmp_path / "raw"))
    finally:
        spark.conf.set(target, before)
    stored = read_raw(spark, str(tmp_path / "raw"))
    located = stored.select("ingestion_date", F.input_file_name().alias("file"))
    days = located.groupBy("ingestion_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("file").alias("files")
    ).toPandas()
    assert days.n.sum() == N
    hot = days.loc[days.n.idxmax()]
    assert hot.files > 1  # the heavy day is written by several tasks
    assert days.files.sum() < 8 * len(days)  # without a file per task and day


@pytest.fixture(scope="module")
def many_groups(spark):
    """3,000 groups of near-unique values, one of them with a third of all rows, five with a few hundredths each."""
    k = F.col("id")
    group = F.when(k % 3 == 0, 0).when(k % 3 == 1, 1 + k % 5).otherwise(6 + F.pmod(F.xxhash64("id"), F.lit(2994)))
    return spark.range(N).select(
        F.concat(F.lit("G"), group).alias("line_name"), ((k * 7919) % 1_000_003 / 8).alias("time_remaining_minutes")
    )


def test_quantiles_of_many_groups(many_groups, monkeypatch):
    """Only the largest groups get brackets; the others meet in one shuffle and are never cut into ranges."""
    monkeypatch.setattr(distribution, "ACCURACY", 200)
    monkeypatch.setattr(distribution, "FEW_VALUES", 1000)
    monkeypatch.setattr(distribution, "BROADCAST_BYTES", 40 * distribution.ROW_BYTES)
    narrowed, ranged, placed = [], [], []
    for name, seen in (("_narrowed", narrowed), ("_ranged", ranged), ("_running_in_place", placed)):
        real = getattr(distribution, name)
        monkeypatch.setattr(distribution, name, lambda df, *args, real=real, seen=seen: seen.append(df) or real(df, *args))
    box = distribution.box_stats(many_groups, by=["line_name"]).toPandas().set_index("line_name").sort_index()
    pdf = many_groups.toPandas()
    waits = pdf.groupby("line_name").time_remaining_minutes
    for column, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        assert box[column].tolist() == pytest.approx(waits.quantile(q).sort_index().tolist())
    assert box.n.tolist() == waits.size().sort_index().tolist() and len(box) > 2900
    lines = distribution.percentiles(many_groups, by=["line_name"]).toPandas()
    for p in distribution.PERCENTILES:
        got = lines[lines.percentile == f"{p}th"].set_index("line_name").wait_minutes.sort_index()
        assert got.tolist() == pytest.approx(waits.quantile(p / 100).sort_index().tolist())
    large = {r[0] for r in narrowed[0].select("line_name").distinct().collect()}
    assert large == {f"G{k}" for k in range(6)}
    # What the large groups send is a few hundredths of their rows; the others are counted where they met.
    assert ranged[0].count() < 0.2 * narrowed[0].count()
    plan = placed[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(line_name") == 1 and "rangepartitioning" not in plan


def test_few_values_are_counted_outright(skewed, monkeypatch):
    monkeypatch.setattr(distribution, "_brackets", None)
    monkeypatch.setattr(distribution, "_ranged", None)
    assert distribution.percentiles(skewed).count() == len(distribution.PERCENTILES)
    monkeypatch.setattr(distribution, "FEW_VALUES", 1 << 14)
    assert distribution.percentiles(skewed, by=["line_name"]).count() == 6 * len(distribution.PERCENTILES)
    assert distribution.box_stats(skewed).first().n == N
