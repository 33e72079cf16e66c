"""Plans that have to stay as they are for the operators to scale."""

import pytest

from checks import cases
from headway.plans import extracts, marts, models
from headway.schemas import RAW_COLUMNS
from headway.sources.raw import append_raw, read_raw
from tests.conftest import plan_of

WRITING = {"raw_append_and_scan", "ingest_stream", "published_marts"}


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "raw")
    append_raw(cases.zoned(cases.raw(spark, sf_dir)).select(*RAW_COLUMNS), path)
    return read_raw(spark, path)


@pytest.mark.parametrize("name", sorted(set(cases.QUERIES) - WRITING))
def test_no_cross_join_and_no_python(name, spark, sf_dir):
    plan = plan_of(cases.QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "InPandas"):
        assert operator not in plan


def test_dedup_limits_each_key_before_the_shuffle(stored):
    plan = plan_of(models.stg_arrivals(stored))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("row_number(), 1, Partial")


def test_fact_shuffles_twice_and_reads_few_columns(stored):
    plan = plan_of(models.fact_delays(models.stg_arrivals(stored)))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "PushedFilters: [IsNotNull(arrival_id)]" in plan
    for unused in ("dest_station", "platform", "direction", "sequence"):
        assert unused not in plan[plan.index("ReadSchema"):]


def test_recent_rows_prune_partitions_and_push_the_cutoff(stored):
    plan = plan_of(extracts.recent_arrivals(stored, 24, as_of=cases.AS_OF, limit=None))
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan
    assert "GreaterThanOrEqual(ingestion_timestamp" in plan
    assert "Exchange" not in plan


def test_recent_rows_as_of_now_prune_too(stored):
    plan = plan_of(extracts.recent_arrivals(stored, 24, limit=None))
    assert "GreaterThanOrEqual(ingestion_timestamp" in plan


def test_row_cap_prunes_days_at_run_time(stored):
    df = extracts.recent_arrivals(stored, 0, limit=50)
    df.collect()
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan
    assert "TakeOrderedAndProject(limit=50" in plan
    assert "ReadSchema: struct<>" in plan  # counting days reads no column


def test_hourly_stats_prune_partitions(stored):
    plan = plan_of(extracts.hourly_stats(stored, 7, as_of=cases.AS_OF_DATE))
    assert "(ingestion_date#" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert plan.count("Exchange hashpartitioning") == 1


def test_dimensions_of_the_written_fact_do_not_dedup_again(spark, stored, tmp_path):
    built = marts.build_marts(spark, stored, str(tmp_path))
    for name in ("dim_lines", "dim_stations"):
        assert "arrival_id" not in plan_of(models.dim_lines(built["fact_delays"]))
        assert built[name].count() > 0
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan_of(
        built["fact_delays"].filter("ingestion_date >= '2024-01-20'")
    )


def test_summaries_do_not_sort_the_hourly_statistics(spark, sf_dir):
    assert "rangepartitioning" in plan_of(cases.hourly(spark, sf_dir))
    assert "rangepartitioning" not in plan_of(cases.anomaly_summary(spark, sf_dir))


def test_rebuild_drops_days_that_are_gone(spark, stored, tmp_path):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        marts.build_marts(spark, stored, str(tmp_path))
        built = marts.build_marts(spark, stored.filter("ingestion_date = '2024-01-15'"), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert built["fact_delays"].select("ingestion_date").distinct().count() == 1


def test_statistics_reduce_before_the_shuffle(spark, sf_dir):
    """Every grouping of raw rows has its partial aggregate below the first exchange."""
    for name in ("overview", "hourly_line_avg", "station_line_avg", "tile_delay_trend", "check_unique"):
        plan = plan_of(cases.QUERIES[name](spark, sf_dir))
        below = plan[plan.rindex("Exchange"):]
        assert "partial_" in below or "HashAggregate" in below
