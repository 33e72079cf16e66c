"""Declarative data-quality checks: each finds failing rows; a run reports their number."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import network


class Check(NamedTuple):
    model: str
    column: str
    test: str  # not_null | unique | accepted_values
    values: tuple[str, ...] = ()


def _not_null(model: str, columns: str) -> list[Check]:
    return [Check(model, column, "not_null") for column in columns.split()]


# ---- fixed values: the declared checks ----------------------------------------------------------
DECLARED = (
    *_not_null(
        "stg_arrivals",
        "arrival_id line_code line_name station_code scheduled_arrival_time time_remaining_seconds"
        " is_delayed ingestion_timestamp ingestion_date",
    ),
    Check("stg_arrivals", "arrival_id", "unique"),
    Check("stg_arrivals", "line_code", "accepted_values", tuple(network.LINE_NAMES)),
    *_not_null("dim_lines", "line_code line_name"),
    Check("dim_lines", "line_code", "unique"),
    *_not_null("dim_stations", "station_code line_code"),
    *_not_null(
        "fact_delays",
        "ingestion_date hour line_code line_name station_code sample_count avg_wait_seconds",
    ),
)
# ---- end of fixed values ------------------------------------------------------------------------


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; nulls are ignored."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def check_accepted(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Rows whose value is not in the list; null passes."""
    return df.filter(~F.col(column).isin(list(values)))


def _row_failure(check: Check) -> Column:
    column = F.col(check.column)
    if check.test == "not_null":
        return column.isNull()
    return ~column.isin(list(check.values))


def _report(one_row: DataFrame, checks: list[Check]) -> DataFrame:
    """Turn one row with a count per check into a row per check."""
    entries = [
        F.struct(
            F.lit(c.model).alias("model"),
            F.lit(c.column).alias("column"),
            F.lit(c.test).alias("test"),
            F.col(f"f{i}").alias("failures"),
        )
        for i, c in enumerate(checks)
    ]
    return one_row.select(F.inline(F.array(*entries)))


def run_checks(models: Mapping[str, DataFrame], checks: Iterable[Check] = DECLARED) -> DataFrame:
    """``(model, column, test, failures)`` for every check of the given models.

    All row checks of a model share one pass, and so does its first uniqueness check: failing rows are
    counted per value, then summed. ``failures`` is null where the model or its column is missing: the
    check was not run, and that stays visible.
    """
    checks = list(checks)
    reports = []
    unread = [c for c in checks if c.model not in models]
    for model, df in models.items():
        mine = [c for c in checks if c.model == model]
        runnable = [c for c in mine if c.column in df.columns]
        by_row = [c for c in runnable if c.test != "unique"]
        unique = [c for c in runnable if c.test == "unique"]
        counts = [F.count_if(_row_failure(c)).alias(f"f{i}") for i, c in enumerate(by_row)]
        if by_row and unique:
            check, repeated = unique.pop(0), f"f{len(by_row)}"
            per_value = df.groupBy(F.col(check.column).alias("value")).agg(F.count(F.lit(1)).alias("n"), *counts)
            failures = F.count_if((F.col("n") > 1) & F.col("value").isNotNull()).alias(repeated)
            sums = [F.coalesce(F.sum(f"f{i}"), F.lit(0)).alias(f"f{i}") for i in range(len(by_row))]
            reports.append(_report(per_value.agg(*sums, failures), [*by_row, check]))
        elif by_row:
            reports.append(_report(df.agg(*counts), by_row))
        for check in unique:
            failures = check_unique(df, check.column).agg(F.count(F.lit(1)).alias("f0"))
            reports.append(_report(failures, [check]))
        absent = [c for c in mine if c not in runnable]
        if absent:
            none = df.sparkSession.range(1).select(
                *[F.lit(None).cast("bigint").alias(f"f{i}") for i in range(len(absent))]
            )
            reports.append(_report(none, absent))
    if unread:
        rows = [(c.model, c.column, c.test, None) for c in unread]
        spark = SparkSession.active()
        reports.append(spark.createDataFrame(rows, "model string, column string, test string, failures bigint"))
    return reduce(DataFrame.unionByName, reports)
