"""Column expressions shared by the operators. All stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import network


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_array(values: Iterable[str]) -> Column:
    """An array literal of fixed texts."""
    return F.expr(f"array({', '.join(map(_quoted, values))})")


def lookup(key: Column, table: dict[str, str], default: str) -> Column:
    """Value of ``key`` in a small fixed table; unknown and null keys give ``default``."""
    entries = ", ".join(f"{_quoted(k)}, {_quoted(v)}" for k, v in table.items())
    return F.coalesce(F.try_element_at(F.expr(f"map({entries})"), key), F.lit(default))


def line_color(line_code: Column) -> Column:
    return lookup(line_code, network.LINE_COLORS, network.DEFAULT_LINE_COLOR)


def chart_color(line_name: Column) -> Column:
    return lookup(line_name, network.CHART_COLORS, network.DEFAULT_CHART_COLOR)


def is_urban(line_code: Column) -> Column:
    return F.coalesce(line_code.isin(network.URBAN_LINES), F.lit(False))


def clock_hour(ts: Column) -> Column:
    """Hour of the wall clock as a 64-bit integer."""
    return F.hour(ts).cast("bigint")


def round_half_even(value: Column, digits: int) -> Column:
    """Scale, round half to even, scale back: the rounding of numpy and pandas."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def nearest_tenth(value: Column) -> Column:
    """The nearest multiple of 0.1 to the binary value, exact ties to the even tenth.

    Spark rounds the shortest decimal text of a double, which calls 0.35 a tie although the double
    lies below it. Here ``halves`` counts twentieths; where it is odd the value is near a tie, and
    ``excess``, whose steps are all exact in binary, tells the side.
    """
    halves = F.rint(value * 20.0)
    excess = (value * 16.0 - halves) + value * 4.0
    tenths = (
        F.when(halves % 2 == 0, halves / 2)
        .when(excess > 0, (halves + 1) / 2)
        .when(excess < 0, (halves - 1) / 2)
        .otherwise(F.rint(halves / 2))
    )
    return tenths / 10.0


def one_decimal_text(value: Column, suffix: str = "", missing: str = "N/A") -> Column:
    """Text with one decimal and a fallback for null."""
    shown = F.format_string(f"%.1f{suffix}", nearest_tenth(value.cast("double")))
    return F.when(value.isNull(), F.lit(missing)).otherwise(shown)


def thousands_text(value: Column) -> Column:
    """Integer text with thousands separators."""
    return F.format_number(value, 0)


def outside_band(value: Column, mean: Column, std: Column, k: float) -> Column:
    """True where ``value`` lies strictly outside ``mean ± k·std``; false where undefined.

    Without any deviation all values are equal and none is outside, even if the mean, a rounded
    quotient, differs from them in the last bit.
    """
    beyond = (value > mean + k * std) | (value < mean - k * std)
    return F.coalesce((std > 0) & beyond, F.lit(False))


def all_present(names: Iterable[str]) -> Column:
    """True where none of the named columns is null."""
    result = F.lit(True)
    for name in names:
        result = result & F.col(name).isNotNull()
    return result


def with_minutes(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Add an ``x_minutes`` column for every named ``x_seconds`` column that exists.

    By default every ``*_seconds`` column is converted.
    """
    wanted = [c for c in df.columns if c.endswith("_seconds")] if columns is None else columns
    return df.withColumns(
        {c.replace("_seconds", "_minutes"): F.col(c) / F.lit(60) for c in wanted if c in df.columns}
    )
