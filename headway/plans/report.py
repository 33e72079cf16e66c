"""One page of the report: the filtered frame and every statistic drawn from it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from headway.operators import anomaly, distribution, frames, stats, tiles
from headway.plans.extracts import ALL_DAYS, hourly_stats, recent_arrivals
from headway.session import durable

HOURS_BACK = 168  # fixed value
DAYS_BACK = 7  # fixed value
COLUMNS = ("date", "hour", "line_name", "station_code", "direction", "time_remaining_minutes")


@dataclass
class Report:
    """Lazy frames by name; ``note`` says why there are none. ``close`` frees the cached frame."""

    frames: dict[str, DataFrame] = field(default_factory=dict)
    note: str | None = None
    cached: DataFrame | None = None

    def close(self) -> None:
        if self.cached is not None:
            self.cached.unpersist()


def build_report(
    raw: DataFrame,
    date: dt.date | str | None = None,
    lines: Iterable[str] = (),
    hours: tuple[int, int] | None = None,
    station: str | None = None,
    as_of: dt.datetime | None = None,
    limit: int | None = None,
    hours_back: int | None = HOURS_BACK,
    days_back: int | None = DAYS_BACK,
    fact: DataFrame | None = None,
) -> Report:
    """Statistics of the chosen date, lines and hours; by default the last date and all the rest.

    With the published ``fact`` table come the tiles of its last days, and those of delays where ``raw``
    has the column ``is_delayed``.

    They cover every row of the last ``hours_back`` hours; anomalies are of the last ``days_back`` days.

    Some twenty statistics read the same few columns. A frame that the caller caps is written once; an
    uncapped one is cached after the filters, to disk where
    memory is short.
    """
    frame = recent_arrivals(raw, hours_back, as_of, limit).select(*COLUMNS)
    if limit is not None:
        frame = durable(frame)
    defaults = frames.filter_defaults(frame).first()
    if defaults.default_date is None:
        return Report(note="no arrivals in the period")
    chosen_hours = hours or (defaults.min_hour, defaults.max_hour)
    filtered = frames.filter_frame(frame, date or defaults.default_date, lines, chosen_hours)
    cached = None
    if limit is None:
        filtered = cached = filtered.persist(StorageLevel.MEMORY_AND_DISK)
    if filtered.isEmpty():
        return Report(note="no arrivals match the filters", cached=cached)
    if station is None:
        station = frames.station_list(filtered).first().station_code
    overview = stats.overview(filtered)
    found = {
        "filter_domains": frames.filter_domains(frame),
        "overview": overview,
        "overview_text": stats.overview_text(overview),
        "outlier_count": stats.outlier_count(filtered),
        "hourly_line_avg": stats.hourly_line_avg(filtered),
        "wait_heatmap": stats.wait_heatmap(filtered),
        "line_ranking": stats.line_ranking(filtered),
        "line_boxes": distribution.box_stats(filtered, by=["line_name"]),
        "peak_hours": stats.peak_hours(filtered),
        "station_list": frames.station_list(filtered),
        "station_hourly": stats.station_hourly(filtered, station),
        "station_direction": stats.station_direction(filtered, station),
        "top_stations": stats.top_stations(filtered),
        "histogram": distribution.histogram(filtered),
        "box": distribution.box_stats(filtered),
        "cdf_steps": distribution.cdf_steps(filtered),
        "percentiles": distribution.percentiles(filtered),
    }
    # One row per hour and station: little to write, and three readers.
    hourly = durable(hourly_stats(raw, days_back, as_of.date() if as_of else None))
    found |= {
        "anomaly_summary": anomaly.anomaly_summary(hourly),
        "anomaly_points": anomaly.anomaly_points(hourly),
        "anomaly_details": anomaly.anomaly_details(hourly),
    }
    if fact is not None:
        day = as_of.date() if as_of else None
        span = None if days_back is None or days_back >= ALL_DAYS else days_back
        hours_of_fact = tiles.tile_filter(fact, span, as_of=day)
        found["tile_wait_by_line"] = tiles.tile_wait_by_line(hours_of_fact)
        found["tile_peak_activity"] = tiles.tile_peak_activity(hours_of_fact)
        if "is_delayed" in raw.columns:
            arrivals = tiles.tile_filter(raw, span, as_of=day)
            found["tile_delay_trend"] = tiles.tile_delay_trend(arrivals)
            found["tile_delay_share"] = tiles.tile_delay_share(arrivals)
    return Report(frames=found, cached=cached)
