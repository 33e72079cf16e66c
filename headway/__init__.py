"""Public-transport wait-time analytics on Spark DataFrames."""

from headway.network import line_reference, station_reference
from headway.operators.anomaly import (
    anomaly_details,
    anomaly_points,
    anomaly_summary,
    flag_anomalies,
)
from headway.operators.dedupe import dedupe_latest
from headway.operators.distribution import (
    box_stats,
    cdf,
    cdf_steps,
    histogram,
    percentiles,
    value_counts,
)
from headway.operators.frames import (
    filter_defaults,
    filter_domains,
    filter_frame,
    newest,
    station_frame,
    station_list,
)
from headway.operators.ingest import (
    arrivals_from_schedules,
    parse_arrivals,
    parse_payload,
    rejected,
    restrict_to_network,
    with_line_name,
)
from headway.operators.quality import (
    check_accepted,
    check_not_null,
    check_unique,
    run_checks,
)
from headway.operators.stats import (
    hourly_line_avg,
    line_ranking,
    line_summary,
    outlier_count,
    overview,
    overview_text,
    peak_hours,
    station_direction,
    station_hourly,
    station_line_avg,
    top_stations,
    wait_heatmap,
)
from headway.operators.tiles import (
    tile_delay_share,
    tile_delay_trend,
    tile_filter,
    tile_peak_activity,
    tile_wait_by_line,
    with_delay_flag,
)
from headway.operators.waits import wait_metrics, with_bands, with_wait_category
from headway.plans.extracts import hourly_stats, recent_arrivals
from headway.plans.marts import build_marts, register_views
from headway.plans.models import (
    dim_lines,
    dim_stations,
    fact_delays,
    lines_per_station,
    stage_source,
    stg_arrivals,
)
from headway.plans.report import build_report
from headway.session import get_session
from headway.sources.raw import append_raw, append_with_summary, read_raw
from headway.sources.schedules import read_schedule_batch, read_schedule_stream
from headway.streaming.ingest import ingest_summary, start_ingest

__version__ = "0.1.0"
