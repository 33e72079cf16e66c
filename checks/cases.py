"""The registered queries. Each runs over whole tables; SQL is given where one engine can check it."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.tables import LINE, hourly_since, over, sql_case, sql_in, sql_list
from headway import network
from headway.functions import columns as C
from headway.operators import anomaly, distribution, frames, ingest, quality, stats, tiles, waits
from headway.plans import extracts, marts, models, report
from headway.schemas import RAW_COLUMNS
from headway.session import durable, ensure_checkpoint_dir
from headway.sources import batches
from headway.sources import events as sample
from headway.sources import raw as raw_table
from headway.sources.schedules import read_schedule_batch, read_schedule_stream
from headway.streaming.ingest import ONCE, follow_ingest, follow_outcomes, start_ingest, start_outcomes, start_rejects

AS_OF = "2024-01-30 12:00:00"
AS_OF_DATE = "2024-01-30"
STATION = "S021"
CHOSEN = {"date": "2024-01-15", "lines": ["Island Line", "Airport Express", "Unknown"], "hours": (6, 20)}
TIE_BREAK = ("event_id",)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def case(sql: str | None = None, name: str | None = None):
    """Register a query under its function's name, with the SQL it must agree with."""

    def register(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return register


# ---- inputs -------------------------------------------------------------------------------------
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def raw(spark, sf, **kind) -> DataFrame:
    return sample.raw_from_events(table(spark, sf, "events"), **kind)


def staging(spark, sf, **kind) -> DataFrame:
    return models.stg_arrivals(raw(spark, sf, **kind), extra=["event_id"], tie_break=TIE_BREAK)


def frame(spark, sf, **kind) -> DataFrame:
    """The analysis frame over every row of the table."""
    return extracts.recent_arrivals(raw(spark, sf, **kind), hours_back=None)


def hourly(spark, sf, **kind) -> DataFrame:
    return extracts.hourly_stats(raw(spark, sf, **kind), days_back=extracts.ALL_DAYS)


def envelopes(spark, sf) -> DataFrame:
    return sample.envelopes_from_events(table(spark, sf, "events"))


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder beside the session's checkpoints, which every executor can reach."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{what}-{uuid.uuid4().hex}")


def land(docs: DataFrame, path: str) -> None:
    """More documents into a folder, as JSON files."""
    zoned(docs).write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)


def landed(spark: SparkSession, sf: str) -> str:
    """The documents of the events, landed as JSON files."""
    path = scratch(spark, "landing")
    land(envelopes(spark, sf), path)
    return path


def in_order(df: DataFrame) -> DataFrame:
    """``df``, a small ordered frame, with the position of each row."""
    return df.coalesce(1).withColumn("position", F.monotonically_increasing_id())


def retype(df: DataFrame, old: T.DataType, new: T.DataType) -> DataFrame:
    return df.withColumns({f.name: F.col(f.name).cast(new) for f in df.schema if f.dataType == old})


def zoned(df: DataFrame) -> DataFrame:
    """Zone-less stamps as the stored timestamp type."""
    return retype(df, T.TimestampNTZType(), T.TimestampType())


def zoneless(df: DataFrame) -> DataFrame:
    return retype(df, T.TimestampType(), T.TimestampNTZType())


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles cut to what two engines can agree on, since they sum in different orders."""
    return df.withColumns(
        {f.name: F.round(f.name, digits) for f in df.schema if f.dataType == T.DoubleType()}
    )


def names(columns) -> str:
    return ", ".join(columns)


def r6(expr: str, alias: str | None = None) -> str:
    return f"round({expr}, 6) AS {alias or expr}"


RAW_LIST = names(RAW_COLUMNS)
STAGING_LIST = names(models.STAGING_COLUMNS) + ", row_num"
_WAITS = ["avg_wait_seconds", "std_wait_seconds"]
_BOUNDS = ["upper_bound_seconds", "lower_bound_seconds"]
HOURLY_LIST = (
    names(waits.HOURLY_KEYS)
    + ", sample_count, min_wait_seconds, max_wait_seconds, "
    + names(r6(c) for c in _WAITS + _BOUNDS)
)
MINUTES_LIST = names(
    r6(f"{c} / 60", c.replace("_seconds", "_minutes"))
    for c in [*_WAITS, "min_wait_seconds", "max_wait_seconds", *_BOUNDS]
)
FRAME_LIST = (
    "arrival_id, line_code, line_name, station_code, time_remaining_seconds, direction, "
    "ingestion_timestamp, ingestion_date, hour, date, " + r6("time_remaining_minutes")
)


# ---- ingest -------------------------------------------------------------------------------------
@case(over("arrived", f"SELECT {RAW_LIST} FROM arrived"))
def ingest_arrivals(spark, sf):
    return ingest.arrivals_from_schedules(envelopes(spark, sf))


@case(
    over(
        "documents",
        """SELECT line_code, station_code, ts AS fetched_at, NULL::VARCHAR AS direction, fault AS reason
           FROM documents WHERE known AND fault <> 'empty'
           UNION ALL
           SELECT line_code, station_code, ts, 'UP', up_fault
           FROM documents WHERE known AND fault IS NULL AND up_fault IS NOT NULL""",
    )
)
def ingest_rejects(spark, sf):
    return ingest.rejected(ingest.restrict_to_network(envelopes(spark, sf))).drop("payload")


@case(over("documents", "SELECT line_code, station_code, ts AS fetched_at FROM documents WHERE known"))
def network_restriction(spark, sf):
    return ingest.restrict_to_network(envelopes(spark, sf)).drop("payload")


@case(
    over("documents", """SELECT line_code, station_code, ts AS fetched_at FROM documents
                         WHERE line_code IN ('TCL', 'ISL')""")
)
def network_restriction_by_line(spark, sf):
    return ingest.restrict_to_network(envelopes(spark, sf), lines=["TCL", "ISL", "XXX"]).drop("payload")


@case(over("arrived", f"SELECT {RAW_LIST} FROM arrived"))
def ingest_stream(spark, sf):
    """Stream the table's documents through the ingest into a raw table, then read that table."""
    schema = table(spark, sf, "events").schema
    # As a pattern the path may be one file or a folder of files; a stream takes no plain file path.
    source = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")
    arrivals = ingest.arrivals_from_schedules(zoned(sample.envelopes_from_events(source)))
    path = scratch(spark, "raw")
    start_ingest(arrivals, path, scratch(spark, "offsets"), ONCE).awaitTermination()
    return zoneless(raw_table.read_raw(spark, path))


@case(over("arrived", f"SELECT {RAW_LIST} FROM arrived"))
def ingest_landed_batch(spark, sf):
    """The documents as JSON files, read as one batch."""
    return zoneless(ingest.arrivals_from_schedules(read_schedule_batch(spark, landed(spark, sf))))


@case(over("arrived", "SELECT 'success' AS status, count(*) AS inserted FROM arrived"))
def ingest_landed_summary(spark, sf):
    """The documents as JSON files, streamed a few files at a time; what the run reports."""
    stream = read_schedule_stream(spark, landed(spark, sf), 2)
    arrivals = ingest.arrivals_from_schedules(stream)
    summary = follow_ingest(start_ingest(arrivals, scratch(spark, "raw"), scratch(spark, "offsets"), ONCE))
    return spark.createDataFrame([(summary["status"], summary["inserted"])], "status string, inserted bigint")


@case(
    over(
        "documents",
        """SELECT line_code, station_code, ts AS fetched_at, NULL::VARCHAR AS direction, fault AS reason
           FROM documents WHERE known AND fault <> 'empty'
           UNION ALL
           SELECT line_code, station_code, ts, 'UP', up_fault
           FROM documents WHERE known AND fault IS NULL AND up_fault IS NOT NULL
           UNION ALL
           SELECT line_code, station_code, ts, NULL, 'unlisted_station' FROM documents WHERE NOT known""",
    )
)
def ingest_stream_rejects(spark, sf):
    """All rejected documents, streamed from JSON files into files of their own."""
    rejects = ingest.rejected_documents(read_schedule_stream(spark, landed(spark, sf), 2))
    path = scratch(spark, "rejects")
    start_rejects(rejects, path, scratch(spark, "offsets"), ONCE).awaitTermination()
    return zoneless(spark.read.parquet(path).drop("payload", "fetched_date"))


TYPED_COLUMNS = [
    "line_code", "station_code", "fetched_at", "direction", "time_remaining", "arrival_time", "platform", "reason"
]
# The documents of ``typed_envelopes_from_events``: what is in them, without the JSON around it.
TYPED = f"""typed AS (
  SELECT line_code, station_code, ts AS fetched_at,
         CASE WHEN reason IN ('bad_sequence', 'wrong_type') THEN NULL ELSE 'UP' END AS direction,
         CASE WHEN reason IN ('bad_sequence', 'wrong_type') THEN NULL ELSE CAST(wait * 60 AS VARCHAR) END AS time_remaining,
         CASE WHEN reason IN ('bad_sequence', 'wrong_type') OR event_id % 5 = 3 THEN NULL
              WHEN event_id % 5 < 2 THEN date_trunc('second', ts) ELSE ts END AS arrival_time,
         CASE WHEN reason IN ('bad_sequence', 'wrong_type') THEN NULL ELSE CAST(event_id % 4 AS VARCHAR) END AS platform,
         reason
  FROM (
    SELECT *, CASE WHEN event_id % 7 = 3 THEN 'bad_sequence'
                   WHEN event_id % 8 = 6 THEN 'wrong_type'
                   WHEN event_id % 8 = 2 THEN 'bad_wait'
                   WHEN event_id % 8 = 4 THEN 'negative_wait'
                   WHEN event_id % 5 = 3 THEN 'wrong_type' END AS reason
    FROM (
      SELECT *, {sql_case("line_code", {k: v[0] for k, v in network.LINE_STATIONS.items()}, "none")} AS station_code,
             CASE event_id % 8 WHEN 0 THEN steps WHEN 1 THEN steps WHEN 3 THEN 1
                  WHEN 4 THEN -CAST('1' || steps AS BIGINT) WHEN 5 THEN steps WHEN 7 THEN steps * 10 END AS wait
      FROM (SELECT *, {LINE} AS line_code, CAST(floor(value / 10) AS BIGINT) AS steps FROM events)
    )
  )
  WHERE station_code <> 'none'
)"""

_REJECTS = """SELECT line_code, station_code, ts AS fetched_at, NULL::VARCHAR AS direction, fault AS reason
           FROM documents WHERE known AND fault <> 'empty'
           UNION ALL
           SELECT line_code, station_code, ts, 'UP', up_fault
           FROM documents WHERE known AND fault IS NULL AND up_fault IS NOT NULL
           UNION ALL
           SELECT line_code, station_code, ts, NULL, 'unlisted_station' FROM documents WHERE NOT known"""


def drained(spark: SparkSession, sf: str) -> tuple[str, dict]:
    """The table that a stream of many micro-batches leaves, ended and taken up again; its last summary."""
    landing, path, offsets = scratch(spark, "landing"), scratch(spark, "raw"), scratch(spark, "offsets")
    for part in range(2):
        land(envelopes(spark, sf).filter(F.crc32("payload") % 2 == part).repartitionByRange(3, "fetched_at"), landing)
        query = start_outcomes(read_schedule_stream(spark, landing, 1), path, offsets, ONCE)
        summary = follow_outcomes(spark, query, path)
    return path, summary


@case(over("arrived", f"SELECT {RAW_LIST} FROM arrived"))
def ingest_stream_compacted(spark, sf):
    """The documents streamed in many micro-batches, the closed days compacted, the last day left as it came."""
    path, _ = drained(spark, sf)
    last = max(e.last_day for e in batches.ledger(spark, path))
    batches.compact(spark, path, before=last)
    return zoneless(batches.read_accepted(spark, path))


@case(over("documents", _REJECTS))
def ingest_stream_compacted_rejects(spark, sf):
    """What the same stream rejected, from the same parse and the same commits; all days compacted."""
    path, _ = drained(spark, sf)
    batches.compact(spark, path)
    return zoneless(batches.read_rejects(spark, path).drop("payload"))


@case(
    over(
        "arrived",
        f"""SELECT 'success' AS status, (SELECT count(*) FROM arrived) AS total_inserted, count(*) AS total_rejected
            FROM ({_REJECTS})""",
    )
)
def ingest_stream_totals(spark, sf):
    """The totals of both runs of the stream, from the ledger."""
    _, summary = drained(spark, sf)
    row = (summary["status"], summary["total_inserted"], summary["total_rejected"])
    return spark.createDataFrame([row], "status string, total_inserted bigint, total_rejected bigint")


@case(
    over(
        "documents",
        f"SELECT {names(TYPED_COLUMNS)} FROM typed",
        more=TYPED,
    )
)
def ingest_typed_values(spark, sf):
    """Documents with numbers, fractions, booleans, signs, lists and times of any width, from one parse."""
    docs = sample.typed_envelopes_from_events(table(spark, sf, "events"))
    rows = ingest.outcomes(docs).withColumnRenamed("ingestion_timestamp", "fetched_at")
    rows = rows.withColumn("time_remaining", F.col("time_remaining").cast("string"))
    return rows.select(*TYPED_COLUMNS)


@case(over("raw", f"""SELECT line_code, {sql_case("line_code", network.LINE_NAMES, "none")} AS line_name, count(*) AS n
                      FROM raw WHERE line_code <> 'XXX' GROUP BY line_code"""))
def line_reference(spark, sf):
    """Arrivals of each line of the reference table."""
    counts = raw(spark, sf).groupBy("line_code").agg(F.count(F.lit(1)).alias("n"))
    return network.line_reference(spark).join(counts, "line_code")


@case(over("raw", f"SELECT {RAW_LIST} FROM raw"))
def raw_append_and_scan(spark, sf):
    path = scratch(spark, "raw")
    raw_table.append_raw(zoned(raw(spark, sf)).select(*RAW_COLUMNS), path)
    return zoneless(raw_table.read_raw(spark, path))


@case(over("raw", "SELECT event_id, line_code, line_name FROM raw"))
def line_names(spark, sf):
    return ingest.with_line_name(raw(spark, sf).select("event_id", "line_code"))


# ---- models -------------------------------------------------------------------------------------
@case(
    over("raw", f"""SELECT {RAW_LIST.replace("arrival_time", "arrival_time AS scheduled_arrival_time")
                    .replace("time_remaining", "time_remaining AS time_remaining_seconds")}
                    FROM raw WHERE arrival_id IS NOT NULL""")
)
def stage_source(spark, sf):
    return models.stage_source(raw(spark, sf))


@case(over("stg", f"SELECT {STAGING_LIST} FROM stg"))
def stg_arrivals(spark, sf):
    return staging(spark, sf).drop("event_id")


@case(
    over("stg", """SELECT line_code, direction, count(*) AS arrivals, max(row_num) AS max_row_num
                   FROM stg GROUP BY ALL""")
)
def staging_view(spark, sf):
    marts.register_views(raw(spark, sf), extra=["event_id"], tie_break=TIE_BREAK)
    return spark.sql(
        """SELECT line_code, direction, count(*) AS arrivals, max(row_num) AS max_row_num
           FROM stg_arrivals GROUP BY line_code, direction"""
    )


DIM_LINES_SQL = over(
    "stg",
    f"""SELECT DISTINCT line_code, line_name,
               {sql_case("line_code", network.LINE_COLORS, network.DEFAULT_LINE_COLOR)} AS line_color,
               line_code IN {sql_in(network.URBAN_LINES)} AS is_urban
        FROM stg""",
)
DIM_STATIONS_SQL = over(
    "stg",
    """SELECT DISTINCT station_code, line_code, line_count > 1 AS is_interchange
       FROM (SELECT station_code, line_code,
                    count(DISTINCT line_code) OVER (PARTITION BY station_code) AS line_count FROM stg)""",
)
FACT_SQL = f"SELECT {HOURLY_LIST}, wait_category FROM fact"


@case(DIM_LINES_SQL)
def dim_lines(spark, sf):
    return models.dim_lines(staging(spark, sf))


@case(
    over("stg", """SELECT DISTINCT station_code, line_code,
                          count(DISTINCT line_code) OVER (PARTITION BY station_code) AS line_count
                   FROM stg""")
)
def lines_per_station(spark, sf):
    return models.lines_per_station(staging(spark, sf))


@case(DIM_STATIONS_SQL)
def dim_stations(spark, sf):
    return models.dim_stations(staging(spark, sf))


@case(over("fact", FACT_SQL))
def fact_delays(spark, sf):
    return rounded(models.fact_delays(staging(spark, sf)))


@case(over("fact", FACT_SQL, signed=True))
def fact_delays_signed(spark, sf):
    return rounded(models.fact_delays(staging(spark, sf, signed=True)))


@case(
    over(
        "fact",
        """SELECT 'fact_delays' AS mart, line_code, station_code, sum(sample_count)::BIGINT AS n
           FROM fact GROUP BY ALL
           UNION ALL
           SELECT 'dim_lines', line_code, NULL, 1 FROM (SELECT DISTINCT line_code, line_name FROM stg)
           UNION ALL
           SELECT 'dim_stations', line_code, station_code,
                  CASE WHEN count(*) OVER (PARTITION BY station_code) > 1 THEN 1 ELSE 0 END
           FROM (SELECT DISTINCT station_code, line_code FROM stg)""",
    )
)
def published_marts(spark, sf):
    """Rebuild and write all marts, then summarise what was written."""
    built = marts.build_marts(
        spark, raw(spark, sf), scratch(spark, "marts"), extra=["event_id"], tie_break=TIE_BREAK
    )
    one = F.lit(1).cast("bigint")
    fact = (
        built["fact_delays"].groupBy("line_code", "station_code").agg(F.sum("sample_count").alias("n"))
    )
    lines = built["dim_lines"].select("line_code", F.lit(None).cast("string").alias("station_code"), one.alias("n"))
    stations = built["dim_stations"].select(
        "line_code", "station_code", F.when(F.col("is_interchange"), one).otherwise(one * 0).alias("n")
    )
    parts = {"fact_delays": fact, "dim_lines": lines, "dim_stations": stations}
    tagged = [df.select(F.lit(mart).alias("mart"), "line_code", "station_code", "n") for mart, df in parts.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


# ---- extracts and frame choices -----------------------------------------------------------------
RECENT = f"ingestion_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 168 HOUR"


@case(over("frame", f"SELECT {FRAME_LIST} FROM frame WHERE {RECENT}"))
def recent_arrivals(spark, sf):
    return rounded(extracts.recent_arrivals(raw(spark, sf), hours_back=168, as_of=AS_OF))


@case(over("frame", f"SELECT {FRAME_LIST} FROM frame"))
def all_arrivals(spark, sf):
    return rounded(frame(spark, sf))


@case(over("frame", f"SELECT {FRAME_LIST} FROM frame ORDER BY ingestion_timestamp DESC LIMIT 777"))
def newest_arrivals(spark, sf):
    """A top-k report: the newest 777 rows of all."""
    return rounded(extracts.recent_arrivals(raw(spark, sf), hours_back=0, limit=777))


@case(
    over(
        "raw",
        f"SELECT {HOURLY_LIST}, {MINUTES_LIST} FROM recent",
        more=f"recent AS ({hourly_since('2024-01-23')})",
    )
)
def hourly_stats(spark, sf):
    return rounded(extracts.hourly_stats(raw(spark, sf), days_back=7, as_of=AS_OF_DATE))


@case(over("hourly", f"SELECT {HOURLY_LIST}, {MINUTES_LIST} FROM hourly"))
def hourly_stats_all_days(spark, sf):
    return rounded(hourly(spark, sf))


@case(
    over("frame", f"""SELECT {FRAME_LIST} FROM frame
                      WHERE date = DATE '{CHOSEN["date"]}' AND line_name IN {sql_in(CHOSEN["lines"])}
                        AND hour BETWEEN {CHOSEN["hours"][0]} AND {CHOSEN["hours"][1]}""")
)
def filter_frame(spark, sf):
    return rounded(frames.filter_frame(frame(spark, sf), **CHOSEN))


@case(
    over("frame", """SELECT DISTINCT 'date' AS domain, CAST(date AS VARCHAR) AS value FROM frame
                     UNION ALL SELECT DISTINCT 'line', line_name FROM frame
                     UNION ALL SELECT DISTINCT 'hour', lpad(CAST(hour AS VARCHAR), 2, '0') FROM frame""")
)
def filter_domains(spark, sf):
    return frames.filter_domains(frame(spark, sf))


@case(over("frame", "SELECT max(date) AS default_date, min(hour) AS min_hour, max(hour) AS max_hour FROM frame"))
def filter_defaults(spark, sf):
    return frames.filter_defaults(frame(spark, sf))


@case(over("frame", "SELECT DISTINCT station_code FROM frame"))
def station_list(spark, sf):
    return frames.station_list(frame(spark, sf))


@case(over("frame", f"SELECT {FRAME_LIST} FROM frame WHERE station_code = '{STATION}'"))
def station_frame(spark, sf):
    return rounded(frames.station_frame(frame(spark, sf), STATION))


@case(
    over(
        "raw",
        f"""SELECT event_id, extract(hour FROM arrival_time) AS hour,
                   CAST(ingestion_timestamp AS DATE) AS date,
                   {sql_case("line_code", network.LINE_COLORS, network.DEFAULT_LINE_COLOR)} AS line_color,
                   {sql_case("line_name", network.CHART_COLORS, network.DEFAULT_CHART_COLOR)} AS chart_color,
                   line_code IN {sql_in(network.URBAN_LINES)} AS is_urban,
                   round_even(time_remaining / 7 * 100, 0) / 100 AS two_digits,
                   printf('%.1f min', time_remaining / 60) AS minutes_text,
                   format('{{:,}}', time_remaining * 1000) AS thousands
            FROM raw""",
    )
)
def scalar_functions(spark, sf):
    seconds = F.col("time_remaining")
    return raw(spark, sf).select(
        "event_id",
        C.clock_hour(F.col("arrival_time")).alias("hour"),
        F.to_date("ingestion_timestamp").alias("date"),
        C.line_color(F.col("line_code")).alias("line_color"),
        C.chart_color(F.col("line_name")).alias("chart_color"),
        C.is_urban(F.col("line_code")).alias("is_urban"),
        C.round_half_even(seconds / 7, 2).alias("two_digits"),
        C.one_decimal_text(seconds / 60, " min").alias("minutes_text"),
        C.thousands_text(seconds * 1000).alias("thousands"),
    )


# ---- frame statistics ---------------------------------------------------------------------------
MIN = "time_remaining_minutes"
OVERVIEW_SQL = f"""SELECT count(*) AS total_arrivals, avg({MIN}) AS avg_wait, stddev_samp({MIN}) AS std_wait,
                          var_samp({MIN}) AS var_wait, count(DISTINCT line_name) AS active_lines FROM frame"""


@case(
    over("frame", f"""SELECT total_arrivals, active_lines, {r6("avg_wait")}, {r6("std_wait")}, {r6("var_wait")}
                      FROM ({OVERVIEW_SQL})""")
)
def overview(spark, sf):
    return rounded(stats.overview(frame(spark, sf)))


@case(
    over("frame", f"""SELECT format('{{:,}}', total_arrivals) AS total_arrivals, active_lines,
                             printf('%.1f min', avg_wait) AS avg_wait, printf('%.1f min', std_wait) AS std_wait
                      FROM ({OVERVIEW_SQL})""")
)
def overview_text(spark, sf):
    return stats.overview_text(stats.overview(frame(spark, sf)))


@case(
    over("frame", f"""SELECT count(*) AS outlier_count
                      FROM frame, (SELECT avg({MIN}) AS m, stddev_samp({MIN}) AS s FROM frame)
                      WHERE {MIN} > m + 2 * s OR {MIN} < m - 2 * s""")
)
def outlier_count(spark, sf):
    return stats.outlier_count(frame(spark, sf))


@case(over("frame", f"SELECT hour, line_name, {r6(f'avg({MIN})', 'avg_wait')} FROM frame GROUP BY ALL"))
def hourly_line_avg(spark, sf):
    return rounded(stats.hourly_line_avg(frame(spark, sf)))


_HOURS = ", ".join(f'round(avg({MIN}) FILTER (WHERE hour = {h}), 6) AS "{h}"' for h in range(24))


@case(over("frame", f"SELECT line_name, {_HOURS} FROM frame GROUP BY line_name"))
def wait_heatmap(spark, sf):
    return rounded(stats.wait_heatmap(frame(spark, sf)))


def _half_even(expr: str, alias: str) -> str:
    return f"round_even({expr} * 100, 0) / 100 AS {alias}"


def _summary_sql(source: str, key: str, value: str) -> str:
    return f"""SELECT {key}, {_half_even("any_value(m)", "avg_wait")}, {_half_even("any_value(s)", "std_wait")},
                      {_half_even(f"var_samp({value})", "var_wait")},
                      {_half_even(f"min({value})", "min_wait")}, {_half_even(f"max({value})", "max_wait")},
                      count({value}) AS wait_count,
                      count(*) FILTER (WHERE {value} > m + 2 * s OR {value} < m - 2 * s) AS outliers
               FROM {source} JOIN (SELECT {key}, avg({value}) AS m, stddev_samp({value}) AS s
                                   FROM {source} GROUP BY {key}) USING ({key})
               GROUP BY {key}"""


@case(over("frame", _summary_sql("frame", "line_name", MIN)))
def line_summary(spark, sf):
    return stats.line_summary(frame(spark, sf))


@case(over("frame", f"""SELECT *, row_number() OVER (ORDER BY avg_wait, line_name) - 1 AS position
                        FROM ({_summary_sql("frame", "line_name", MIN)})"""))
def line_ranking(spark, sf):
    return in_order(stats.line_ranking(frame(spark, sf)))


@case(over("frame", "SELECT station_code, row_number() OVER (ORDER BY station_code) - 1 AS position "
                    "FROM (SELECT DISTINCT station_code FROM frame WHERE station_code IS NOT NULL)", gaps=True))
def station_list_order(spark, sf):
    return in_order(frames.station_list(frame(spark, sf, gaps=True)))


@case(over("frame", """SELECT *, row_number() OVER (ORDER BY domain, value) - 1 AS position
                       FROM (SELECT DISTINCT 'date' AS domain, CAST(date AS VARCHAR) AS value FROM frame
                             UNION ALL SELECT DISTINCT 'line', line_name FROM frame
                             UNION ALL SELECT DISTINCT 'hour', lpad(CAST(hour AS VARCHAR), 2, '0') FROM frame)"""))
def filter_domains_order(spark, sf):
    return in_order(frames.filter_domains(frame(spark, sf)))


@case(over("fact", """SELECT line_code, row_number() OVER (ORDER BY sum(avg_wait_seconds * sample_count)
                             / sum(sample_count) DESC, line_code) - 1 AS position FROM fact GROUP BY line_code"""))
def tile_wait_by_line_order(spark, sf):
    return in_order(tiles.tile_wait_by_line(models.fact_delays(staging(spark, sf)))).select("line_code", "position")


@case(over("frame", f"""SELECT 'N/A' AS avg_wait, 'N/A' AS std_wait, format('{{:,}}', count(*)) AS total_arrivals,
                               count(DISTINCT line_name) AS active_lines FROM frame WHERE {MIN} IS NULL""", gaps=True))
def overview_text_no_waits(spark, sf):
    """The display text of rows without any wait."""
    rows = frame(spark, sf, gaps=True).filter(F.col(MIN).isNull())
    return stats.overview_text(stats.overview(rows))


@case("""SELECT CASE WHEN max(ts) >= TIMESTAMP '2024-06-01 00:00:00' - INTERVAL 168 HOUR THEN NULL
                     ELSE 'no arrivals in the period' END AS note FROM events""")
def report_note(spark, sf):
    """The report of a period after the last arrival says why it is empty."""
    page = report.build_report(raw(spark, sf), as_of=dt.datetime(2024, 6, 1))
    page.close()
    return spark.createDataFrame([(page.note,)], "note string")


@case(
    over("frame", f"""SELECT CASE WHEN count(*) = 0 THEN 'no arrivals in the period'
                                  WHEN count(*) FILTER (WHERE line_name = 'No Line') = 0
                                  THEN 'no arrivals match the filters' END AS note
                      FROM frame WHERE ingestion_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 168 HOUR""")
)
def report_note_filters(spark, sf):
    """The report of a period with arrivals, of which none is of the chosen line, says so."""
    page = report.build_report(raw(spark, sf), lines=["No Line"], as_of=dt.datetime.fromisoformat(AS_OF))
    page.close()
    return spark.createDataFrame([(page.note,)], "note string")


@case(
    over("frame", f"""SELECT line_name, hour AS peak_hour, {r6("w", "peak_wait")}
                      FROM (SELECT line_name, hour, avg({MIN}) AS w FROM frame GROUP BY ALL)
                      QUALIFY row_number() OVER (PARTITION BY line_name ORDER BY w DESC, hour) = 1""")
)
def peak_hours(spark, sf):
    return rounded(stats.peak_hours(frame(spark, sf)))


@case(over("frame", f"""SELECT hour, {r6(f'avg({MIN})', 'avg_wait')} FROM frame
                        WHERE station_code = '{STATION}' GROUP BY hour"""))
def station_hourly(spark, sf):
    return rounded(stats.station_hourly(frame(spark, sf), STATION))


@case(over("frame", f"""SELECT direction, {r6("w", "avg_wait")}, {r6("w / sum(w) OVER ()", "share")}
                        FROM (SELECT direction, avg({MIN}) AS w FROM frame
                              WHERE station_code = '{STATION}' GROUP BY direction)
                        QUALIFY count(*) OVER () > 1"""))
def station_direction(spark, sf):
    return rounded(stats.station_direction(frame(spark, sf), STATION))


@case(over("frame", f"SELECT station_code, line_name, {r6(f'avg({MIN})', 'avg_wait')} FROM frame GROUP BY ALL"))
def station_line_avg(spark, sf):
    return rounded(stats.station_line_avg(frame(spark, sf)))


@case(over("frame", f"""SELECT station_code, line_name, {r6("w", "avg_wait")}
                        FROM (SELECT station_code, line_name, avg({MIN}) AS w FROM frame GROUP BY ALL)
                        ORDER BY w DESC, station_code, line_name LIMIT 10"""))
def top_stations(spark, sf):
    return rounded(stats.top_stations(frame(spark, sf)))


# ---- distributions ------------------------------------------------------------------------------
_PS = list(distribution.PERCENTILES)


def _percentile_sql(source: str, value: str, key: str | None = None) -> str:
    keys, group = (f"{key}, ", f"GROUP BY {key}") if key else ("", "")
    found = f"quantile_cont({value}, {[p / 100 for p in _PS]})"
    return f"""SELECT {keys}percentile, {r6("w", "wait_minutes")}, printf('%.1f', w) AS wait_text
               FROM (SELECT {keys}unnest({sql_list(f"{p}th" for p in _PS)}) AS percentile,
                            unnest({found}) AS w FROM {source} {group})"""


@case(over("frame", _percentile_sql("frame", MIN)))
def percentiles(spark, sf):
    return rounded(distribution.percentiles(frame(spark, sf)))


@case(over("frame", _percentile_sql("frame", MIN, "line_name")))
def percentiles_by_line(spark, sf):
    return rounded(distribution.percentiles(frame(spark, sf), by=["line_name"]))


def _cdf_steps_sql(source: str, value: str) -> str:
    return f"""SELECT {value}, n, CAST(sum(n) OVER w AS BIGINT) AS cumulative,
                      round(sum(n) OVER w / (SELECT count(*) FROM {source}), 9) AS probability
               FROM (SELECT {value}, count(*) AS n FROM {source}
                     WHERE {value} IS NOT NULL GROUP BY {value})
               WINDOW w AS (ORDER BY {value})"""


@case(over("frame", _cdf_steps_sql("frame", MIN)))
def cdf_steps(spark, sf):
    return rounded(distribution.cdf_steps(frame(spark, sf)), 9)


@case(over("frame", f"""SELECT {MIN}, round(row_number() OVER (ORDER BY {MIN}) / count(*) OVER (), 9)
                               AS probability FROM frame"""))
def cdf(spark, sf):
    return rounded(distribution.cdf(frame(spark, sf)), 9)


def _histogram_sql(source: str, value: str) -> str:
    return f"""SELECT bin, round(lo + bin * width, 6) AS bin_start, round(lo + (bin + 1) * width, 6) AS bin_end,
                      count(*) AS n
               FROM (SELECT lo, width, CAST(least(floor(({value} - lo) / width), 49) AS BIGINT) AS bin
                     FROM {source}, (SELECT min({value}) AS lo, (max({value}) - min({value})) / 50 AS width
                                     FROM {source}))
               GROUP BY bin, lo, width"""


def _nice_histogram_sql(source: str, value: str) -> str:
    """Steps of 1, 2 and 5 tried from the narrowest on; whole powers of ten."""
    scaled = "(CASE WHEN power < 0 THEN {0} * pow(10, -power) ELSE {0} / pow(10, power) END)"
    edge = "(CASE WHEN power < 0 THEN {0} * digit / pow(10, -power) ELSE {0} * digit * pow(10, power) END)"

    def number(x: str) -> str:
        return f"CAST(floor({scaled.format(x)} / digit) AS BIGINT)"

    return f"""ends AS (SELECT CAST(min({value}) AS DOUBLE) AS lo, CAST(max({value}) AS DOUBLE) AS hi FROM {source}),
      steps AS (
        SELECT lo, hi, digit, CAST(floor(log10((hi - lo) / 50)) AS INTEGER) + more AS power
        FROM ends, (VALUES (5.0::DOUBLE, -1), (1.0, 0), (2.0, 0), (5.0, 0), (1.0, 1), (2.0, 1)) AS t(digit, more)
        WHERE hi > lo
      ),
      step AS (
        SELECT digit, power, {number("lo")} AS first FROM steps WHERE {number("hi")} - {number("lo")} < 50
        ORDER BY digit * pow(10, power) LIMIT 1
      ),
      binned AS (SELECT {number(value)} AS number, first, digit, power FROM {source}, step WHERE {value} IS NOT NULL)
    SELECT number - first AS bin, round({edge.format("number")}, 6) AS bin_start,
           round({edge.format("(number + 1)")}, 6) AS bin_end, count(*) AS n
    FROM binned GROUP BY ALL"""


@case("WITH " + _nice_histogram_sql("orders", "o_totalprice"))
def order_price_histogram_nice(spark, sf):
    """Bins of a step of 1, 2 or 5 times a power of ten, at most 50."""
    return rounded(distribution.histogram(table(spark, sf, "orders"), value="o_totalprice", nice=True))


@case(over("frame", "SELECT * FROM nice", more=f"nice AS (WITH {_nice_histogram_sql('frame', MIN)})"))
def histogram_nice(spark, sf):
    return rounded(distribution.histogram(frame(spark, sf), nice=True))


@case(over("frame", _histogram_sql("frame", MIN)))
def histogram(spark, sf):
    return rounded(distribution.histogram(frame(spark, sf)))


def _box_sql(source: str, value: str, key: str | None = None) -> str:
    keys, group = (f"{key}, ", f"GROUP BY {key}") if key else ("", "")
    on = f"USING ({key})" if key else "ON TRUE"
    box = f"""SELECT {keys}quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
                     quantile_cont({value}, 0.75) AS q3 FROM {source} {group}"""
    inside = f"{value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return f"""SELECT {keys}CAST(min({value}) AS DOUBLE) AS least, CAST(max({value}) AS DOUBLE) AS greatest,
                      {r6("any_value(q1)", "q1")}, {r6("any_value(median)", "median")},
                      {r6("any_value(q3)", "q3")}, count({value}) AS n,
                      CAST(min({value}) FILTER (WHERE {inside}) AS DOUBLE) AS whisker_low,
                      CAST(max({value}) FILTER (WHERE {inside}) AS DOUBLE) AS whisker_high
               FROM {source} JOIN ({box}) {on} {group}"""


def _chart_box_sql(source: str, value: str, key: str) -> str:
    """Quartiles by the place q * n - 1/2 in the sorted list of a group's values."""

    def quartile(q: float) -> str:
        place = f"greatest(least({q} * n - 0.5, n - 1.0), 0.0)"
        low, high = f"v[CAST(floor({place}) AS BIGINT) + 1]", f"v[CAST(ceil({place}) AS BIGINT) + 1]"
        return f"{low} + ({high} - {low}) * ({place} - floor({place}))"

    def reach(side: str) -> str:
        return f"list_filter(v, lambda x: x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1))[{side}]"

    return f"""SELECT {key}, CAST(v[1] AS DOUBLE) AS least, CAST(v[-1] AS DOUBLE) AS greatest, round(q1, 6) AS q1,
                      round(median, 6) AS median, round(q3, 6) AS q3, n,
                      round(least({reach("1")}, q1), 6) AS whisker_low, round(greatest({reach("-1")}, q3), 6) AS whisker_high
               FROM (SELECT *, {quartile(0.25)} AS q1, {quartile(0.5)} AS median, {quartile(0.75)} AS q3
                     FROM (SELECT {key}, list_sort(list(CAST({value} AS DOUBLE))) AS v, count(*) AS n
                           FROM {source} WHERE {value} IS NOT NULL AND {key} IS NOT NULL GROUP BY {key}))"""


@case(over("frame", _chart_box_sql("frame", MIN, "line_name")))
def box_stats_chart(spark, sf):
    """The boxes of the lines as charts draw them."""
    return rounded(distribution.box_stats(frame(spark, sf), by=["line_name"], chart=True))


@case(_chart_box_sql("orders", "o_totalprice", "o_custkey"))
def order_price_box_chart(spark, sf):
    """The same for many small groups of odd and even sizes."""
    rows = distribution.box_stats(table(spark, sf, "orders"), by=["o_custkey"], value="o_totalprice", chart=True)
    return rounded(rows)


@case(over("frame", _box_sql("frame", MIN)))
def box_stats(spark, sf):
    return rounded(distribution.box_stats(frame(spark, sf)))


@case(over("frame", _box_sql("frame", MIN, "line_name")))
def box_stats_by_line(spark, sf):
    return rounded(distribution.box_stats(frame(spark, sf), by=["line_name"]))


# ---- anomalies, on waits of either sign ---------------------------------------------------------
@case(over("flagged", f"SELECT {HOURLY_LIST}, is_anomaly, anomaly_type FROM flagged", signed=True))
def flag_anomalies(spark, sf):
    flagged = anomaly.flag_anomalies(hourly(spark, sf, signed=True))
    return rounded(flagged.drop(*[c for c in flagged.columns if c.endswith("_minutes")]))


@case(
    over("flagged", """SELECT count(*) FILTER (WHERE is_anomaly) AS total_anomalies,
                              count(*) FILTER (WHERE anomaly_type = 'Unusually Long') AS unusually_long,
                              count(*) FILTER (WHERE anomaly_type = 'Unusually Short') AS unusually_short FROM flagged""",
         signed=True)
)
def anomaly_summary(spark, sf):
    return anomaly.anomaly_summary(hourly(spark, sf, signed=True))


@case(
    over("flagged", f"""SELECT hour, {r6("avg_wait_seconds / 60", "avg_wait_minutes")}, anomaly_type, line_name
                        FROM flagged WHERE is_anomaly""", signed=True)
)
def anomaly_points(spark, sf):
    return rounded(anomaly.anomaly_points(hourly(spark, sf, signed=True)))


@case(
    over("flagged", """SELECT ingestion_date, hour, line_name, station_code,
                              round(avg_wait_seconds / 60, 6) AS "Avg Wait (min)",
                              round(upper_bound_seconds / 60, 6) AS "Upper Bound (min)",
                              round(lower_bound_seconds / 60, 6) AS "Lower Bound (min)", anomaly_type
                       FROM flagged WHERE is_anomaly""", signed=True)
)
def anomaly_details(spark, sf):
    return rounded(anomaly.anomaly_details(hourly(spark, sf, signed=True)))


# ---- data quality -------------------------------------------------------------------------------
@case(over("fact", f"SELECT {names(waits.HOURLY_KEYS)}, sample_count FROM fact WHERE std_wait_seconds IS NULL"))
def check_not_null(spark, sf):
    fact = models.fact_delays(staging(spark, sf))
    return quality.check_not_null(fact, "std_wait_seconds").select(*waits.HOURLY_KEYS, "sample_count")


@case(over("raw", "SELECT arrival_id, count(*) AS n FROM raw GROUP BY arrival_id HAVING count(*) > 1"))
def check_unique(spark, sf):
    return quality.check_unique(raw(spark, sf), "arrival_id")


@case(over("raw", "SELECT event_id, line_code FROM raw WHERE line_code NOT IN " + sql_in(network.LINE_NAMES)))
def check_accepted(spark, sf):
    rows = raw(spark, sf).select("event_id", "line_code")
    return quality.check_accepted(rows, "line_code", network.LINE_NAMES)


def _checks_sql() -> str:
    sources = {
        "stg_arrivals": "(SELECT stg.*, wait_flag AS is_delayed FROM stg JOIN "
        "(SELECT ingestion_timestamp AS t, arrival_id AS a, any_value(is_delayed) AS wait_flag FROM raw "
        "GROUP BY ALL) ON t = ingestion_timestamp AND a = arrival_id)",
        "dim_lines": "(SELECT DISTINCT line_code, line_name FROM stg)",
        "dim_stations": "(SELECT DISTINCT station_code, line_code FROM stg)",
        "fact_delays": "fact",
    }
    rows = []
    for c in quality.DECLARED:
        src = sources[c.model]
        if c.test == "unique":
            src = f"(SELECT {c.column} FROM {src} WHERE {c.column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
            where = "TRUE"
        elif c.test == "not_null":
            where = f"{c.column} IS NULL"
        else:
            where = f"{c.column} NOT IN {sql_in(c.values)}"
        rows.append(
            f"SELECT '{c.model}' AS model, '{c.column}' AS \"column\", '{c.test}' AS test, "
            f"count(*) AS failures FROM {src} WHERE {where}"
        )
    return "\nUNION ALL\n".join(rows)


@case(over("fact", _checks_sql(), gaps=True), name="run_checks_gaps")
def _run_checks_gaps(spark, sf):
    """The same where values are missing: not_null, unique and accepted_values all find failures."""
    return run_checks(spark, sf, gaps=True)


# Whole numbers that may be missing are compared as text: a frame in pandas would make them doubles.
_NULLABLE = ["hour", "min_wait_seconds", "max_wait_seconds"]
_AS_TEXT = "* REPLACE (" + names(f"CAST({c} AS VARCHAR) AS {c}" for c in _NULLABLE) + ")"


def as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in _NULLABLE})


@case(over("fact", f"SELECT {_AS_TEXT} FROM ({FACT_SQL})", gaps=True))
def fact_delays_gaps(spark, sf):
    return as_text(rounded(models.fact_delays(staging(spark, sf, gaps=True))))


@case(over("flagged", f"SELECT {_AS_TEXT} FROM (SELECT {HOURLY_LIST}, is_anomaly, anomaly_type FROM flagged)", signed=True, gaps=True))
def flag_anomalies_gaps(spark, sf):
    flagged = anomaly.flag_anomalies(hourly(spark, sf, signed=True, gaps=True))
    return as_text(rounded(flagged.drop(*[c for c in flagged.columns if c.endswith("_minutes")])))


@case(over("frame", _cdf_steps_sql("frame", MIN), gaps=True))
def cdf_steps_gaps(spark, sf):
    return rounded(distribution.cdf_steps(frame(spark, sf, gaps=True)), 9)


@case(over("frame", f"""SELECT format('{{:,}}', total_arrivals) AS total_arrivals, active_lines,
                               printf('%.1f min', avg_wait) AS avg_wait, printf('%.1f min', std_wait) AS std_wait
                        FROM ({OVERVIEW_SQL})""", gaps=True))
def overview_text_gaps(spark, sf):
    return stats.overview_text(stats.overview(frame(spark, sf, gaps=True)))


@case(over("fact", _checks_sql()))
def run_checks(spark, sf, **kind):
    """All declared checks, on the staging view and the written marts."""
    rows = raw(spark, sf, extended=True, **kind)
    stg = durable(models.stg_arrivals(rows, extra=["event_id", "is_delayed"], tie_break=TIE_BREAK))
    built = marts.publish_marts(spark, stg, scratch(spark, "marts"))
    return quality.run_checks({"stg_arrivals": stg, **built})


# ---- report tiles -------------------------------------------------------------------------------
@case(over("fact", """SELECT line_code, round(sum(avg_wait_seconds * sample_count) / sum(sample_count), 6)
                             AS avg_wait_seconds FROM fact GROUP BY line_code"""))
def tile_wait_by_line(spark, sf):
    return rounded(tiles.tile_wait_by_line(models.fact_delays(staging(spark, sf))))


@case(over("raw", """SELECT ingestion_date, extract(hour FROM arrival_time) AS hour, line_code,
                            count(*) FILTER (WHERE is_delayed) AS delayed_count FROM raw GROUP BY ALL"""))
def tile_delay_trend(spark, sf):
    return tiles.tile_delay_trend(raw(spark, sf, extended=True))


@case(over("fact", """SELECT hour, station_code, CAST(sum(sample_count) AS BIGINT) AS total_arrivals
                      FROM fact GROUP BY ALL"""))
def tile_peak_activity(spark, sf):
    return tiles.tile_peak_activity(models.fact_delays(staging(spark, sf)))


@case(over("raw", """SELECT line_code, count(*) FILTER (WHERE is_delayed) AS delayed_count,
                            round(count(*) FILTER (WHERE is_delayed) / sum(count(*) FILTER (WHERE is_delayed)) OVER (), 6) AS share
                     FROM raw GROUP BY line_code"""))
def tile_delay_share(spark, sf):
    return rounded(tiles.tile_delay_share(raw(spark, sf, extended=True)))


@case(over("fact", f"""{FACT_SQL} WHERE ingestion_date >= DATE '{AS_OF_DATE}' - INTERVAL 7 DAY
                       AND line_code IN ('ISL', 'TCL', 'XXX')
                       AND station_code IN ('S001', 'S021', 'S044', 'S060')"""))
def tile_filter(spark, sf):
    return rounded(
        tiles.tile_filter(
            models.fact_delays(staging(spark, sf)),
            days=7,
            lines=["ISL", "TCL", "XXX"],
            stations=["S001", "S021", "S044", "S060"],
            as_of=AS_OF_DATE,
        )
    )


# ---- the same operators on other tables ---------------------------------------------------------
@case("""SELECT l_returnflag, l_linestatus, count(*) AS sample_count, round(avg(l_quantity), 6) AS avg_quantity,
                round(stddev_samp(l_quantity), 6) AS std_quantity, min(l_quantity) AS min_quantity,
                max(l_quantity) AS max_quantity FROM lineitem GROUP BY ALL""")
def lineitem_quantity_metrics(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rounded(
        waits.wait_metrics(rows, ["l_returnflag", "l_linestatus"], "l_quantity", naming="{}_quantity")
    )


@case(_percentile_sql("lineitem", "l_extendedprice", "l_returnflag"))
def lineitem_price_percentiles(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rounded(distribution.percentiles(rows, value="l_extendedprice", by=["l_returnflag"]))


@case(_cdf_steps_sql("lineitem", "l_extendedprice"))
def lineitem_price_cdf(spark, sf):
    return rounded(distribution.cdf_steps(table(spark, sf, "lineitem"), value="l_extendedprice"), 9)


@case(_box_sql("lineitem", "l_extendedprice", "l_linestatus"))
def lineitem_price_box(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rounded(distribution.box_stats(rows, by=["l_linestatus"], value="l_extendedprice"))


@case(_histogram_sql("orders", "o_totalprice"))
def order_price_histogram(spark, sf):
    return rounded(distribution.histogram(table(spark, sf, "orders"), value="o_totalprice"))


@case(_summary_sql("orders", "o_orderpriority", "o_totalprice"))
def order_price_summary(spark, sf):
    return stats.line_summary(table(spark, sf, "orders"), value="o_totalprice", line="o_orderpriority")
