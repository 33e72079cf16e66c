"""The rail network as reference data: lines, stations, colours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---- fixed values -----------------------------------------------------------------------------
LINE_NAMES = {
    "TCL": "Tung Chung Line",
    "EAL": "East Rail Line",
    "TML": "Tuen Ma Line",
    "TKL": "Tseung Kwan O Line",
    "KTL": "Kwun Tong Line",
    "TWL": "Tsuen Wan Line",
    "ISL": "Island Line",
    "SIL": "South Island Line",
    "DRL": "Disneyland Resort Line",
    "AEL": "Airport Express",
}

# TSH and AUS appear twice on TML: 107 entries, 105 distinct pairs.
LINE_STATIONS = {
    "TWL": "CEN ADM TST TSW JOR YMT MOK PRE LAK CSW HOM SKM KLB SSP PRC TWH TWK TSF".split(),
    "ISL": "KET HFC CAB TIH EXC QUB SYH WAC CEN ADM".split(),
    "KTL": "WHA NAC QUB YAT KOW LAT CHH MOK KOT SKM HOM YMT NGK KOB".split(),
    "TKL": "NOP QUB YAT TIK TKO HAH POA LHP".split(),
    "TCL": "HOK KOW OLY NAC LAC TSY SUN TUC".split(),
    "EAL": "ADM EXC HUH MKK KOT TAW SHT FOT UNI TAP RAC LOW LMC".split(),
    "TML": (
        "TUK TIW KSU AUS MOS HEO TSH SIH CIO TWW AWE KSR TIS TSH HHS HUH ETS AUS OLY NAC MEF HOK EXC"
    ).split(),
    "AEL": "HOK KOW TSY AIR AWE".split(),
    "SIL": "ADM OCP QUB SOH LET WCH".split(),
    "DRL": "SUN DIS".split(),
}

UNKNOWN_LINE_NAME = "Unknown"

# Colours of the line dimension, by code.
LINE_COLORS = {
    "TCL": "#F7943D",
    "EAL": "#5EB6E4",
    "TML": "#9B27B0",
    "TKL": "#7B68EE",
    "KTL": "#00A86D",
    "TWL": "#E2231A",
    "ISL": "#0075C2",
    "SIL": "#B5D99A",
    "DRL": "#FF69B4",
    "AEL": "#00A0E0",
}
DEFAULT_LINE_COLOR = "#808080"

# Colours of the report charts, by name; they differ from the dimension on purpose.
CHART_COLORS = {
    "Tsuen Wan Line": "#ED1D24",
    "Kwun Tong Line": "#00A040",
    "Island Line": "#0075C2",
    "Tseung Kwan O Line": "#7D4990",
    "Tung Chung Line": "#F7943E",
    "Airport Express": "#00888C",
    "Disneyland Resort Line": "#D4849A",
    "East Rail Line": "#5FC0D3",
    "Tuen Ma Line": "#9A3B26",
    "South Island Line": "#B5D334",
}
DEFAULT_CHART_COLOR = "#1f77b4"

URBAN_LINES = ["ISL", "KTL", "TWL", "TKL"]

DIRECTIONS = ["UP", "DOWN"]
# ---- end of fixed values ----------------------------------------------------------------------


def line_reference(spark: SparkSession) -> DataFrame:
    """``(line_code, line_name)``, ten rows."""
    return spark.createDataFrame(list(LINE_NAMES.items()), "line_code string, line_name string")


def station_reference(spark: SparkSession) -> DataFrame:
    """``(line_code, station_code)``, one row per distinct pair."""
    pairs = dict.fromkeys((line, stop) for line, stops in LINE_STATIONS.items() for stop in stops)
    return spark.createDataFrame(list(pairs), "line_code string, station_code string")
