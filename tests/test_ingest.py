"""Payload parsing, case by case."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from headway import network
from headway.operators import ingest
from headway.schemas import ENVELOPE, RAW

NOW = dt.datetime(2024, 1, 1, 4, 0, 30, 123456, tzinfo=dt.timezone.utc)
GOOD = {"seq": "1", "ttnt": "3", "time": "2024-01-01 12:00:00", "dest": "TUC", "plat": "1"}


def train(**changes):
    """A sound train with changes; a value of ... removes the key."""
    return {k: v for k, v in {**GOOD, **changes}.items() if v is not ...}


def board(key="TCL-HOK", **directions):
    return {"data": {key: directions}}


def envelope(spark, payload, line="TCL", station="HOK"):
    text = payload if isinstance(payload, str) or payload is None else json.dumps(payload)
    return spark.createDataFrame([(line, station, NOW, text)], ENVELOPE)


def arrivals(spark, payload, **where):
    return ingest.parse_arrivals(envelope(spark, payload, **where)).collect()


def reasons(spark, payload):
    rows = ingest.rejected(envelope(spark, payload)).collect()
    return sorted((r.direction, r.reason) for r in rows)


def stamp(spark, text):
    return spark.sql(f"select timestamp'{text}' as t").first().t


def test_both_directions(spark):
    rows = arrivals(spark, board(UP=[train()], DOWN=[train(dest="HOK", plat="2", ttnt="0")]))
    assert [(r.direction, r.dest_station, r.platform, r.time_remaining) for r in rows] == [
        ("UP", "TUC", "1", 180),
        ("DOWN", "HOK", "2", 0),
    ]
    row = rows[0]
    assert (row.line_code, row.line_name, row.station_code, row.sequence) == ("TCL", "Tung Chung Line", "HOK", 1)
    assert row.arrival_time == stamp(spark, "2024-01-01 12:00:00")
    assert row.ingestion_timestamp == stamp(spark, "2024-01-01 04:00:30.123456")
    assert row.ingestion_date == dt.date(2024, 1, 1)


def test_schema_is_the_raw_schema(spark):
    df = ingest.parse_arrivals(envelope(spark, board(UP=[train()])))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in RAW]


@pytest.mark.parametrize(
    "payload",
    [
        {},
        {"data": None},
        {"data": {}},
        {"data": {"TCL-KOW": {"UP": [GOOD]}}},
        {"data": {"TCL-HOK": {}}},
        {"data": {"TCL-HOK": None}},
        board(UP=[], DOWN=[]),
        board(UP=None),
        board(UP=[{}]),
    ],
)
def test_nothing_to_read_is_no_error(spark, payload):
    assert arrivals(spark, payload) == []
    assert reasons(spark, payload) == []


@pytest.mark.parametrize("payload", ["<html>", '{"data":', "", "not json"])
def test_unparsable(spark, payload):
    assert arrivals(spark, payload) == []


def test_garbage_is_reported(spark):
    assert reasons(spark, "<html>") == [(None, "unparsable_payload")]


def test_null_payload(spark):
    assert arrivals(spark, None) == []


@pytest.mark.parametrize("missing", [{"DOWN": None}, {"DOWN": []}, {}])
def test_one_direction_only(spark, missing):
    assert [r.direction for r in arrivals(spark, board(UP=[train()], **missing))] == ["UP"]


@pytest.mark.parametrize(
    "seqs, first",
    [
        (["3", "1", "2"], 1),
        (["2", "2", "2"], 0),  # stable: the earliest listed
        (["1", ...], 1),  # a missing seq counts as 0
        (["10", "9"], 1),  # numbers, not text
        (["0", "-1"], 1),
        ([" 2 ", "+1"], 1),
    ],
)
def test_first_train(spark, seqs, first):
    trains = [train(seq=s, dest=f"D{i}") for i, s in enumerate(seqs)]
    assert [r.dest_station for r in arrivals(spark, board(UP=trains))] == [f"D{first}"]


@pytest.mark.parametrize("seq", ["x", None, "1.5", ""])
def test_bad_sequence_of_any_train_drops_the_document(spark, seq):
    payload = board(UP=[train()], DOWN=[train(), train(seq=seq)])
    assert arrivals(spark, payload) == []
    assert reasons(spark, payload) == [(None, "bad_sequence")]


def test_null_train_drops_the_document(spark):
    assert arrivals(spark, board(UP=[train()], DOWN=[train(), None])) == []


def test_null_wait_of_a_first_train_drops_the_document(spark):
    payload = board(UP=[train()], DOWN=[train(ttnt=None)])
    assert arrivals(spark, payload) == []
    assert reasons(spark, payload) == [(None, "null_wait")]


def test_null_wait_of_a_later_train_is_not_looked_at(spark):
    rows = arrivals(spark, board(UP=[train(), train(seq="2", ttnt=None, time="bad")]))
    assert len(rows) == 1


@pytest.mark.parametrize(
    "ttnt, wait",
    [("3", 180), (" 3 ", 180), (3, 180), (..., 0), ("0", 0), ("-0", 0)],
)
def test_wait(spark, ttnt, wait):
    assert [r.time_remaining for r in arrivals(spark, board(UP=[train(ttnt=ttnt)]))] == [wait]


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"ttnt": "x"}, "bad_wait"),
        ({"ttnt": "3.0"}, "bad_wait"),
        ({"ttnt": ""}, "bad_wait"),
        ({"ttnt": "999999999999999999"}, "bad_wait"),  # does not fit once in seconds
        ({"ttnt": "-1"}, "negative_wait"),
        ({"time": "2024-13-01 00:00:00"}, "bad_time"),
        ({"time": "2024-02-30 00:00:00"}, "bad_time"),
        ({"time": " "}, "bad_time"),
        ({"time": "2024-01-01T12:00:00"}, "bad_time"),
        ({"time": "2024-01-01 12:00"}, "bad_time"),
    ],
)
def test_bad_value_drops_only_its_direction(spark, change, reason):
    payload = board(UP=[train(**change)], DOWN=[train()])
    assert [r.direction for r in arrivals(spark, payload)] == ["DOWN"]
    assert reasons(spark, payload) == [("UP", reason)]


@pytest.mark.parametrize("time", ["", None, ...])
def test_no_time_means_now(spark, time):
    (row,) = arrivals(spark, board(UP=[train(time=time)]))
    assert row.arrival_time == row.ingestion_timestamp


@pytest.mark.parametrize("value, shown", [(..., ""), (None, None), ("", ""), (7, "7")])
def test_text_defaults(spark, value, shown):
    (row,) = arrivals(spark, board(UP=[train(dest=value, plat=value)]))
    assert (row.dest_station, row.platform) == (shown, shown)


def test_unknown_line_has_a_name(spark):
    (row,) = arrivals(spark, board("ZZZ-HOK", UP=[train()]), line="ZZZ")
    assert row.line_name == "Unknown"


def test_ids(spark):
    env = envelope(spark, board(UP=[train()], DOWN=[train()]))
    first, again = (ingest.parse_arrivals(env).collect() for _ in range(2))
    assert [r.arrival_id for r in first] == [r.arrival_id for r in again]
    assert len({r.arrival_id for r in first}) == 2
    random_ids = {r.arrival_id for _ in range(2) for r in ingest.parse_arrivals(env, random_ids=True).collect()}
    assert len(random_ids) == 4
    assert all(len(i) == 36 for i in random_ids)


def test_reference_relations(spark):
    assert network.line_reference(spark).count() == 10
    stations = network.station_reference(spark)
    assert stations.count() == stations.distinct().count() == 105
    assert sum(map(len, network.LINE_STATIONS.values())) == 107
    shared = stations.groupBy("station_code").count().filter("count > 1")
    assert shared.count() == 18


def test_restriction(spark):
    rows = [("TCL", "HOK"), ("TCL", "CEN"), ("ZZZ", "HOK"), ("ISL", "CEN"), (None, "HOK")]
    env = spark.createDataFrame([(line, stop, NOW, "{}") for line, stop in rows], ENVELOPE)

    def kept(**how):
        return sorted((r.line_code, r.station_code) for r in ingest.restrict_to_network(env, **how).collect())

    assert kept() == [("ISL", "CEN"), ("TCL", "HOK")]
    assert kept(lines=["ISL", "ZZZ"]) == [("ISL", "CEN")]
    own = spark.createDataFrame([("ZZZ", "HOK")], "line_code string, station_code string")
    assert kept(network_pairs=own) == [("ZZZ", "HOK")]


def test_json_is_parsed_once(spark):
    plan = ingest.arrivals_from_schedules(envelope(spark, "{}"))._jdf.queryExecution()
    assert plan.executedPlan().toString().count("from_json") == 1


def test_line_name_is_kept_for_all_lines(spark):
    df = network.line_reference(spark).select("line_code", F.col("line_name").alias("expected"))
    assert ingest.with_line_name(df).filter("line_name <> expected").count() == 0


def each(spark, documents):
    """Every document's arrivals and (direction, reason) of its rejects, from one job; documents are told apart by time."""
    stamps = [NOW + dt.timedelta(minutes=k) for k in range(len(documents))]
    df = spark.createDataFrame([("TCL", "HOK", t, d) for t, d in zip(stamps, documents)], ENVELOPE)
    found = [([], []) for _ in documents]
    first = stamp(spark, "2024-01-01 04:00:30.123456")
    for row in ingest.outcomes(df).collect():
        accepted, rejects = found[round((row.ingestion_timestamp - first).total_seconds()) // 60]
        accepted.append(row) if row.reason is None else rejects.append((row.direction, row.reason))
    return found


def up(rest):
    return '{"data":{"TCL-HOK":{"UP":[{%s,"dest":"D"}],"DOWN":[{"ttnt":1}]}}}' % rest


def test_integers_of_every_type(spark):
    waits = {"3": 180, "3.7": 180, "0.9": 0, "-0.5": 0, "true": 60, "false": 0, "1e1": 600, '"+3"': 180, '" 3 "': 180}
    found = each(spark, [up(f'"seq":1,"ttnt":{w}') for w in waits])
    assert [[r.time_remaining for r in rows if r.direction == "UP"] for rows, _ in found] == [[s] for s in waits.values()]


def test_waits_that_are_none(spark):
    down = {'"3.7"': "bad_wait", '""': "bad_wait", "-1": "negative_wait", "-1.5": "negative_wait"}
    whole = {"null": "null_wait", "[3]": "wrong_type", '{"a":3}': "wrong_type"}
    found = each(spark, [up(f'"ttnt":{w}') for w in [*down, *whole]])
    assert [rejects for _, rejects in found] == [[("UP", r)] for r in down.values()] + [[(None, r)] for r in whole.values()]
    assert [len(rows) for rows, _ in found] == [1] * len(down) + [0] * len(whole)


def test_order_by_sequences_of_every_type(spark):
    firsts = {("2", "1.9"): "b", ('"2"', "true"): "b", ("0.5", "false"): "a", ('" 1 "', '"+1"'): "a", ("3", "-3"): "b"}
    documents = [
        '{"data":{"TCL-HOK":{"UP":[{"seq":%s,"ttnt":1,"dest":"a"},{"seq":%s,"ttnt":1,"dest":"b"}]}}}' % pair for pair in firsts
    ]
    assert [[r.dest_station for r in rows] for rows, _ in each(spark, documents)] == [[d] for d in firsts.values()]


def test_a_sequence_that_is_none_costs_the_document(spark):
    found = each(spark, [up(f'"seq":{s},"ttnt":1') for s in ('"1.5"', "null", "[1]", '"one"')])
    assert found == [([], [(None, "bad_sequence")])] * 4


def test_times(spark):
    now = "2024-01-01 04:00:30.123456"
    times = {'"2024-1-5 8:3:9"': "2024-01-05 08:03:09", '"2024-01-05  08:03:09"': "2024-01-05 08:03:09", '"2024-12-31 23:59:59"': "2024-12-31 23:59:59"}
    unset = ['""', "null", "0", "0.0", "false", "[]", "{}"]
    found = each(spark, [up(f'"ttnt":1,"time":{t}') for t in [*times, *unset]])
    want = [stamp(spark, t) for t in times.values()]
    want += [stamp(spark, now) + dt.timedelta(minutes=k) for k in range(len(times), len(times) + len(unset))]
    assert [r.arrival_time for rows, _ in found for r in rows if r.direction == "UP"] == want


def test_texts_that_are_no_times(spark):
    texts = ["24-01-05 08:03:09", "20245-01-05 08:03:09", "2024-13-05 08:03:09", "2024-02-30 08:03:09", "2024-01-05 08:03:60",
             "2024-01-05 08:03", "2024-01-05T08:03:09", " 2024-01-05 08:03:09", "false", "[]"]
    found = each(spark, [up(f'"ttnt":1,"time":"{t}"') for t in texts])
    assert [([r.direction for r in rows], rejects) for rows, rejects in found] == [(["DOWN"], [("UP", "bad_time")])] * len(texts)


def test_a_time_of_another_type_costs_the_document_unless_the_wait_is_bad(spark):
    times = ["17", "true", "[1]", '{"a":1}', "0.5"]
    found = each(spark, [up(f'"ttnt":{w},"time":{t}') for w in ("1", "-1", '"x"') for t in times])
    assert [rejects for _, rejects in found] == [[(None, "wrong_type")]] * 5 + [[("UP", "negative_wait")]] * 5 + [[("UP", "bad_wait")]] * 5


def test_numbers_as_destination_and_platform(spark):
    (rows, _), = each(spark, ['{"data":{"TCL-HOK":{"UP":[{"ttnt":1,"dest":null,"plat":3}]}}}'])
    assert [(r.dest_station, r.platform) for r in rows] == [(None, "3")]
