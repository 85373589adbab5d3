"""Event validation, publishing and the streaming queries."""

import json
from datetime import datetime, timezone
from itertools import product

import pytest
from pyspark.sql import functions as F

from velolake.operators import staging, status
from velolake.schemas import DEAD_LETTERS, RAW_STATION_STATUS
from velolake.session import scratch_dir, stored
from velolake.sources import station_feed, streams
from velolake.streaming import events, publish, queries

TS = "2026-01-01T00:00:00+02:00"
SNAPSHOT = datetime(2025, 12, 31, 22, 0)


def event(**fields):
    return json.dumps({"station_id": "a", "snapshot_timestamp": TS, **fields})


def without(name):
    fields = {"station_id": "a", "snapshot_timestamp": TS}
    del fields[name]
    return json.dumps(fields)


STATION, MISSING, UNREADABLE = events.INVALID_STATION, events.NO_TIMESTAMP, events.INVALID_TIMESTAMP
BIKES_INT = "num_bikes_available harus integer."
BIKES_NEGATIVE = "num_bikes_available tidak boleh negatif."
FLAG = "is_renting harus 0 atau 1."

CASES = [
    (event(), None),
    (event(unknown={"a": [1]}), None),
    (event(station_id=""), STATION), (event(station_id="  "), STATION), (event(station_id=" \x1c"), STATION),
    (event(station_id=5), STATION), (event(station_id=None), STATION), (without("station_id"), STATION),
    (event(station_id=["a"]), STATION), (event(station_id=" a "), None), (event(station_id="é"), None),
    (event(num_bikes_available=0), None), (event(num_bikes_available=None), None),
    (event(num_bikes_available=-5), BIKES_NEGATIVE), (event(num_bikes_available=5.0), BIKES_INT),
    (event(num_bikes_available="5"), BIKES_INT), (event(num_bikes_available=True), BIKES_INT),
    (event(num_bikes_available=[]), BIKES_INT), (event(num_bikes_available=2**70), BIKES_INT),
    (event(num_docks_disabled=-1), "num_docks_disabled tidak boleh negatif."),
    (event(num_bikes_available="x", num_ebikes_available=-1), BIKES_INT),
    (event(num_bikes_available=-1, num_ebikes_available="x"), BIKES_NEGATIVE),
    (event(is_renting=0), None), (event(is_renting=1.0), None), (event(is_renting=True), None), (event(is_renting=None), None),
    (event(is_renting=2), FLAG), (event(is_renting="1"), FLAG), (event(is_renting=[]), FLAG), (event(is_renting=0.5), FLAG),
    (event(is_renting=2, num_docks_available=-1), "num_docks_available tidak boleh negatif."),
    (without("snapshot_timestamp"), MISSING), (event(snapshot_timestamp=None), MISSING), (event(snapshot_timestamp=""), MISSING),
    (event(snapshot_timestamp=0), MISSING), (event(snapshot_timestamp=0.0), MISSING), (event(snapshot_timestamp=False), MISSING),
    (event(snapshot_timestamp=[]), MISSING), (event(snapshot_timestamp={}), MISSING),
    (event(snapshot_timestamp="0"), UNREADABLE), (event(snapshot_timestamp="false"), UNREADABLE),
    (event(snapshot_timestamp="[]"), UNREADABLE), (event(snapshot_timestamp=[None]), UNREADABLE),
    (event(snapshot_timestamp=True), UNREADABLE), (event(snapshot_timestamp="invalid-timestamp"), UNREADABLE),
    (event(snapshot_timestamp="12:00:00"), UNREADABLE), (event(snapshot_timestamp="2026"), UNREADABLE),
    (event(snapshot_timestamp="2026-1-1"), UNREADABLE), (event(snapshot_timestamp="2026-13-01"), UNREADABLE),
    (event(snapshot_timestamp="2026-01-01 "), UNREADABLE), (event(snapshot_timestamp="2026-01-01\n"), UNREADABLE),
    (event(snapshot_timestamp="2026-01-01"), None), (event(snapshot_timestamp="20260101T000000"), None),
    (event(last_reported="x"), None), (event(last_reported=86400), None), (event(last_reported=10**15), None),
    ("[1]", events.NOT_AN_OBJECT), ('"s"', events.NOT_AN_OBJECT), ("null", events.NOT_AN_OBJECT), (" 5", events.NOT_AN_OBJECT),
    ("bad", events.NOT_JSON), ("", events.NOT_JSON), ('{"station_id": "a"', events.NOT_JSON), ("{}", STATION), (" \n{}", STATION),
]


def test_every_rule_and_its_order(spark):
    numbered = [(i, payload) for i, (payload, _) in enumerate(CASES)]
    validated = events.validate_events(spark.createDataFrame(numbered, "i int, value string"), "i")
    reasons = {row.i: row.error_reason for row in validated.collect()}
    assert [(CASES[i][0], reasons[i]) for i, _ in numbered] == CASES
    assert events.valid_events(validated).count() + events.dead_letters(validated).count() == len(CASES)


def test_values_of_a_valid_event(spark):
    payload = event(num_bikes_available=4, is_renting=1, is_returning=False, is_installed=0.0, last_reported=1700000000)
    received = datetime(2026, 1, 1)
    validated = events.validate_events(spark.createDataFrame([(payload,)], "value string"), detected_at=F.lit(received))
    df = events.valid_events(validated)
    assert df.columns == RAW_STATION_STATUS.names
    row = df.first()
    assert (row.station_id, row.num_bikes_available, row.num_docks_available) == ("a", 4, None)
    assert (row.is_renting, row.is_returning, row.is_installed) == (True, False, False)
    assert (row.last_reported, row.snapshot_timestamp, row._ingested_at) == (datetime(2023, 11, 14, 22, 13, 20), SNAPSHOT, received)


@pytest.mark.parametrize("seconds", ["1000000000", "86400", '"1700000000"', "true", "1700000000.0", "-5", "99999999999999999999"])
def test_implausible_last_reported_is_null(spark, seconds):
    payload = event()[:-1] + f', "last_reported": {seconds}}}'
    row = events.validate_events(spark.createDataFrame([(payload,)], "value string")).first()
    assert (row.error_reason, row.last_reported) == (None, None)


def test_last_value_of_a_repeated_key_counts(spark):
    payload = '{"station_id": "", "station_id": "b", "snapshot_timestamp": "%s"}' % TS
    assert events.validate_events(spark.createDataFrame([(payload,)], "value string")).first().station_id == "b"


def test_dead_letters(spark):
    df = spark.createDataFrame([("bad",), ("",), (event(station_id=""),)], "value string")
    letters = events.dead_letters(events.validate_events(df))
    assert letters.columns == DEAD_LETTERS.names
    rows = letters.collect()
    assert {row.raw_payload for row in rows} == {"bad", "b''", event(station_id="")}
    assert {row.source for row in rows} == {"gbfs_station_status"} and len({row.error_id for row in rows}) == 3


@pytest.mark.parametrize("value", [b"", b"\xff\xfe", b"a\xff'", b"a\xff'\"", b"\xff\\\t\n\r\x00\x7f~", event().encode()])
def test_binary_messages(spark, value):
    row = events.validate_events(spark.createDataFrame([(bytearray(value),)], "value binary")).first()
    try:
        expected = value.decode() or repr(value)
    except UnicodeDecodeError:
        expected = repr(value)
    assert row.raw_payload == expected
    assert (row.error_reason is None) == (value == event().encode())


def iso_texts():
    """Dates, separators, times and zones in every combination, good and bad."""
    dates = ["2026-01-31", "20260131", "2026-02-30", "2026-0131", "0000-01-01", "1999-12-31"]
    times = ["", "10", "10:05", "10:05:59", "1005", "100559", "10:0559", "25:00", "10:05:59.1", "10:05:59,123456",
             "10:05:59.1234567", "100559.5"]
    zones = ["", "Z", "+02:00", "-0330", "+05", "+5", "+02:0"]
    return sorted({"".join(parts) for parts in product(dates, ["T", " ", "x"], times, zones)} | set(dates) | {"2026-01-31Z"})


def test_timestamps_parse_like_iso_8601(spark):
    texts = iso_texts()
    df = spark.createDataFrame([(event(snapshot_timestamp=text), text) for text in texts], "value string, text string")
    got = {row.text: row.snapshot_timestamp for row in events.validate_events(df, "text").collect()}
    expected = {}
    for text in texts:
        try:
            moment = datetime.fromisoformat(text.replace("Z", "+00:00"))
            moment = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
            expected[text] = moment.astimezone(timezone.utc).replace(tzinfo=None)
        except ValueError:
            expected[text] = None
    assert got == expected


PAYLOAD = {"last_updated": 17, "data": {"stations": [
    {"station_id": "x", "a": {"b": [1, 2]}, "snapshot_timestamp": "old"}, {"station_id": ""}, {"a": 1}, {"station_id": 0},
    {"station_id": None}, {"station_id": "z", "rental_methods": None}, {"station_id": "y", "rental_methods": ["k"], "capacity": 3},
]}}


def payloads(spark, *documents):
    return spark.createDataFrame([(json.dumps(document),) for document in documents], "payload string")


def test_fan_out_adds_times_and_skips_stations_without_id(spark):
    messages = publish.fan_out_snapshot(payloads(spark, PAYLOAD), F.lit("2026-01-01").cast("timestamp"))
    got = {row.key: row.value and json.loads(row.value) for row in messages.collect() if row.key}
    added = {"source_last_updated": 17, "snapshot_timestamp": "2026-01-01T00:00:00.000000Z"}
    assert got["x"] == {"station_id": "x", "a": {"b": [1, 2]}, **added}
    assert got["z"] == {"station_id": "z", "rental_methods": None, **added}
    path = scratch_dir(spark, "messages")
    assert publish.publish_snapshot(messages, path) == (3, 4)
    assert spark.read.text(path).count() == 3


def test_a_bad_document_does_not_end_the_stream(spark, tmp_path):
    for name, text in (("a", json.dumps(PAYLOAD)), ("b", "no json"), ("c", '{"data": {}}'), ("d", json.dumps(PAYLOAD))):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text(text)
    documents = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", 1).load(str(tmp_path / "in")).toDF("payload")
    queries.stream_publish(documents, str(tmp_path / "out"), str(tmp_path / "checkpoint"), period=None).awaitTermination()
    whole = publish.fan_out_snapshot(payloads(spark, PAYLOAD)).where("value IS NOT NULL").count()
    assert spark.read.text(str(tmp_path / "out")).count() == 2 * whole > 0
    rejected = spark.read.parquet(str(tmp_path / "out-rejected")).select("bad_document").collect()
    assert sorted(r.bad_document for r in rejected) == ["no json", '{"data": {}}']


def test_topic_columns(spark):
    messages = streams.to_topic(spark.createDataFrame([("k", "v"), (None, None), (None, "w")], "key string, value string"))
    assert dict(messages.dtypes) == {"key": "binary", "value": "binary"}
    assert sorted(bytes(r.value) for r in messages.collect()) == [b"v", b"w"]


def test_fan_out_without_last_updated(spark):
    row = publish.fan_out_snapshot(payloads(spark, {"data": {"stations": [{"station_id": "x"}]}})).first()
    assert json.loads(row.value)["source_last_updated"] is None


@pytest.mark.parametrize("document", [{}, {"data": {}}, {"data": {"stations": {"a": 1}}}, {"data": {"stations": None}}])
def test_payload_without_station_list_is_an_error(spark, document):
    with pytest.raises(Exception, match="not a list"):
        publish.fan_out_snapshot(payloads(spark, document)).collect()


def test_flatten_station_info(spark):
    rows = {row.station_id: row for row in station_feed.flatten_station_info(payloads(spark, PAYLOAD)).collect()}
    assert (rows["x"].rental_methods, rows["z"].rental_methods, rows["y"].rental_methods) == ([], None, ["k"])
    assert rows["y"].capacity == 3 and rows["x"]._ingested_at is not None
    with pytest.raises(ValueError):
        station_feed.require_stations(station_feed.flatten_station_info(payloads(spark, {"data": {"stations": []}})))


def test_generated_events_are_invalid_in_turn(spark):
    messages = publish.generate_invalid_events(spark, 101)
    reasons = events.validate_events(messages).groupBy("error_reason").count().collect()
    assert {tuple(row) for row in reasons} == {(STATION, 34), (BIKES_NEGATIVE, 34), (UNREADABLE, 33)}
    assert messages.where("key = 'TEST-DLQ-NEGATIVE-2'").count() == 1
    with pytest.raises(ValueError):
        publish.generate_invalid_events(spark, 0)


def write_messages(spark, path, texts):
    spark.createDataFrame([(text,) for text in texts], "value string").coalesce(1).write.mode("append").text(path)


def test_stream_split_equals_batch_and_takes_each_message_once(spark):
    root = scratch_dir(spark, "stream")
    texts = [payload for payload, _ in CASES if payload and "\n" not in payload]
    write_messages(spark, f"{root}/in", texts[:20])

    def run():
        source = streams.message_files(spark, f"{root}/in", files_per_batch=1)
        queries.stream_split(source, f"{root}/valid", f"{root}/dead", f"{root}/cp", period=None).awaitTermination()
        return spark.read.parquet(f"{root}/valid"), spark.read.parquet(f"{root}/dead")

    run()
    write_messages(spark, f"{root}/in", texts[20:])
    run()
    valid, dead = run()
    expected = events.validate_events(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert valid.count() == events.valid_events(expected).count()
    columns = ["raw_payload", "error_reason", "source"]
    assert sorted(dead.select(columns).collect()) == sorted(events.dead_letters(expected).select(columns).collect())
    assert dead.select("batch_id").distinct().count() == 2


def test_a_repeated_batch_is_replaced(spark):
    path = scratch_dir(spark, "batches")
    queries.write_batch(spark.range(5), path, 7)
    queries.write_batch(spark.range(3), path, 7)
    queries.write_batch(spark.range(2), path, 8)
    counts = spark.read.parquet(path).groupBy("batch_id").count().collect()
    assert {tuple(row) for row in counts} == {(7, 3), (8, 2)}


def test_stream_live_keeps_the_newest_snapshot(spark):
    root = scratch_dir(spark, "live")
    first = [event(snapshot_timestamp=f"2026-01-01T00:0{i}:00Z", num_bikes_available=i) for i in (3, 1)]
    later = [event(snapshot_timestamp=f"2026-01-01T00:0{i}:00Z", num_bikes_available=i) for i in (2,)]
    other = [event(station_id="b", snapshot_timestamp="2026-01-01T00:09:00Z", num_bikes_available=9)]
    for texts in (first, later + other):
        write_messages(spark, f"{root}/in", texts)
        valid = queries.stream_valid_events(streams.message_files(spark, f"{root}/in"))
        queries.stream_station_live(valid, f"{root}/changes", f"{root}/cp", period=None).awaitTermination()
    live = queries.station_live_table(spark.read.parquet(f"{root}/changes"))
    assert sorted((row.station_id, row.num_bikes_available) for row in live.collect()) == [("a", 3), ("b", 9)]


def counted(minute, bikes=1, **fields):
    return event(snapshot_timestamp=f"2026-01-01T00:{minute:02d}:00Z", **{name: bikes for name in status.COUNT_FIELDS}, **fields)


def test_stream_fact_takes_each_snapshot_once(spark):
    """Repeats in a batch, in a later batch and of unknown stations are dropped; late snapshots are not."""
    root = scratch_dir(spark, "fact")
    stations = stored(spark.createDataFrame([("k", "a")], "station_key string, gbfs_station_id string"), "dim")
    batches = ([counted(5), counted(5, bikes=2), counted(5, station_id="q")], [counted(5, station_id="q")], [counted(5), counted(1, bikes=3)])
    for texts in batches:
        write_messages(spark, f"{root}/in", texts)
        valid = queries.stream_valid_events(streams.message_files(spark, f"{root}/in"))
        clean = status.clean_station_status(staging.stage_station_status(valid))
        queries.stream_status_fact(clean, stations, f"{root}/fact", f"{root}/cp", period=None).awaitTermination()
    rows = spark.read.option("basePath", f"{root}/fact").parquet(f"{root}/fact").collect()
    assert sorted((row.batch_id, row.snapshot_timestamp.minute, row.available_capacity) for row in rows) == [(0, 5, 4), (2, 1, 12)]


def test_first_of_each_keeps_one_whole_row(spark):
    df = spark.createDataFrame([("k", 1, 2, None), ("k", 1, 2, 7), ("k", 1, 3, 0), ("j", 1, None, 1)],
                               "station_key string, snapshot_timestamp int, a int, b int")
    assert sorted(tuple(r) for r in status.first_of_each(df).collect()) == [("j", 1, None, 1), ("k", 1, 2, None)]


def test_dead_letter_windows(spark):
    times = [datetime(2026, 1, 1, 0, m) for m in (0, 4, 5)]
    rows = queries.dead_letter_windows(spark.createDataFrame([(t,) for t in times], "detected_at timestamp")).collect()
    assert sorted((row.window_start.minute, row.dead_letters) for row in rows) == [(0, 2), (5, 1)]


def test_stream_of_dead_letter_windows(spark):
    """Windows are written once the watermark has passed their end."""
    root = scratch_dir(spark, "windows")
    for times in ([datetime(2026, 1, 1, 0, m) for m in (0, 4, 5)], [datetime(2026, 1, 1, 1, 0)]):
        letters = spark.createDataFrame([(t,) for t in times], "detected_at timestamp")
        letters.coalesce(1).write.mode("append").parquet(f"{root}/in")
        arriving = spark.readStream.schema(letters.schema).parquet(f"{root}/in")
        windows = queries.dead_letter_windows(arriving, late_by="1 minute")
        writer = windows.writeStream.format("parquet").option("checkpointLocation", f"{root}/cp")
        writer.trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    rows = spark.read.parquet(f"{root}/out").collect()
    assert sorted((row.window_start.minute, row.dead_letters) for row in rows) == [(0, 2), (5, 1)]
