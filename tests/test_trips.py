"""Hand-written trips: staging, the clean rules, reject reasons and enrichment."""

import math
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from velolake.functions import mean_from_hundredths, trimmed
from velolake.functions.geo import EARTH_RADIUS_METRES
from velolake.operators import quality, staging, trips
from velolake.schemas import RAW_TRIPS

GOOD = {
    "ride_id": "r1", "rideable_type": "classic_bike", "started_at": "2026-01-05 08:00:00",
    "ended_at": "2026-01-05 08:10:00", "start_station_name": "A", "start_station_id": "JC1",
    "end_station_name": "B", "end_station_id": "JC2", "start_lat": "40.7", "start_lng": "-74.0",
    "end_lat": "40.8", "end_lng": "-74.1", "member_casual": "member",
}


def staged(spark, *changes):
    rows = [tuple({**GOOD, **change}[name] for name in RAW_TRIPS.names) for change in changes]
    return staging.stage_trips(spark.createDataFrame(rows, RAW_TRIPS))


# Change to the good trip, and where it ends up: "clean", a reject reason, or None for neither.
OUTCOMES = [
    ({}, "clean"),
    ({"ended_at": GOOD["started_at"]}, "invalid trip time"),
    ({"ended_at": "2026-01-05 07:59:59"}, "invalid trip time"),
    ({"ride_id": None}, "missing ride_id"),
    ({"started_at": None}, "missing timestamp"),
    ({"ended_at": None}, "missing timestamp"),
    ({"member_casual": " Member "}, "clean"),
    ({"member_casual": " MEMBER\t"}, "clean"),
    ({"member_casual": "subscriber"}, "invalid user type"),
    ({"member_casual": None}, None),
    ({"rideable_type": "docked_bike"}, "invalid bike type"),
    ({"rideable_type": None}, None),
    ({"start_station_id": None}, "missing station"),
    ({"end_station_id": None}, "missing station"),
    ({"start_station_name": None}, "invalid coordinates"),
    ({"start_lat": None}, None),
    ({"end_lng": "west"}, None),
    ({"start_lat": None, "end_lat": "95"}, "missing coordinates"),
    ({"start_lat": "95"}, "invalid coordinates"),
    ({"start_lng": "-181"}, "invalid coordinates"),
    ({"start_lat": "90"}, "clean"),
    ({"end_lng": "-180"}, "clean"),
    ({"ride_id": None, "member_casual": None}, "missing ride_id"),
]


def test_every_trip_has_its_outcome(spark):
    changes = [{"ride_id": f"r{i}", **change} for i, (change, _) in enumerate(OUTCOMES)]
    # Rides without an id are told apart by their start.
    for i, change in enumerate(changes):
        change.setdefault("start_station_name", f"A{i}")
    for i, (change, expected) in enumerate(OUTCOMES):
        one = staged(spark, changes[i])
        clean, rejected = trips.split_trips(one)
        got = ["clean"] * clean.count() + [row.invalid_reason for row in rejected.collect()]
        assert got == ([expected] if expected else []), change


def test_complete_mode_keeps_the_trips_that_are_in_neither_set(spark):
    df = staged(spark, *[change for change, _ in OUTCOMES])
    clean, rejected = trips.split_trips(df, "complete")
    assert clean.count() + rejected.count() == df.count()
    reasons = {row.invalid_reason: row["count"] for row in rejected.groupBy("invalid_reason").count().collect()}
    assert reasons["invalid user type"] == 2
    assert reasons["invalid bike type"] == 2
    assert reasons["missing coordinates"] == 3


def test_gate_finds_the_lost_trips(spark, layers):
    df = staged(spark, *[{**change, "ride_id": f"r{i}"} for i, (change, _) in enumerate(OUTCOMES)])
    for mode, status in (("reference", "FAIL"), ("complete", "PASS")):
        checked = quality.check_split_trips(df, *trips.split_trips(df, mode))
        statuses = {row.check_name: row.status for row in checked.collect()}
        assert statuses["clean_invalid_reconciliation"] == status
        assert statuses["business_rules"] == "PASS"


def test_unknown_mode_is_an_error():
    with pytest.raises(ValueError):
        trips.rejected_trip("other")


def test_malformed_timestamp_is_an_error(spark):
    with pytest.raises(PySparkException):
        staged(spark, {"ended_at": "yesterday"}).collect()


def test_enrichment(spark):
    row = trips.clean_trips(staged(spark, {"started_at": "2026-01-03 16:00:00.900", "ended_at": "2026-01-03 16:00:01.800"})).first()
    # 0.9 seconds are no whole second.
    assert row.ride_duration_minutes == 0.0
    assert (row.trip_date, row.ride_year, row.ride_month, row.ride_hour) == (date(2026, 1, 3), 2026, 1, 16)
    assert (row.ride_day_of_week, row.is_weekend, row.time_of_day) == ("Saturday", True, "evening rush")
    chord = (math.sin(math.radians(0.1) / 2) ** 2
             + math.cos(math.radians(40.7)) * math.cos(math.radians(40.8)) * math.sin(math.radians(-0.1) / 2) ** 2)
    assert row.trip_distance_km == round(2 * EARTH_RADIUS_METRES * math.asin(math.sqrt(chord)) / 1000, 2)


BANDS = {0: "late night", 5: "late night", 6: "morning rush", 9: "morning rush", 10: "daytime", 15: "daytime",
         16: "evening rush", 19: "evening rush", 20: "night", 23: "night"}


def test_time_of_day_bands(spark):
    df = staged(spark, *[
        {"started_at": f"2026-01-04 {hour:02d}:00:00", "ended_at": f"2026-01-04 {hour:02d}:30:00"} for hour in BANDS
    ])
    rows = trips.clean_trips(df).collect()
    assert {row.ride_hour: row.time_of_day for row in rows} == BANDS
    assert {row.ride_day_of_week for row in rows} == {"Sunday"}
    assert all(row.ride_duration_minutes == 30.0 for row in rows)


def test_durations_round_like_decimals(spark):
    seconds = spark.range(1, 20_001).select(F.col("id").alias("seconds"))
    expected = F.round(F.col("seconds") / 60.0, 2)
    fast = (10 * F.col("seconds") + 3 - (10 * F.col("seconds") + 3) % 6) / 6 / 100.0
    assert seconds.where(expected != fast).count() == 0


def test_repeated_ids_are_kept_and_found(spark):
    df = staged(spark, {}, {}, {"ride_id": "r2"})
    assert trips.clean_trips(df).count() == 3
    assert [row.status for row in quality.check_staged_trips(df).collect()] == ["PASS", "PASS", "FAIL"]


def test_dedupe_keeps_the_first_trip_of_an_id_and_all_without(spark):
    df = staged(
        spark, {}, {"started_at": "2026-01-05 07:00:00"}, {"started_at": None},
        {"ride_id": "r2"}, {"ride_id": "r2", "member_casual": "casual"}, {"ride_id": None}, {"ride_id": None},
    )
    kept = trips.dedupe_trips(df)
    assert kept.columns == df.columns
    rows = sorted((row.ride_id or "", str(row.started_at), row.member_casual) for row in kept.collect())
    assert rows == [
        ("", "2026-01-05 08:00:00", "member"), ("", "2026-01-05 08:00:00", "member"),
        ("r1", "2026-01-05 07:00:00", "member"), ("r2", "2026-01-05 08:00:00", "casual"),
    ]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(-10_000, 10_000), min_size=1, max_size=20))
def test_mean_is_the_rounded_exact_mean(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = df.agg(mean_from_hundredths(F.sum("v"), F.count("v"))).first()[0]
    total, count = abs(sum(values)), len(values)
    expected = (2 * total + count) // (2 * count)
    assert got == (-expected if sum(values) < 0 else expected) / 100


def test_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "v bigint")
    assert df.agg(mean_from_hundredths(F.sum("v"), F.count("v"))).first()[0] is None


@pytest.mark.parametrize("text", ["a", " a ", "\ta b\n", "　a ", "", "   ", "a\n", "\x0ba é\x85", "é"])
def test_trimmed_takes_every_white_space(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(trimmed(F.col("t"))).first()[0]
    assert got == text.strip()


def test_weekday_names(spark):
    days = spark.sql("SELECT explode(sequence(date'2026-01-01', date'2026-12-31')) AS d")
    from velolake.functions import day_name, month_name

    wrong = days.where((day_name(F.col("d")) != F.date_format("d", "EEEE")) | (month_name(F.col("d")) != F.date_format("d", "MMMM")))
    assert wrong.count() == 0
    assert days.first().d == datetime(2026, 1, 1).date()
