"""Station status: validity, the fact, incremental loads, late rows and the live mart."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from velolake.operators import dashboard, marts, quality, staging, status
from velolake.schemas import RAW_STATION_STATUS
from velolake.session import scratch_dir, stored

NOON = datetime(2026, 1, 5, 12, 0, tzinfo=timezone.utc)
GOOD = {"station_id": "g1", "num_bikes_available": 3, "num_ebikes_available": 1, "num_docks_available": 4,
        "num_bikes_disabled": 1, "num_docks_disabled": 2, "is_installed": True, "is_renting": True, "is_returning": True,
        "last_reported": NOON, "snapshot_timestamp": NOON, "_ingested_at": NOON}


def raw(spark, *changes):
    rows = [tuple({**GOOD, **change}[name] for name in RAW_STATION_STATUS.names) for change in changes]
    return spark.createDataFrame(rows, RAW_STATION_STATUS)


def clean(spark, *changes):
    return status.clean_station_status(staging.stage_station_status(raw(spark, *changes)))


def at(minutes):
    return {"snapshot_timestamp": NOON + timedelta(minutes=minutes)}


@pytest.fixture(scope="module")
def stations(spark):
    df = spark.createDataFrame(
        [("k1", "JC1", "g1", "One", 40.0, -74.0, 10), ("k2", "JC2", "g2", "Two", 41.0, -74.0, 12), ("k3", "JC3", None, "Three", 42.0, -74.0, None)],
        "station_key string, station_code string, gbfs_station_id string, station_name string, latitude double, longitude double, capacity bigint",
    )
    return stored(df, "dim_station")


def test_valid_status(spark):
    df = clean(spark, {}, {"station_id": "g2", "num_bikes_available": 0, "num_docks_available": 0},
               {"num_docks_available": None}, {"num_ebikes_available": -1})
    rows = {row.station_id: row for row in df.collect()}
    assert set(rows) == {"g1", "g2"} and df.count() == 2
    assert (rows["g1"].available_capacity, rows["g1"].is_empty, rows["g1"].is_full) == (10, False, False)
    assert (rows["g2"].available_capacity, rows["g2"].is_empty, rows["g2"].is_full) == (3, True, True)


def test_unknown_stations_are_dropped(spark, stations):
    fact = status.fact_station_status(clean(spark, {}, {"station_id": "g7"}), stations)
    assert [row.station_key for row in fact.collect()] == ["k1"]


def save(fact, path):
    fact.write.mode("append").partitionBy("snapshot_date").parquet(path)
    return fact.sparkSession.read.schema(fact.schema).parquet(path)


def test_second_load_adds_newer_rows_only(spark, stations):
    path = scratch_dir(spark, "fact")
    loaded = save(status.fact_station_status(clean(spark, at(0), at(5)), stations), path)
    assert status.high_watermark(loaded) == NOON + timedelta(minutes=5)
    source = clean(spark, at(0), at(5), at(3), at(6), {**at(2000), "station_id": "g2"})
    loaded = save(status.increment(source, stations, loaded), path)
    assert loaded.count() == 4
    loaded = save(status.increment(source, stations, loaded), path)
    assert loaded.count() == 4
    late = status.late_rows(source, stations, loaded)
    assert [row.snapshot_timestamp.minute for row in late.collect()] == [3]
    loaded = save(status.increment(source, stations, loaded, mode="by_key"), path)
    assert loaded.count() == 5
    assert status.increment(source, stations, loaded, mode="by_key").count() == 0
    with pytest.raises(ValueError):
        status.increment(source, stations, loaded, mode="other")


def test_watermark_of_an_empty_table_is_the_epoch(spark, stations):
    empty = status.fact_station_status(clean(spark, {}), stations).where("false")
    assert status.high_watermark(empty) == status.EPOCH
    assert status.increment(clean(spark, {}), stations, empty).count() == 1


def test_watermark_is_pushed_into_the_scan(spark, stations):
    source = stored(clean(spark, {}), "status")
    plan = status.newer_than(source, NOON)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(snapshot_timestamp" in plan


def test_live_mart_has_the_newest_row_per_station(spark, stations):
    path = scratch_dir(spark, "fact")
    fact = save(status.fact_station_status(clean(
        spark, at(0), {**at(9), "num_bikes_available": 0}, at(5), {**at(1), "station_id": "g2"},
        # A tie on the snapshot: the row ingested later wins.
        {**at(1), "station_id": "g2", "num_bikes_available": 7, "_ingested_at": NOON + timedelta(minutes=9)},
        {**at(-3000), "station_id": "g2"},
    ), stations), path)
    live = marts.mart_station_live(fact, stations)
    assert live.columns == list(marts.LIVE_COLUMNS)
    rows = {row.station_code: row for row in live.collect()}
    assert set(rows) == {"JC1", "JC2"}
    assert rows["JC1"].snapshot_timestamp.minute == 9 and rows["JC1"].is_empty
    assert rows["JC2"].num_bikes_available == 7
    assert {r.status for r in quality.check_station_live(live).collect()} == {"PASS"}
    totals = dashboard.live_totals(live).first()
    assert (totals.stations, totals.bikes, totals.docks) == (2, 7, 8)


def test_live_mart_is_one_scan_and_limits_rows_before_the_shuffle(spark, stations):
    fact = save(status.fact_station_status(clean(spark, at(0), at(3000), {**at(9000), "station_id": "g2"}), stations), scratch_dir(spark, "fact"))
    plan = marts.latest_status(fact)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "WindowGroupLimit" in plan.partition("Exchange")[2]


def test_live_mart_does_not_depend_on_the_day_column(spark, stations):
    fact = status.fact_station_status(clean(spark, at(0)), stations)
    shifted = fact.withColumn("snapshot_date", F.date_add("snapshot_date", 1))
    assert marts.mart_station_live(shifted, stations).collect() == marts.mart_station_live(fact, stations).collect()


def test_live_mart_has_one_row_for_a_repeated_station(spark, stations):
    twice = stored(stations.unionByName(stations.withColumn("station_name", F.lit("Other"))), "dim_station")
    fact = status.fact_station_status(clean(spark, at(0), {**at(1), "station_id": "g2"}), stations)
    rows = marts.mart_station_live(fact, twice).collect()
    assert sorted((row.station_key, row.station_name) for row in rows) == [("k1", "One"), ("k2", "Other")]


def test_updated_live_mart_ranks_copies_as_a_rebuild_does(spark, stations):
    first = status.fact_station_status(clean(spark, at(0)), stations)
    copies = [{**at(7), "num_bikes_available": 3, "_ingested_at": NOON}, {**at(7), "num_bikes_available": 8, "_ingested_at": NOON + timedelta(minutes=9)}]
    new = status.fact_station_status(clean(spark, *copies), stations)
    updated = marts.refreshed_station_live(marts.mart_station_live(first, stations), new, stations).collect()
    assert updated == marts.mart_station_live(first.unionByName(new), stations).collect()
    assert updated[0].num_bikes_available == 8


def test_updated_live_mart_equals_a_rebuild(spark, stations):
    first = status.fact_station_status(clean(spark, at(0), {**at(1), "station_id": "g2"}), stations)
    new = status.fact_station_status(clean(spark, at(7), at(8)), stations)
    live = marts.mart_station_live(first, stations)
    updated = marts.refreshed_station_live(live, new, stations)
    rebuilt = marts.mart_station_live(first.unionByName(new), stations)
    assert sorted(updated.collect()) == sorted(rebuilt.collect())


def test_freshness(spark):
    df = raw(spark, at(0), at(-30))
    for wait, minutes, stale in ((timedelta(minutes=5, seconds=59), 5, False), (timedelta(minutes=6), 6, True)):
        assert tuple(quality.check_freshness(df, NOON + wait).first()) == (minutes, stale)
    assert tuple(quality.check_freshness(df.where("false"), NOON).first()) == (None, True)


def test_raw_status_raises_at_the_first_failure(spark):
    now = NOON + timedelta(minutes=1)
    assert quality.require_raw_status(raw(spark, {}), now) == 1
    cases = [
        (raw(spark, {}).where("false"), "GBFS data kosong"),
        (raw(spark, {"station_id": " \t"}, {"num_bikes_available": -1}), "GBFS station tidak valid"),
        (raw(spark, {"num_docks_available": -1}), "GBFS availability tidak valid"),
        (raw(spark, at(-10)), "GBFS data stale | freshness=11m"),
    ]
    for df, message in cases:
        with pytest.raises(ValueError, match=message.replace("|", r"\|")):
            quality.require_raw_status(df, now)
    # Disabled counts are not part of this check.
    assert quality.require_raw_status(raw(spark, {"num_bikes_disabled": -1}), now) == 1


def test_status_checks_find_faults(spark, stations):
    staged = staging.stage_station_status(raw(spark, {}, {"num_bikes_available": -1}))
    assert [r.status for r in quality.check_staged_status(staged).collect()] == ["PASS", "PASS", "FAIL"]
    fact = status.fact_station_status(clean(spark, {}, {}), stations)
    checked = {r.check_name: r.status for r in quality.check_status_fact(fact, unique=True).collect()}
    assert checked == {"row_count": "PASS", "key_valid": "PASS", "availability_valid": "PASS", "duplicate_event": "FAIL"}
    assert quality.check_status_fact(fact).count() == 3


def test_recent_dead_letters(spark):
    times = [NOON - timedelta(minutes=5), NOON - timedelta(minutes=5, seconds=1), NOON]
    letters = spark.createDataFrame([(t,) for t in times], "detected_at timestamp")
    assert tuple(quality.recent_dead_letters(letters, NOON).first()) == (2, "PASS")
    assert tuple(quality.recent_dead_letters(letters, NOON, limit=1).first()) == (2, "WARN")
    many = spark.range(101).select(F.lit(NOON).alias("detected_at"))
    assert tuple(quality.recent_dead_letters(many, NOON).first()) == (101, "WARN")
