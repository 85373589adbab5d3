"""Station dimension, trip fact, marts and dashboard over a few hand-written rows."""

from datetime import date
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from tests.test_trips import staged
from velolake.operators import dashboard, marts, quality, staging, stations, trips, warehouse
from velolake.schemas import RAW_STATION_INFORMATION
from velolake.session import stored

INFO = {"station_id": "g1", "name": " Alpha ", "short_name": "JC1", "lat": 40.0, "lon": -74.0, "region_id": "1",
        "capacity": 10, "station_type": " CLASSIC ", "rental_methods": ["key"]}


def information(spark, *changes):
    from datetime import datetime

    rows = [tuple({**INFO, "_ingested_at": datetime(2026, 1, 1), **c}[n] for n in RAW_STATION_INFORMATION.names) for c in changes]
    return staging.stage_station_information(spark.createDataFrame(rows, RAW_STATION_INFORMATION))


def key(code):
    return md5(code.encode()).hexdigest()


def test_clean_station_information(spark):
    df = information(
        spark, {}, {"station_id": "g2", "capacity": None}, {"station_id": "g3", "capacity": 0},
        {"station_id": "g4", "capacity": -1}, {"station_id": "g5", "short_name": None}, {"station_id": "g6", "lat": 91.0},
        {"station_id": "g7", "name": None}, {"station_id": "g8", "lon": None},
    )
    kept = stations.clean_station_information(df).collect()
    assert sorted(row.station_id for row in kept) == ["g1", "g2", "g3"]
    assert {(row.station_name, row.station_type) for row in kept} == {("Alpha", "classic")}


@pytest.fixture(scope="module")
def star(spark):
    """Four trips: two from JC1 to JC2, one back, one a day later; only JC1 and JC9 are in the feed."""
    clean = trips.clean_trips(staged(
        spark,
        {"ride_id": "a"},
        {"ride_id": "b", "ended_at": "2026-01-05 08:20:00", "member_casual": "casual"},
        {"ride_id": "c", "start_station_id": "JC2", "end_station_id": "JC1", "start_station_name": "Z"},
        {"ride_id": "d", "started_at": "2026-01-06 09:00:00", "ended_at": "2026-01-06 09:30:00"},
    ))
    info = information(spark, {}, {"station_id": "g9", "short_name": "JC9", "name": "Nine"})
    dims = {
        "dim_date": stored(warehouse.dim_date(clean), "dim_date"),
        "dim_station": stored(stations.dim_station(info, clean), "dim_station"),
        "dim_rider_type": warehouse.dim_rider_type(spark),
        "dim_bike_type": warehouse.dim_bike_type(spark),
    }
    fact = stored(warehouse.fact_trips(clean, dims["dim_station"], dims["dim_rider_type"], dims["dim_bike_type"]), "fact")
    return clean, dims, fact


def test_dim_station_joins_both_sides(star):
    rows = {row.station_code: row for row in star[1]["dim_station"].collect()}
    assert set(rows) == {"JC1", "JC2", "JC9"}
    assert rows["JC1"].station_name == "Alpha" and rows["JC1"].latitude == 40.0
    # Stations seen only in trips take the smallest observation; here "B" before "Z".
    assert (rows["JC2"].gbfs_station_id, rows["JC2"].station_name, rows["JC2"].capacity) == (None, "B", None)
    assert rows["JC9"].gbfs_station_id == "g9"
    assert all(row.station_key == key(code) for code, row in rows.items())


def test_fact_keeps_trips_of_unknown_stations(spark, star):
    clean, dims, _ = star
    some = dims["dim_station"].where("station_code = 'JC1'")
    fact = warehouse.fact_trips(clean, some, dims["dim_rider_type"], dims["dim_bike_type"])
    rows = {row.ride_id: row for row in fact.collect()}
    assert rows["a"].start_station_key == key("JC1") and rows["a"].end_station_key is None
    assert (rows["b"].rider_type_key, rows["a"].rider_type_key, rows["a"].bike_type_key) == (2, 1, 1)
    orphans = quality.orphan_facts(fact, {**dims, "dim_station": some})
    assert orphans.count() == 4


def test_dim_date(star):
    rows = sorted(star[1]["dim_date"].collect())
    assert [tuple(row) for row in rows] == [
        (date(2026, 1, 5), 5, "Monday", False, 1, "January", 2026), (date(2026, 1, 6), 6, "Tuesday", False, 1, "January", 2026),
    ]


def test_daily_and_hourly_marts(star):
    _, dims, fact = star
    daily = marts.mart_daily_rides(fact, dims["dim_date"], dims["dim_rider_type"], dims["dim_bike_type"])
    rows = {(row.ride_date.day, row.rider_type): row for row in daily.collect()}
    assert rows[5, "member"].total_rides == 2 and rows[5, "member"].avg_ride_duration_minutes == 10.0
    assert rows[5, "casual"].avg_ride_duration_minutes == 20.0
    hourly = marts.mart_hourly_rides(fact, dims["dim_rider_type"], dims["dim_bike_type"])
    assert sorted((r.ride_date.day, r.ride_hour, r.total_rides) for r in hourly.collect()) == [(5, 8, 1), (5, 8, 2), (6, 9, 1)]
    assert quality.negative_metrics(daily).count() == 0
    assert [r.total_rides for r in dashboard.daily_trend(daily).collect()] == [3, 1]
    assert [tuple(r) for r in dashboard.rides_by_hour(hourly).collect()] == [(8, 3), (9, 1)]
    assert dashboard.filtered(daily, "2026-01-06", rider_types=["member"], bike_types=["classic_bike"]).count() == 1
    assert dashboard.filtered(daily, last=date(2026, 1, 5)).count() == 2
    kpis = dashboard.kpis(fact, dims["dim_rider_type"]).first()
    assert tuple(kpis) == (4, 2.0, 17.5, 3, 1)


def test_groups_of_a_repeated_type_merge(spark, star):
    """Two keys of the same rider type are one group, as if grouped after the join."""
    _, dims, fact = star
    riders = spark.sql("SELECT * FROM VALUES (1L, 'anyone'), (2L, 'anyone') AS t(rider_type_key, rider_type)")
    rows = marts.mart_daily_rides(fact, dims["dim_date"], riders, dims["dim_bike_type"]).collect()
    assert sorted((row.ride_date.day, row.total_rides) for row in rows) == [(5, 3), (6, 1)]


def joined_performance(fact, stations_):
    """The mart written with a union of both counts and two joins."""
    departures, arrivals = marts.station_departures(fact), marts.station_arrivals(fact)
    spine = departures.select("ride_date", "station_key").union(arrivals.select("ride_date", "station_key")).distinct()
    on = ["ride_date", "station_key"]
    counted = spine.join(departures, on, "left").join(arrivals, on, "left").fillna(0, ["total_departures", "total_arrivals"])
    return counted.join(stations_, "station_key", "left").select(
        "ride_date", F.when(F.col("station_code").isNotNull(), F.col("station_key")).alias("station_key"), "station_code",
        "station_name", "latitude", "longitude", "total_departures", "total_arrivals",
        (F.col("total_departures") + F.col("total_arrivals")).alias("total_trip_activity"),
    )


def test_station_performance_equals_the_joined_form(star):
    _, dims, fact = star
    one = marts.mart_station_performance(fact, dims["dim_station"])
    other = joined_performance(fact, dims["dim_station"])
    assert sorted(one.collect()) == sorted(other.collect())
    assert [(r.station_code, r.total_trip_activity) for r in dashboard.top_stations(one).collect()] == [("JC1", 4), ("JC2", 4)]
    assert marts.station_date_spine(fact).count() == 4


def test_activity_of_an_unknown_station_has_no_attributes(star):
    _, dims, fact = star
    rows = marts.mart_station_performance(fact, dims["dim_station"].where("station_code <> 'JC2'")).collect()
    assert sum(row.total_trip_activity for row in rows if row.station_key is None) == 4


def test_marts_add_up(star):
    _, dims, fact = star
    daily = marts.mart_daily_rides(fact, dims["dim_date"], dims["dim_rider_type"], dims["dim_bike_type"])
    hourly = marts.mart_hourly_rides(fact, dims["dim_rider_type"], dims["dim_bike_type"])
    performance = marts.mart_station_performance(fact, dims["dim_station"])
    assert {r.status for r in quality.check_marts(fact, daily, hourly, performance).collect()} == {"PASS"}
    empty = quality.check_marts(fact, daily.where("false"), hourly, performance).first()
    assert (empty.status, empty.actual_value) == ("FAIL", "None")


def test_plans_scan_the_fact_once(star):
    """Two roles of a trip come from one scan, and the marts shuffle groups only."""
    _, dims, fact = star
    plan = marts.station_activity(fact)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    kept = stations.stations_in_trips(trips.clean_trips(staging_of(star)))._jdf.queryExecution().executedPlan().toString()
    assert kept.count("FileScan") <= 1
    # The four columns of an observation are hashed, not sorted.
    assert "HashAggregate(keys=[station_code" in kept and "functions=[partial_count(1)]" in kept


def staging_of(star):
    return star[0].withColumns({"_ingested_at": F.current_timestamp()})
