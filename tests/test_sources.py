"""Trip files, station snapshots and layered tables."""

from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.test_trips import GOOD
from velolake.schemas import DEAD_LETTERS, RAW_STATION_INFORMATION, RAW_TRIPS
from velolake.session import scratch_dir
from velolake.sources import station_feed, tables, trip_files


def raw(spark, *changes):
    rows = [tuple({**GOOD, **change}[name] for name in RAW_TRIPS.names) for change in changes]
    return spark.createDataFrame(rows, RAW_TRIPS)


def folders(path):
    return sorted(str(p.parent.relative_to(path)) for p in path.rglob("*.csv"))


def test_csv_round_trip_keeps_text_as_it_is(spark, tmp_path):
    df = raw(spark, {"ride_id": "007", "rideable_type": " Classic_Bike ", "start_station_name": 'A, "B"'}, {"member_casual": None})
    trip_files.write_trips_csv(df, str(tmp_path / "trips"))
    assert sorted(trip_files.scan_trips_csv(spark, str(tmp_path / "trips")).collect(), key=str) == sorted(df.collect(), key=str)


def test_daily_partitions_have_padded_names_and_number_columns(spark, tmp_path):
    df = raw(spark, {}, {"started_at": "2026-01-05 23:59:59.123456"}, {"started_at": "2025-11-30 00:00:00"})
    trip_files.write_daily_partitions(df, str(tmp_path / "t"))
    assert folders(tmp_path / "t") == ["year=2025/month=11/day=30", "year=2026/month=01/day=05"]
    scanned = trip_files.scan_partitioned_trips(spark, str(tmp_path / "t"))
    assert dict(scanned.dtypes)["month"] == "int" and scanned.columns[-3:] == ["year", "month", "day"]
    assert {(r.year, r.month, r.day) for r in scanned.collect()} == {(2025, 11, 30), (2026, 1, 5)}
    one = trip_files.scan_partitioned_trips(spark, str(tmp_path / "t"), "year=2026/month=01")
    assert one.count() == 2 and {r.year for r in one.collect()} == {2026}
    assert trip_files.partition_day_count(df.withColumn("started_at", F.to_timestamp("started_at"))).first().days == 2


def test_replace_month_removes_days_and_keeps_other_months(spark, tmp_path):
    root = tmp_path / "t"
    first = raw(spark, {}, {"started_at": "2026-01-06 00:00:00"}, {"started_at": "2026-02-01 00:00:00"}, {"started_at": "soon"})
    assert trip_files.replace_month(first, str(root), 2026, 1) == (2, 2)
    assert trip_files.replace_month(first, str(root), 2026, 2) == (1, 1)
    assert trip_files.replace_month(raw(spark, {}, {}), str(root), 2026, 1) == (2, 1)
    assert folders(root) == ["year=2026/month=01/day=05", "year=2026/month=02/day=01"]
    assert trip_files.replace_month(first.where("false"), str(root), 2026, 1) == (0, 0)
    assert folders(root) == ["year=2026/month=02/day=01"]


def test_extract_months(spark, tmp_path):
    df = raw(spark, {}, {"started_at": "2026-01-06 00:00:00"}, {"started_at": "2026-02-01 00:00:00"})
    trip_files.write_trips_csv(df, str(tmp_path / "source"))
    sources = {"202601": str(tmp_path / "source"), "202602": str(tmp_path / "source")}
    assert trip_files.extract_months(spark, sources, str(tmp_path / "t")) == {"202601": (2, 2), "202602": (1, 1)}
    assert len(folders(tmp_path / "t")) == 3


def test_filter_period(spark):
    df = raw(spark, {"started_at": "2026-12-31 23:59:59"}, {"started_at": "2027-01-01 00:00:00"}, {"started_at": "x"}, {"started_at": None})
    assert trip_files.filter_period(df, 2026, 12).count() == 1
    assert trip_files.filter_period(df, 2027, 1).first().started_at == datetime(2027, 1, 1)
    with pytest.raises(ValueError):
        trip_files.filter_period(df.drop("started_at"), 2026, 12)


def information(spark, day, *ids):
    stamp = datetime.fromisoformat(day)
    rows = [(i, "n", None, 1.0, 2.0, None, None, None, methods, stamp) for i, methods in ids]
    return spark.createDataFrame(rows, RAW_STATION_INFORMATION)


def test_snapshot_replaces_its_own_day(spark, tmp_path):
    path = str(tmp_path / "info")
    station_feed.write_station_snapshot(information(spark, "2026-01-01", ("a", [])), path)
    station_feed.write_station_snapshot(information(spark, "2026-01-02", ("a", None), ("b", ["key"])), path)
    station_feed.write_station_snapshot(information(spark, "2026-01-02", ("c", ["key", "card"])), path)
    df = station_feed.scan_station_info_json(spark, path)
    assert sorted((r.station_id, r.rental_methods, str(r.dt)) for r in df.collect()) == [
        ("a", [], "2026-01-01"), ("c", ["key", "card"], "2026-01-02"),
    ]
    one_day = station_feed.scan_station_info_json(spark, f"{path}/dt=2026-01-02")
    assert [r.station_id for r in one_day.collect()] == ["c"]


def test_read_payloads(spark, tmp_path):
    (tmp_path / "feed.json").write_text('{"data":\n {"stations": [{"station_id": "a"}, {"station_id": "b"}]}}')
    df = station_feed.flatten_station_info(station_feed.read_payloads(spark, str(tmp_path / "feed.json")))
    assert sorted(r.station_id for r in df.collect()) == ["a", "b"]


def test_full_refresh_replaces(spark):
    path = scratch_dir(spark, "raw")
    assert tables.full_refresh_load(spark.range(5), path) == 5
    assert tables.full_refresh_load(spark.range(3), path) == 3
    assert spark.read.parquet(path).count() == 3


def test_layers(spark, layers):
    names = {row.namespace for row in spark.sql("SHOW DATABASES").collect()}
    assert {f"{layers.prefix}_{layer}" for layer in tables.LAYERS} <= names
    assert layers.read_or_empty("raw", "station_status_dlq", DEAD_LETTERS).count() == 0
    assert layers.refresh(spark.range(4), "raw", "t") == 4
    assert layers.append(spark.range(2), "raw", "t") == 2
    assert layers.read_or_empty("raw", "t", DEAD_LETTERS).count() == 6
    assert layers.refresh(spark.range(1), "raw", "t") == 1
    with pytest.raises(AnalysisException):
        layers.refresh(layers.read("raw", "t"), "raw", "t")


def test_day_tables_are_split_by_day(spark, layers):
    df = spark.sql("SELECT id, date_add(date'2026-01-01', cast(id % 3 AS int)) AS date_key FROM range(9)")
    assert layers.refresh(df, "mart", "fact_trips") == 9
    assert layers.newest_day("mart", "fact_trips") == date(2026, 1, 3)
    plan = layers.read("mart", "fact_trips").where("date_key = date'2026-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_key" in plan
    assert layers.refresh(df.where("false"), "mart", "fact_trips") == 0
    assert layers.newest_day("mart", "fact_trips") is None


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(RuntimeError):
        scratch_dir(Cluster(), "x")
