"""Counts of the sample tables, and plans for hot keys and for stations that are no longer few."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from velolake import session
from velolake.operators import stations, trips, warehouse
from velolake.registry.sample import Sample
from velolake.session import stored

GIVEN = Path("/root/testdata")
pytestmark = pytest.mark.skipif(not GIVEN.is_dir(), reason="the given tables are not here")

# Folder, raw, clean, rejected and lost trips, clean and valid rows of the feed and of its status.
COUNTS = [
    ("sf0.001", 6_000, 3_947, 1_373, 680, 9, 944),
    ("sf0.01", 60_000, 49_472, 7_139, 3_389, 95, 9_402),
]
REASONS = {
    "sf0.001": {"missing ride_id": 48, "missing timestamp": 98, "invalid trip time": 273, "invalid user type": 139,
                "invalid bike type": 111, "missing station": 553, "missing coordinates": 12, "invalid coordinates": 139},
    "sf0.01": {"missing ride_id": 101, "missing timestamp": 646, "invalid trip time": 1_883, "invalid user type": 1_017,
               "invalid bike type": 909, "missing station": 1_095, "missing coordinates": 28, "invalid coordinates": 1_460},
}


@pytest.mark.parametrize("folder, raw, clean, rejected, lost, feed, status", COUNTS)
def test_sample_counts(spark, folder, raw, clean, rejected, lost, feed, status):
    s = Sample(spark, str(GIVEN / folder))
    assert s.stg_trips.count() == raw
    assert s.int_trips_clean.count() == clean
    assert s.int_trips_invalid().count() == rejected
    assert s.int_trips_invalid("complete").count() == rejected + lost
    assert {r.invalid_reason: r.trips for r in trips.reject_reason_counts(s.int_trips_invalid()).collect()} == REASONS[folder]
    assert (s.int_station_information.count(), s.int_station_status.count()) == (feed, status)


def test_stored_tables_are_shared_until_the_files_change(spark, tmp_path, monkeypatch):
    for name in ("lineitem", "orders", "supplier"):
        shutil.copyfile(GIVEN / "sf0.001" / f"{name}.parquet", tmp_path / f"{name}.parquet")

    def files(**options):
        return Sample(spark, str(tmp_path), **options).stored_trips.inputFiles()

    first = files()
    assert files() == first
    assert files(share=False) != first
    for key, (path, schema) in list(session._STORED.items()):
        if str(tmp_path) in key:
            monkeypatch.setitem(session._STORED, key, (f"{path}-gone", schema))
    rebuilt = files()
    assert rebuilt != first and files() == rebuilt
    few = spark.read.parquet(str(tmp_path / "lineitem.parquet")).limit(100).toPandas()
    few.drop(columns="l_shipdate").to_parquet(tmp_path / "lineitem.parquet")
    assert files() != rebuilt
    assert Sample(spark, str(tmp_path)).stored_trips.count() <= 100


@pytest.fixture
def no_broadcast(spark):
    """Every table counts as too large to broadcast, and skew shows in small data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_busy_station_is_split_when_stations_are_many(no_broadcast):
    """Half of all trips start at one station: the sort-merge join splits it, and no row is lost."""
    s = Sample(no_broadcast, str(GIVEN / "sf0.01"))
    busy = F.when(F.xxhash64("ride_id") % 2 == 0, "S25").otherwise(F.col("start_station_id"))
    clean = stored(s.int_trips_clean.withColumn("start_station_id", busy).repartition(16), "clean")
    dim = stored(stations.dim_station(s.int_station_information, clean), "dim")
    fact = warehouse.fact_trips(clean, dim, s.dim_rider_type, s.dim_bike_type)
    rows = fact.groupBy("start_station_key").count().collect()
    assert sum(row["count"] for row in rows) == clean.count()
    assert all(row.start_station_key for row in rows)
    fact = fact.select("ride_id", "start_station_key", "end_station_key")
    fact.collect()
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


def test_station_dimension_alone_stores_no_trips(spark):
    """Status queries need the stations only; a query that reads the trips too shares the stored ones."""
    folder = str(GIVEN / "sf0.001")
    alone, both = Sample(spark, folder, share=False), Sample(spark, folder, share=False)
    dim = alone.dim_station
    assert "stored_trips" not in alone.__dict__
    stored_files = both.stored_trips.inputFiles()
    assert both.station_trips.inputFiles() == stored_files
    assert sorted(map(str, dim.collect())) == sorted(map(str, both.dim_station.collect()))
