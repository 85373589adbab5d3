"""The daily batch and the realtime refresh over tables, gates and audit rows included."""

import time
from datetime import timedelta

import pyarrow as pa
import pyarrow.dataset
import pytest
from pyspark.sql import functions as F

from tests.test_sources import raw
from tests.test_stations_and_marts import INFO
from tests.test_status import NOON, at
from tests.test_status import raw as raw_status
from velolake.operators import quality
from velolake.plans.batch import AUDIT_TABLE, TESTS_TABLE, BatchRun
from velolake.plans.realtime import RealtimeRefresh
from velolake.registry.queries import daily_batch
from velolake.schemas import AUDIT, DEAD_LETTERS, RAW_STATION_INFORMATION, SCHEMA_TESTS

TRIPS = [{"ride_id": f"r{i}", "started_at": f"2026-01-0{1 + i % 3} 08:00:00", "ended_at": f"2026-01-0{1 + i % 3} 08:30:00",
          "start_station_id": "JC1", "end_station_id": f"JC{1 + i % 2}"} for i in range(6)]


def information(spark):
    rows = [tuple({**INFO, "_ingested_at": NOON, "station_id": f"g{i}", "short_name": f"JC{i}"}[n]
                  for n in RAW_STATION_INFORMATION.names) for i in (1, 2)]
    return spark.createDataFrame(rows, RAW_STATION_INFORMATION)


def audit(layers):
    return layers.read("audit", AUDIT_TABLE)


def test_batch_builds_every_table_and_can_be_rerun(spark, layers):
    for run in ("first", "second"):
        rows = BatchRun(layers, run).run(raw(spark, *TRIPS, {"ride_id": "x", "start_lat": "95"}), information(spark))
        assert rows == {
            "raw_trips": 7, "station_information": 2, "dim_date": 3, "dim_station": 2, "dim_rider_type": 2,
            "dim_bike_type": 2, "fact_trips": 6, "mart_daily_rides": 3, "mart_hourly_rides": 3, "mart_station_performance": 6,
        }
    assert layers.read("mart", "fact_trips").count() == 6
    checked = audit(layers)
    assert checked.where("status = 'FAIL'").count() == 0
    assert {(r.run_id, r.dag_id) for r in checked.collect()} == {("first", "daily_batch"), ("second", "daily_batch")}
    # 7 + 9 + 18 + 4 checks per run, each with an id of its own.
    assert checked.count() == 76 and checked.select("audit_id").distinct().count() == 76
    assert layers.newest_day("mart", "mart_daily_rides") is not None


def test_batch_needs_stations(spark, layers):
    with pytest.raises(ValueError, match="empty"):
        BatchRun(layers, "r").run(raw(spark, *TRIPS), information(spark).where("false"))


def test_batch_stops_at_the_failed_layer(spark, layers):
    with pytest.raises(quality.QualityGateError, match="STAGING.*ride_id_unique"):
        BatchRun(layers, "r").run(raw(spark, *TRIPS, {"ride_id": "r1"}), information(spark))
    # Every check of the layer was kept, and nothing was built after it.
    assert audit(layers).count() == 7 and audit(layers).where("status = 'FAIL'").count() == 1
    assert not layers.exists("mart", "dim_date")


def test_lost_trips_fail_the_gate_in_reference_mode_only(spark, layers):
    trips = raw(spark, *TRIPS, {"ride_id": "lost", "member_casual": None})
    with pytest.raises(quality.QualityGateError, match="clean_invalid_reconciliation"):
        BatchRun(layers, "r").run(trips, information(spark))
    row = audit(layers).where("check_name = 'clean_invalid_reconciliation'").first()
    assert (row.actual_value, row.message) == ("7=6+0", "clean_invalid_reconciliation: 7=6+0")
    assert BatchRun(layers, "r2", mode="complete").run(trips, information(spark))["fact_trips"] == 6


@pytest.fixture
def built(spark, layers):
    BatchRun(layers, "batch").run(raw(spark, *TRIPS), information(spark))
    return layers


def refresh(layers, minutes, **options):
    run = RealtimeRefresh(layers, NOON + timedelta(minutes=minutes), f"run-{minutes}")
    return run.run(**options)


def test_realtime_refresh_adds_what_is_new(spark, built):
    built.append(raw_status(spark, at(0), {**at(0), "station_id": "g2"}, {**at(0), "station_id": "g7"}), "raw", "station_status")
    assert refresh(built, 1) == {"fact_station_status": 2, "mart_station_live": 2}
    assert refresh(built, 2) == {"fact_station_status": 0, "mart_station_live": 2}
    built.append(raw_status(spark, {**at(5), "num_bikes_available": 9}, at(-4)), "raw", "station_status")
    assert refresh(built, 6, live="update") == {"fact_station_status": 1, "mart_station_live": 2}
    live = {row.station_code: row.num_bikes_available for row in built.read("mart", "mart_station_live").collect()}
    assert live == {"JC1": 9, "JC2": 3}
    updated = sorted(built.read("mart", "mart_station_live").collect())
    RealtimeRefresh(built, NOON).build_live()
    assert sorted(built.read("mart", "mart_station_live").collect()) == updated
    # The late snapshot is only loaded by key.
    assert refresh(built, 7, mode="by_key") == {"fact_station_status": 1, "mart_station_live": 2}


def test_window_reads_recent_snapshots_only(spark, built):
    """A faulty old snapshot stops a refresh over everything, not one over the last hour."""
    built.append(raw_status(spark, {**at(-120), "num_bikes_available": -1}, at(0)), "raw", "station_status")
    now = NOON + timedelta(minutes=1)
    with pytest.raises(ValueError, match="availability"):
        RealtimeRefresh(built, now).run()
    recent = RealtimeRefresh(built, now, window=timedelta(hours=1))
    assert recent.run() == {"fact_station_status": 1, "mart_station_live": 1}


def test_window_does_not_keep_snapshots_from_being_loaded(spark, built):
    """What arrived since the last refresh is loaded, also where the window is shorter."""
    hour = timedelta(minutes=10)
    built.append(raw_status(spark, at(-200), at(0)), "raw", "station_status")
    assert RealtimeRefresh(built, NOON + timedelta(minutes=1), window=hour).run()["fact_station_status"] == 2
    built.append(raw_status(spark, at(5), at(8), at(30)), "raw", "station_status")
    assert RealtimeRefresh(built, NOON + timedelta(minutes=31), window=hour).run(live="update")["fact_station_status"] == 3
    assert built.read("mart", "fact_station_status").count() == 5


def test_update_makes_up_for_a_refresh_that_failed(spark, built):
    """The fact was loaded, then the run stopped: the next update still brings these snapshots."""
    built.append(raw_status(spark, at(0)), "raw", "station_status")
    refresh(built, 1)
    built.append(raw_status(spark, {**at(5), "num_bikes_available": 7}, {**at(5), "station_id": "g2"}), "raw", "station_status")
    assert RealtimeRefresh(built, NOON + timedelta(minutes=6)).load_fact() == 2
    assert refresh(built, 7, live="update") == {"fact_station_status": 0, "mart_station_live": 2}
    live = {row.station_code: row.num_bikes_available for row in built.read("mart", "mart_station_live").collect()}
    assert live["JC1"] == 7 and set(live) == {"JC1", "JC2"}


def test_stale_feed_stops_the_refresh(spark, built):
    built.append(raw_status(spark, at(0)), "raw", "station_status")
    with pytest.raises(ValueError, match="stale"):
        refresh(built, 6)
    assert not built.exists("mart", "fact_station_status")


def test_many_dead_letters_warn_and_do_not_stop(spark, built):
    built.append(raw_status(spark, at(0)), "raw", "station_status")
    letters = spark.range(101).select(
        F.uuid().alias("error_id"), F.lit("x").alias("raw_payload"), F.lit("y").alias("error_reason"),
        F.lit("gbfs_station_status").alias("source"), F.lit(NOON).alias("detected_at"),
    ).select(*DEAD_LETTERS.names)
    assert RealtimeRefresh(built, NOON).check_dead_letters() == "PASS"
    built.append(letters, "raw", "station_status_dlq")
    assert refresh(built, 1)["fact_station_status"] == 1
    row = audit(built).where("check_name = 'recent_dead_letters' AND run_id = 'run-1'").first()
    assert (row.status, row.actual_value, row.expected_value) == ("WARN", "101", "<= 100")


def schema_tests(layers):
    return layers.read("audit", TESTS_TABLE)


def test_batch_publishes_its_layers_and_runs_the_schema_tests(spark, layers):
    run = BatchRun(layers, "r")
    run.run(raw(spark, *TRIPS, {"ride_id": "x", "start_lat": "95"}), information(spark))
    assert run.published == {"stg_trips": 7, "stg_station_information": 2, "int_trips_clean": 6, "int_trips_invalid": 1,
                             "int_station_information_clean": 2}
    assert [r.invalid_reason for r in layers.read("intermediate", "int_trips_invalid").collect()] == ["invalid coordinates"]
    tested = schema_tests(layers)
    # not null 3 + 6 + 6 + 13, unique 3 + 3 + 1, relationships 5, accepted values 2 + 2, no negative metric 1
    assert tested.count() == 45 and tested.where("status <> 'PASS' OR violations <> 0").count() == 0
    assert {r.layer for r in tested.collect()} == {"STAGING", "INTERMEDIATE", "WAREHOUSE", "ANALYTICS"}


def test_failures_can_be_recorded_and_the_run_goes_on(spark, layers):
    trips = raw(spark, *TRIPS, {"ride_id": "r1"}, {"ride_id": None}, {"ride_id": "lost", "member_casual": None})
    run = BatchRun(layers, "r", on_failure="record")
    assert run.run(trips, information(spark))["fact_trips"] == 7
    failed = {(r.table_name, r.check_name) for r in audit(layers).where("status = 'FAIL'").collect()}
    assert failed == {("stg_trips", "ride_id_not_null"), ("stg_trips", "ride_id_unique"), ("int_trips_clean", "ride_id_unique"),
                      ("int_trips_clean", "clean_invalid_reconciliation"), ("fact_trips", "ride_id_unique")}
    violated = {(r.test_name, r.table_name, r.column_name): r.violations for r in schema_tests(layers).where("status = 'FAIL'").collect()}
    assert violated == {("not_null", "stg_trips", "ride_id"): 1, ("not_null", "int_trips_invalid", "ride_id"): 1,
                        **{("unique", name, "ride_id"): 1 for name in ("stg_trips", "int_trips_clean", "fact_trips")}}
    with pytest.raises(ValueError, match="on_failure"):
        BatchRun(layers, "r", on_failure="ignore")


def test_schema_tests_stop_the_run_and_keep_their_results(spark, layers):
    fact = spark.sql("SELECT 'r' AS ride_id, DATE'2026-01-01' AS date_key, 'a' AS start_station_key, 'b' AS end_station_key, 1L AS rider_type_key, CAST(NULL AS bigint) AS bike_type_key")
    stations = spark.sql("SELECT 'a' AS station_key")
    found = quality.schema_tests({"fact_trips": fact}, {"dim_station": stations})
    with pytest.raises(quality.QualityGateError, match="bike_type_key not_null, fact_trips.end_station_key relationship"):
        quality.finish_schema_tests("WAREHOUSE", found, layers.name("audit", TESTS_TABLE), "r")
    # six not null, one unique, two relationships whose parent is there
    assert schema_tests(layers).count() == 9


def test_later_steps_read_published_tables_only(spark, layers):
    run = BatchRun(layers, "r")
    run.load_raw(raw(spark, *TRIPS), information(spark))
    run.build_staging()
    run.build_intermediate()
    for df in (run.staged_trips(), run.clean_trips(), run.rejected_trips()):
        assert "raw_trips" not in df._jdf.queryExecution().toString()


def test_ride_ids_of_a_table_are_counted_once(spark, layers, monkeypatch):
    def counted(of):
        def only_stations(*columns):
            assert "ride_id" not in columns
            return of(*columns)
        return only_stations

    monkeypatch.setattr(quality, "duplicates", counted(quality.duplicates))
    monkeypatch.setattr(quality, "repeated_keys", counted(quality.repeated_keys))
    trips = raw(spark, *TRIPS, {"ride_id": "r1"}, {"ride_id": None})
    BatchRun(layers, "r", on_failure="record").run(trips, information(spark))
    duplicates = {r.table_name: r.actual_value for r in audit(layers).where("check_name = 'ride_id_unique'").collect()}
    assert duplicates == {"stg_trips": "2", "int_trips_clean": "1", "fact_trips": "1"}
    repeated = schema_tests(layers).where("test_name = 'unique' AND column_name = 'ride_id'").collect()
    assert {r.table_name: r.violations for r in repeated} == {"stg_trips": 1, "int_trips_clean": 1, "fact_trips": 1}


def test_tables_hold_instants_in_microseconds(spark, layers):
    key = "spark.sql.parquet.outputTimestampType"
    before, instants = spark.conf.get(key), spark.sql("SELECT TIMESTAMP'2026-01-01 08:00:00.000001' AS t UNION ALL SELECT TIMESTAMP'1500-01-01 00:00:00'")
    layers.refresh(instants, "raw", "instants")
    files = [f.removeprefix("file:") for f in layers.read("raw", "instants").inputFiles()]
    assert pa.dataset.dataset(files).schema.field("t").type == pa.timestamp("us", "UTC")
    assert sorted(layers.read("raw", "instants").collect()) == sorted(instants.collect()) and spark.conf.get(key) == before


def test_daily_batch_derives_raw_rows_once(spark, monkeypatch):
    loaded = []

    def load_only(run, trips, stations):
        run.load_raw(trips, stations)
        run.layers.append(spark.createDataFrame([], AUDIT), "audit", AUDIT_TABLE)
        run.layers.append(spark.createDataFrame([], SCHEMA_TESTS), "audit", TESTS_TABLE)
        loaded.append(trips)
        return {"raw_trips": run.rows["raw_trips"]}

    class Given:
        raw_trips, raw_station_information = raw(spark, *TRIPS), information(spark)

    Given.spark = spark
    monkeypatch.setattr(BatchRun, "run", load_only)
    rows = daily_batch(Given)
    assert [r.result for r in rows.where("item = 'rows of raw_trips'").collect()] == ["6", "6"]
    assert loaded[0] is Given.raw_trips and "raw_trips__" in loaded[1].inputFiles()[0]
    assert sorted(loaded[1].collect(), key=str) == sorted(loaded[0].collect(), key=str)


def test_daily_batch_leaves_raw_layers_only(spark, monkeypatch):
    seen, run = [], BatchRun.run

    def watched(batch, trips, stations):
        seen.append((batch.layers.prefix, {r.namespace for r in spark.sql("SHOW DATABASES").collect()}))
        return run(batch, trips, stations)

    class Given:
        raw_trips, raw_station_information = raw(spark, *TRIPS), information(spark)

    Given.spark = spark
    monkeypatch.setattr(BatchRun, "run", watched)
    found = daily_batch(Given)
    (first, _), (second, during) = seen
    left = {r.namespace for r in spark.sql("SHOW DATABASES").collect()}
    assert {name for name in during if name.startswith(first)} == {f"{first}_raw"}
    assert {name for name in left if name.startswith((first, second))} == {f"{first}_raw", f"{second}_raw"}
    results = {(r.mode, r.item): r.result for r in found.collect()}
    assert all(results[mode, "rows of fact_trips"] and int(results[mode, "schema tests"]) == 45 for mode in ("reference", "complete"))


def test_tables_are_packed_and_shuffles_go(spark, layers):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        names = set()
        while files.hasNext():
            names.add(files.next().getName())
        return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}

    before = shuffled()
    layers.refresh(spark.range(1000).groupBy((F.col("id") % 7).alias("ride_id")).count(), "staging", "stg_trips")
    run = BatchRun(layers)
    assert run._tally(layers.read("staging", "stg_trips")).first().total == 7
    files = [f.removeprefix("file:") for f in layers.read("staging", "stg_trips").inputFiles()]
    chunk = next(g for f in files for g in pa.dataset.dataset(f).get_fragments()).metadata.row_group(0).column(0)
    assert chunk.compression == "ZSTD"
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert shuffled() <= before
