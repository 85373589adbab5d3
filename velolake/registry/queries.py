"""One named query per operator; each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.operators import dashboard, marts, quality, stations, status, trips, warehouse
from velolake.plans.batch import AUDIT_TABLE, TESTS_TABLE, BatchRun
from velolake.plans.realtime import RealtimeRefresh
from velolake.registry.sample import Sample
from velolake.schemas import DEAD_LETTERS, RAW_STATION_STATUS, RAW_TRIPS
from velolake.session import scratch_dir, stored
from velolake.sources import samples, station_feed, streams, tables, trip_files
from velolake.streaming import events, ledger, publish
from velolake.streaming import queries as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MONTH = (1996, 3)
FIRST_LOAD_BEFORE = "2024-01-15"
SNAPSHOT_DAYS = ("2024-02-01", "2024-02-02")


def query(name: str) -> Callable[[Callable[[Sample], DataFrame]], Callable[[Sample], DataFrame]]:
    def register(build: Callable[[Sample], DataFrame]) -> Callable[[Sample], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(Sample(spark, folder))
        return build

    return register


def _rows() -> Column:
    return F.count(F.lit(1))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# Sources and sinks -------------------------------------------------------------------------


@query("scan_trips_csv")
def scan_trips_csv(s: Sample) -> DataFrame:
    """Trips written as CSV and scanned back, summed up per day."""
    path = scratch_dir(s.spark, "trips_csv")
    trip_files.write_trips_csv(s.raw_trips, path)
    return _per_day(trip_files.scan_trips_csv(s.spark, path))


def _per_day(raw: DataFrame) -> DataFrame:
    hundredths = F.rint(F.col("end_lat").cast("double") * 100).cast("bigint")
    return raw.groupBy(F.to_date(F.col("ended_at").cast("timestamp")).alias("end_date")).agg(
        _rows().alias("trips"),
        F.count("ride_id").alias("ride_ids"),
        F.count("started_at").alias("starts"),
        F.count_if(F.col("rideable_type") == " Classic_Bike ").alias("untrimmed"),
        F.count("start_lat").alias("start_lats"),
        F.sum(hundredths).alias("end_lat_hundredths"),
    )


@query("scan_partitioned_trips")
def scan_partitioned_trips(s: Sample) -> DataFrame:
    path = scratch_dir(s.spark, "trips_by_day")
    trip_files.write_daily_partitions(s.raw_trips.where("started_at IS NOT NULL"), path)
    scanned = trip_files.scan_partitioned_trips(s.spark, path)
    return scanned.groupBy("year", "month", "day").agg(
        _rows().alias("trips"), F.count("ride_id").alias("ride_ids"), F.count("member_casual").alias("rider_types")
    )


def _folder_counts(written: DataFrame, pattern: str) -> DataFrame:
    """Rows per folder, by the part of the file path that matches."""
    return written.groupBy(F.regexp_extract("_metadata.file_path", pattern, 1).alias("folder")).agg(_rows().alias("trips"))


@query("write_daily_partitions")
def write_daily_partitions(s: Sample) -> DataFrame:
    path = scratch_dir(s.spark, "trips_by_day")
    trip_files.write_daily_partitions(s.raw_trips.where("started_at IS NOT NULL"), path)
    return _folder_counts(trip_files.scan_partitioned_trips(s.spark, path), "(year=[^/]*/month=[^/]*/day=[^/]*)/")


@query("replace_month")
def replace_month(s: Sample) -> DataFrame:
    """A month written with all trips, then replaced by its member trips."""
    path = scratch_dir(s.spark, "trips_by_month")
    members = s.raw_trips.where(F.trim("member_casual") == "member")
    trip_files.replace_month(s.raw_trips, path, *MONTH)
    rows, days = trip_files.replace_month(members, path, *MONTH)
    folders = _folder_counts(trip_files.scan_partitioned_trips(s.spark, path), "(year=[^/]*/month=[^/]*/day=[^/]*)/")
    return folders.select("*", F.lit(rows).cast("bigint").alias("written_rows"), F.lit(days).cast("bigint").alias("written_days"))


@query("full_refresh_load")
def full_refresh_load(s: Sample) -> DataFrame:
    """Trips loaded, then replaced by the trips with an id."""
    path = scratch_dir(s.spark, "raw_trips")
    tables.full_refresh_load(s.raw_trips, path)
    rows = tables.full_refresh_load(s.raw_trips.where("ride_id IS NOT NULL"), path)
    loaded = s.spark.read.parquet(path)
    return loaded.groupBy(F.col("rideable_type").alias("bike")).agg(_rows().alias("trips")).select(
        "*", F.lit(rows).cast("bigint").alias("loaded_rows")
    )


def _listed_methods(df: DataFrame) -> DataFrame:
    return df.withColumn("rental_methods", F.array_join("rental_methods", ","))


@query("scan_station_info_json")
def scan_station_info_json(s: Sample) -> DataFrame:
    path = scratch_dir(s.spark, "station_information")
    station_feed.write_station_snapshot(s.raw_station_information, path)
    return _listed_methods(station_feed.scan_station_info_json(s.spark, path).drop("dt"))


@query("write_station_snapshot")
def write_station_snapshot(s: Sample) -> DataFrame:
    """Snapshots of two days, the second one rerun with fewer stations."""
    path = scratch_dir(s.spark, "station_information")
    first, second = (
        s.raw_station_information.withColumn("_ingested_at", F.lit(day).cast("timestamp")) for day in SNAPSHOT_DAYS
    )
    station_feed.write_station_snapshot(first, path)
    station_feed.write_station_snapshot(second, path)
    station_feed.write_station_snapshot(second.where("capacity IS NOT NULL"), path)
    written = station_feed.scan_station_info_json(s.spark, path)
    return written.groupBy(F.regexp_extract("_metadata.file_path", "(dt=[^/]*)/", 1).alias("folder")).agg(
        _rows().alias("stations")
    )


@query("flatten_station_info")
def flatten_station_info(s: Sample) -> DataFrame:
    """Feed documents of two stations each; the second one leaves rental_methods out."""
    names = [name for name in s.raw_station_information.columns if name not in ("rental_methods", "_ingested_at")]
    twin = [F.concat("station_id", F.lit("t")).alias("station_id"), *names[1:]]
    first = F.to_json(F.struct(*names, "rental_methods"))
    second = F.to_json(F.struct(*twin))
    document = F.concat(F.lit('{"data":{"stations":['), first, F.lit(","), second, F.lit("]}}"))
    payloads = s.raw_station_information.select(document.alias("payload"))
    flat = station_feed.flatten_station_info(payloads, F.lit(samples.INGESTED_AT).cast("timestamp"))
    return _listed_methods(flat)


def _feed_documents(s: Sample) -> DataFrame:
    """Documents of two stations each; some first stations have a blank id."""
    blank = F.when(F.col("event_id") % 50 == 0, "").otherwise(F.col("station_id"))
    one = F.to_json(F.struct(blank.alias("station_id"), "num_bikes_available", "num_docks_available"))
    other = F.to_json(F.struct(F.concat("station_id", F.lit("t")).alias("station_id"), "num_ebikes_available"))
    document = F.concat(
        F.lit('{"last_updated":'), F.unix_timestamp("snapshot_timestamp").cast("string"),
        F.lit(',"data":{"stations":['), one, F.lit(","), other, F.lit("]}}"),
    )
    return s.raw_station_status.select(document.alias("payload"))


@query("fan_out_snapshot")
def fan_out_snapshot(s: Sample) -> DataFrame:
    messages = publish.fan_out_snapshot(_feed_documents(s), F.lit(samples.INGESTED_AT).cast("timestamp"))
    fields = ("station_id", "num_bikes_available", "num_ebikes_available", "num_docks_available",
              "source_last_updated", "snapshot_timestamp")
    return messages.select("key", *[F.get_json_object("value", f"$.{name}").alias(name) for name in fields])


@query("stream_publish")
def stream_publish(s: Sample) -> DataFrame:
    """Feed documents arriving as a stream, published, and the messages per station."""
    root = scratch_dir(s.spark, "publish")
    _feed_documents(s).write.text(f"{root}/documents")
    documents = streams.message_files(s.spark, f"{root}/documents").toDF("payload")
    streaming.stream_publish(documents, f"{root}/messages", f"{root}/checkpoint", period=None).awaitTermination()
    messages = s.spark.read.text(f"{root}/messages")
    field = {name: F.get_json_object("value", f"$.{name}") for name in ("station_id", "num_ebikes_available")}
    return messages.groupBy(field["station_id"].alias("station_id")).agg(
        _rows().alias("messages"), F.sum(field["num_ebikes_available"].cast("bigint")).alias("ebikes")
    )


@query("write_day_partitions")
def write_day_partitions(s: Sample) -> DataFrame:
    """The status fact written by day, read back per folder."""
    path = scratch_dir(s.spark, "fact_station_status")
    s.fact_station_status.hint("rebalance", "snapshot_date").write.partitionBy("snapshot_date").parquet(path)
    return s.spark.read.parquet(path).groupBy("snapshot_date").agg(
        _rows().alias("snapshots"), F.sum("available_capacity").alias("available_capacity")
    )


# Staging and intermediate ------------------------------------------------------------------


@query("stg_trips")
def stg_trips(s: Sample) -> DataFrame:
    return s.stg_trips


@query("stg_station_information")
def stg_station_information(s: Sample) -> DataFrame:
    return _listed_methods(s.stg_station_information)


@query("stg_station_status")
def stg_station_status(s: Sample) -> DataFrame:
    return s.stg_station_status


@query("filter_period")
def filter_period(s: Sample) -> DataFrame:
    return trip_files.filter_period(s.raw_trips, *MONTH).select(
        "ride_id", "started_at", F.col("ended_at").cast("timestamp").alias("ended_at"), "end_station_id"
    )


@query("partition_day_count")
def partition_day_count(s: Sample) -> DataFrame:
    return trip_files.partition_day_count(s.raw_trips)


@query("int_trips_clean")
def int_trips_clean(s: Sample) -> DataFrame:
    return s.int_trips_clean


@query("int_trips_invalid")
def int_trips_invalid(s: Sample) -> DataFrame:
    return s.int_trips_invalid()


@query("int_trips_invalid_complete")
def int_trips_invalid_complete(s: Sample) -> DataFrame:
    return s.int_trips_invalid("complete")


@query("reject_reason_counts")
def reject_reason_counts(s: Sample) -> DataFrame:
    return trips.reject_reason_counts(s.int_trips_invalid())


@query("time_of_day_counts")
def time_of_day_counts(s: Sample) -> DataFrame:
    return trips.time_of_day_counts(s.int_trips_clean)


@query("dedupe_trips")
def dedupe_trips(s: Sample) -> DataFrame:
    """Trips of which several share an id: here the id is the order's."""
    order_id = F.split_part(F.col("ride_id"), F.lit("-"), F.lit(1))
    return trips.dedupe_trips(s.int_trips_clean.select(
        order_id.alias("ride_id"), "started_at", "ended_at", "start_station_id", "end_station_id", "member_casual"
    ))


@query("int_station_information_clean")
def int_station_information_clean(s: Sample) -> DataFrame:
    return _listed_methods(s.int_station_information)


@query("int_station_status")
def int_station_status(s: Sample) -> DataFrame:
    return s.int_station_status


@query("station_observations")
def station_observations(s: Sample) -> DataFrame:
    seen = stations.station_observations(s.int_trips_clean)
    return seen.groupBy("station_code", "station_name", "latitude", "longitude").agg(_rows().alias("trip_ends"))


# Warehouse and marts -----------------------------------------------------------------------


@query("dim_date")
def dim_date(s: Sample) -> DataFrame:
    return warehouse.dim_date(s.int_trips_clean)


@query("dim_station")
def dim_station(s: Sample) -> DataFrame:
    return _listed_methods(s.dim_station)


@query("dim_rider_type")
def dim_rider_type(s: Sample) -> DataFrame:
    """The dimension with the number of clean trips of each type."""
    used = s.int_trips_clean.groupBy(F.col("member_casual").alias("rider_type")).agg(_rows().alias("trips"))
    return s.dim_rider_type.join(used, "rider_type", "left")


@query("dim_bike_type")
def dim_bike_type(s: Sample) -> DataFrame:
    used = s.int_trips_clean.groupBy(F.col("rideable_type").alias("bike_type")).agg(_rows().alias("trips"))
    return s.dim_bike_type.join(used, "bike_type", "left")


@query("fact_trips")
def fact_trips(s: Sample) -> DataFrame:
    return s.fact_trips


@query("mart_daily_rides")
def mart_daily_rides(s: Sample) -> DataFrame:
    return s.mart_daily_rides()


@query("mart_hourly_rides")
def mart_hourly_rides(s: Sample) -> DataFrame:
    return s.mart_hourly_rides()


@query("station_departures")
def station_departures(s: Sample) -> DataFrame:
    return marts.station_departures(s.fact_trips)


@query("station_arrivals")
def station_arrivals(s: Sample) -> DataFrame:
    return marts.station_arrivals(s.fact_trips)


@query("station_date_spine")
def station_date_spine(s: Sample) -> DataFrame:
    return marts.station_date_spine(s.fact_trips)


@query("mart_station_performance")
def mart_station_performance(s: Sample) -> DataFrame:
    return s.mart_station_performance()


@query("fact_station_status")
def fact_station_status(s: Sample) -> DataFrame:
    return s.fact_station_status


def _load(s: Sample, path: str, number: int, rows: DataFrame) -> DataFrame:
    """Add one load to a status fact at `path` and return the fact."""
    balanced = rows.hint("rebalance", "snapshot_date")
    balanced.write.mode("overwrite").partitionBy("snapshot_date").parquet(f"{path}/load={number}")
    return s.spark.read.schema(rows.schema).option("basePath", path).parquet(path)


@query("fact_station_status_incremental")
def fact_station_status_incremental(s: Sample) -> DataFrame:
    """Three loads by watermark: the first days, everything newer, and nothing new."""
    path = scratch_dir(s.spark, "status_loads")
    early = s.int_station_status.where(F.col("snapshot_timestamp") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp"))
    loaded = _load(s, path, 1, status.fact_station_status(early, s.dim_station))
    for number in (2, 3):
        loaded = _load(s, path, number, status.increment(s.int_station_status, s.dim_station, loaded))
    by_load = s.spark.read.option("basePath", path).parquet(path)
    return by_load.groupBy(F.col("load").cast("bigint").alias("load"), "snapshot_date").agg(
        _rows().alias("snapshots"), F.sum("available_capacity").alias("available_capacity")
    )


@query("fact_station_status_merge")
def fact_station_status_merge(s: Sample) -> DataFrame:
    """The first days are loaded; all later snapshots and corrections of the renting ones are merged in."""
    layers = _layers(s, "fact_station_status")
    first = F.col("snapshot_timestamp") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp")
    layers.refresh(s.fact_station_status.where(first), "mart", "fact_station_status")
    corrected = (F.col("available_capacity") + F.when(first, 1).otherwise(0)).alias("available_capacity")
    again = s.fact_station_status.where(~first | F.col("is_renting"))
    changes = again.select(*(corrected if c == "available_capacity" else c for c in again.columns))
    layers.merge(status.newest_of_each(changes), "mart", "fact_station_status", status.STATUS_KEY)
    return layers.read("mart", "fact_station_status").groupBy("snapshot_date").agg(
        _rows().alias("snapshots"), F.sum("available_capacity").alias("available_capacity")
    )


def _late_sample(s: Sample) -> DataFrame:
    """A first load that lacks its "view" snapshots, which arrive late."""
    path = scratch_dir(s.spark, "status_loads")
    on_time = s.int_station_status.where(
        (F.col("snapshot_timestamp") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp")) & F.col("is_renting")
    )
    return _load(s, path, 1, status.fact_station_status(on_time, s.dim_station))


@query("late_rows_dropped")
def late_rows_dropped(s: Sample) -> DataFrame:
    late = status.late_rows(s.int_station_status, s.dim_station, _late_sample(s))
    return late.groupBy("snapshot_date").agg(_rows().alias("late_rows"))


@query("late_rows_by_key")
def late_rows_by_key(s: Sample) -> DataFrame:
    added = status.increment(s.int_station_status, s.dim_station, _late_sample(s), mode="by_key")
    return added.groupBy("snapshot_date").agg(_rows().alias("added_rows"))


@query("mart_station_live")
def mart_station_live(s: Sample) -> DataFrame:
    return s.mart_station_live


# Dashboard ---------------------------------------------------------------------------------


@query("dashboard_kpis")
def dashboard_kpis(s: Sample) -> DataFrame:
    return dashboard.kpis(s.fact_trips, s.dim_rider_type)


@query("dashboard_daily_trend")
def dashboard_daily_trend(s: Sample) -> DataFrame:
    return dashboard.daily_trend(s.mart_daily_rides())


@query("dashboard_rides_by_hour")
def dashboard_rides_by_hour(s: Sample) -> DataFrame:
    return dashboard.rides_by_hour(s.mart_hourly_rides())


@query("dashboard_top_stations")
def dashboard_top_stations(s: Sample) -> DataFrame:
    return dashboard.top_stations(s.mart_station_performance())


@query("dashboard_filtered_daily")
def dashboard_filtered_daily(s: Sample) -> DataFrame:
    return dashboard.filtered(s.mart_daily_rides(), "1996-01-01", "1997-06-30", ["member"], ["classic_bike"])


@query("dashboard_live_totals")
def dashboard_live_totals(s: Sample) -> DataFrame:
    return dashboard.live_totals(s.mart_station_live)


# Quality -----------------------------------------------------------------------------------


@query("dq_stg_trips")
def dq_stg_trips(s: Sample) -> DataFrame:
    return quality.check_staged_trips(s.stg_trips)


@query("dq_stg_station_information")
def dq_stg_station_information(s: Sample) -> DataFrame:
    return quality.check_staged_station_information(s.stg_station_information)


@query("dq_int_trips")
def dq_int_trips(s: Sample) -> DataFrame:
    return quality.check_split_trips(s.stg_trips, s.int_trips_clean, s.int_trips_invalid())


@query("dq_int_trips_complete")
def dq_int_trips_complete(s: Sample) -> DataFrame:
    return quality.check_split_trips(s.stg_trips, s.int_trips_clean, s.int_trips_invalid("complete"))


@query("dq_int_station_information")
def dq_int_station_information(s: Sample) -> DataFrame:
    return quality.check_station_information(s.int_station_information)


@query("dq_dimensions")
def dq_dimensions(s: Sample) -> DataFrame:
    keys = {"dim_date": "date_key", "dim_station": "station_key",
            "dim_rider_type": "rider_type_key", "dim_bike_type": "bike_type_key"}
    return _union([quality.check_dimension(s.dimensions[name], name, key) for name, key in keys.items()])


@query("dq_dim_date")
def dq_dim_date(s: Sample) -> DataFrame:
    return quality.check_dimension(s.dim_date, "dim_date", "date_key")


@query("dq_dim_station")
def dq_dim_station(s: Sample) -> DataFrame:
    return quality.check_dimension(s.dim_station, "dim_station", "station_key")


def _with_trips(checked: DataFrame, s: Sample) -> DataFrame:
    """The checks of a literal dimension, with the number of trips that it describes."""
    return checked.withColumn("clean_trips", F.lit(s.int_trips_clean.count()).cast("bigint"))


@query("dq_dim_rider_type")
def dq_dim_rider_type(s: Sample) -> DataFrame:
    return _with_trips(quality.check_dimension(s.dim_rider_type, "dim_rider_type", "rider_type_key"), s)


@query("dq_dim_bike_type")
def dq_dim_bike_type(s: Sample) -> DataFrame:
    return _with_trips(quality.check_dimension(s.dim_bike_type, "dim_bike_type", "bike_type_key"), s)


@query("dq_fact_trips")
def dq_fact_trips(s: Sample) -> DataFrame:
    return quality.check_fact_trips(s.stored_fact_trips, s.stored_trips, s.dimensions)


@query("dq_analytics")
def dq_analytics(s: Sample) -> DataFrame:
    fact = s.stored_fact_trips
    return quality.check_marts(fact, s.mart_daily_rides(fact), s.mart_hourly_rides(fact), s.mart_station_performance(fact))


def _now_after(s: Sample, minutes: int, seconds: int = 0) -> Column:
    """The newest snapshot plus some time, as a value."""
    newest = s.raw_station_status.agg(F.max("snapshot_timestamp")).first()[0]
    return F.lit(newest).cast("timestamp") + F.make_dt_interval(mins=F.lit(minutes), secs=F.lit(seconds))


@query("dq_raw_status")
def dq_raw_status(s: Sample) -> DataFrame:
    measures = quality.raw_status_measures(s.raw_station_status, _now_after(s, 4))
    return measures.withColumn("failure", quality.raw_status_failure())


@query("dq_stg_status")
def dq_stg_status(s: Sample) -> DataFrame:
    return quality.check_staged_status(s.stg_station_status)


@query("dq_int_status")
def dq_int_status(s: Sample) -> DataFrame:
    return quality.check_clean_status(s.int_station_status)


@query("dq_fact_station_status")
def dq_fact_station_status(s: Sample) -> DataFrame:
    return quality.check_status_fact(s.fact_station_status, unique=True)


@query("dq_station_live")
def dq_station_live(s: Sample) -> DataFrame:
    return quality.check_station_live(s.mart_station_live)


@query("check_freshness")
def check_freshness(s: Sample) -> DataFrame:
    """Freshness 4 minutes, just under 6 minutes and 6 minutes after the newest snapshot."""
    moments = {"4m": (4, 0), "5m59s": (5, 59), "6m": (6, 0)}
    return _union([
        quality.check_freshness(s.raw_station_status, _now_after(s, *after)).withColumn("checked_after", F.lit(name))
        for name, after in moments.items()
    ])


@query("check_trips_business_rules")
def check_trips_business_rules(s: Sample) -> DataFrame:
    """Trips out of rules before and after the clean-up."""
    return _union([
        quality.measure(df, trips=quality.rows(), out_of_rules=quality.count_where(quality.trips_out_of_rules()))
        .withColumn("table_name", F.lit(name))
        for name, df in (("stg_trips", s.stg_trips), ("int_trips_clean", s.int_trips_clean))
    ])


@query("check_fact_foreign_keys")
def check_fact_foreign_keys(s: Sample) -> DataFrame:
    """Facts without a parent, against all stations and against the stations of the feed only."""
    feed_only = {**s.dimensions, "dim_station": s.dim_station.where("gbfs_station_id IS NOT NULL")}
    return _union([
        quality.measure(quality.orphan_facts(s.stored_fact_trips, dims), orphans=quality.rows())
        .withColumn("stations", F.lit(name))
        for name, dims in (("all", s.dimensions), ("feed", feed_only))
    ])


@query("check_status_duplicate_events")
def check_status_duplicate_events(s: Sample) -> DataFrame:
    return quality.measure(s.fact_station_status, duplicate_event=quality.duplicates("station_key", "snapshot_timestamp"))


@query("check_non_negative_metrics")
def check_non_negative_metrics(s: Sample) -> DataFrame:
    return quality.negative_metrics(s.mart_daily_rides())


def _tables(s: Sample) -> dict[str, Callable[[], DataFrame]]:
    return {
        "stg_trips": lambda: s.stg_trips,
        "stg_station_information": lambda: s.stg_station_information,
        "stg_station_status": lambda: s.stg_station_status,
        "int_trips_clean": lambda: s.stored_trips,
        "int_trips_invalid": lambda: s.int_trips_invalid(),
        "int_station_information_clean": lambda: s.int_station_information,
        "int_station_status": lambda: s.int_station_status,
        "dim_date": lambda: s.dim_date,
        "dim_station": lambda: s.dim_station,
        "dim_rider_type": lambda: s.dim_rider_type,
        "dim_bike_type": lambda: s.dim_bike_type,
        "fact_trips": lambda: s.stored_fact_trips,
        "fact_station_status": lambda: s.fact_station_status,
        "mart_daily_rides": lambda: s.mart_daily_rides(s.stored_fact_trips),
        "mart_hourly_rides": lambda: s.mart_hourly_rides(s.stored_fact_trips),
        "mart_station_performance": lambda: s.mart_station_performance(s.stored_fact_trips),
        "mart_station_live": lambda: s.mart_station_live,
    }


@query("check_not_null")
def check_not_null(s: Sample) -> DataFrame:
    return _union([
        quality.not_null_violations(_tables(s)[table](), table, columns)
        for table, columns in quality.NOT_NULL_COLUMNS.items()
    ])


@query("check_unique")
def check_unique(s: Sample) -> DataFrame:
    """Repeated keys, and rows with one, per column that must be unique."""
    return _union([
        quality.repeated_keys(_tables(s)[table](), column)
        .agg(_rows().alias("repeated_keys"), F.coalesce(F.sum("occurrences"), F.lit(0)).alias("repeated_rows"))
        .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "repeated_keys", "repeated_rows")
        for table, columns in quality.UNIQUE_COLUMNS.items() for column in columns
    ])


@query("check_relationship")
def check_relationship(s: Sample) -> DataFrame:
    """Keys without a parent, and their rows, per relationship."""
    return _union([
        quality.orphan_rows(_tables(s)[child](), column, _tables(s)[parent](), parent_column)
        .agg(_rows().alias("orphan_keys"), F.coalesce(F.sum("occurrences"), F.lit(0)).alias("orphan_rows"))
        .select(F.lit(child).alias("table_name"), F.lit(column).alias("column_name"), "orphan_keys", "orphan_rows")
        for child, column, parent, parent_column in quality.RELATIONSHIPS
    ])


@query("check_accepted_values")
def check_accepted_values(s: Sample) -> DataFrame:
    """The clean tables, and the staged trips, which still have other values."""
    accepted = {**quality.ACCEPTED_VALUES, "stg_trips": quality.ACCEPTED_VALUES["int_trips_clean"]}
    return _union([
        quality.accepted_value_violations(_tables(s)[table](), table, values) for table, values in accepted.items()
    ])


def _register_column_tests() -> None:
    def duplicates(table: str, column: str) -> Callable[[Sample], DataFrame]:
        return lambda s: quality.measure(
            _tables(s)[table](), total=quality.rows(), duplicates=quality.duplicates(column)
        )

    def repeated(table: str, column: str) -> Callable[[Sample], DataFrame]:
        return lambda s: quality.repeated_keys(_tables(s)[table](), column)

    def orphans(child: str, column: str, parent: str, parent_column: str) -> Callable[[Sample], DataFrame]:
        def build(s: Sample) -> DataFrame:
            found = quality.orphan_rows(_tables(s)[child](), column, _tables(s)[parent](), parent_column)
            return found.agg(_rows().alias("orphan_keys"), F.coalesce(F.sum("occurrences"), F.lit(0)).alias("orphan_rows"))

        return build

    for table, columns in quality.UNIQUE_COLUMNS.items():
        for column in columns:
            query(f"check_{table}_{column}_unique")(duplicates(table, column))
            query(f"check_{table}_{column}_unique_test")(repeated(table, column))
    for child, column, parent, parent_column in quality.RELATIONSHIPS:
        query(f"check_relationship_{child}_{column}")(orphans(child, column, parent, parent_column))


_register_column_tests()


@query("check_reconciliation_staging")
def check_reconciliation_staging(s: Sample) -> DataFrame:
    return quality.merge_measures(
        quality.measure(s.stg_trips, staged_rows=quality.rows()),
        quality.measure(s.int_trips_clean, clean_rows=quality.rows()),
        quality.measure(s.int_trips_invalid(), rejected_rows=quality.rows()),
    )


@query("check_reconciliation_fact")
def check_reconciliation_fact(s: Sample) -> DataFrame:
    return quality.merge_measures(
        quality.measure(s.stored_trips, clean_rows=quality.rows()),
        quality.measure(s.fact_trips, fact_rows=quality.rows()),
    )


@query("check_reconciliation_marts")
def check_reconciliation_marts(s: Sample) -> DataFrame:
    fact = s.stored_fact_trips
    return quality.merge_measures(
        quality.measure(fact, fact_rows=quality.rows()),
        quality.measure(s.mart_daily_rides(fact), daily_rides=F.sum("total_rides")),
        quality.measure(s.mart_hourly_rides(fact), hourly_rides=F.sum("total_rides")),
        quality.measure(
            s.mart_station_performance(fact), departures=F.sum("total_departures"), arrivals=F.sum("total_arrivals")
        ),
    )


@query("audit_rows")
def audit_rows(s: Sample) -> DataFrame:
    """Two runs of the staging checks appended to an audit table, without ids and times."""
    path = scratch_dir(s.spark, "audit")
    checked = quality.check_staged_trips(s.stg_trips).unionByName(
        quality.check_staged_station_information(s.stg_station_information)
    )
    for run in ("run-1", "run-2"):
        quality.audit_rows(checked, run, "daily").write.mode("append").parquet(path)
    return s.spark.read.parquet(path).drop("audit_id", "checked_at")


# Events and streams ------------------------------------------------------------------------


def _validated(s: Sample) -> DataFrame:
    return events.validate_events(s.status_events, "event_id", detected_at=F.col("arrived_at"))


@query("validate_events_batch")
def validate_events_batch(s: Sample) -> DataFrame:
    """Every event with its reason; the columns of a rejected event are blanked."""
    columns = [name for name in RAW_STATION_STATUS.names if name != "_ingested_at"]
    valid = F.col("error_reason").isNull()
    return _validated(s).select("event_id", "error_reason", *[F.when(valid, F.col(name)).alias(name) for name in columns])


@query("recent_dlq_count")
def recent_dlq_count(s: Sample) -> DataFrame:
    """Dead letters in the 5 minutes and in the 20 days before the newest one."""
    letters = events.dead_letters(_validated(s))
    newest = F.lit(letters.agg(F.max("detected_at")).first()[0]).cast("timestamp")
    return _union([
        quality.recent_dead_letters(letters, newest, minutes).withColumn("trailing_minutes", F.lit(minutes).cast("bigint"))
        for minutes in (5, 20 * 24 * 60)
    ])


@query("dlq_window_counts")
def dlq_window_counts(s: Sample) -> DataFrame:
    return streaming.dead_letter_windows(events.dead_letters(_validated(s)))


@query("generate_invalid_events")
def generate_invalid_events(s: Sample) -> DataFrame:
    """One faulty event per given event, validated again, counted by reason."""
    numbers = s.raw_station_status.select((F.col("event_id") + 1).alias("n"), "snapshot_timestamp")
    messages = publish.invalid_events(numbers, F.col("snapshot_timestamp"))
    return events.validate_events(messages).groupBy("error_reason").agg(_rows().alias("events"))


def _message_folder(s: Sample) -> str:
    """The event texts as files, in a folder for a file stream."""
    path = scratch_dir(s.spark, "messages")
    s.status_events.select("value").write.text(path)
    return path


def _split(s: Sample) -> tuple[DataFrame, DataFrame]:
    """Run the streaming split over all events; the valid events and the dead letters it wrote."""
    root = scratch_dir(s.spark, "split")
    messages = streams.message_files(s.spark, _message_folder(s))
    running = streaming.stream_split(messages, f"{root}/valid", f"{root}/dead", f"{root}/checkpoint", period=None)
    running.awaitTermination()
    return s.spark.read.parquet(f"{root}/valid"), s.spark.read.parquet(f"{root}/dead")


@query("stream_source")
def stream_source(s: Sample) -> DataFrame:
    """Messages read as a stream and written as they are."""
    root = scratch_dir(s.spark, "source")
    messages = streams.message_files(s.spark, _message_folder(s))
    writer = messages.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start(f"{root}/messages").awaitTermination()
    return s.spark.read.parquet(f"{root}/messages").agg(
        _rows().alias("messages"), F.count_if(F.col("value").contains('"station_id":""')).alias("blank_ids")
    )


@query("stream_validate")
def stream_validate(s: Sample) -> DataFrame:
    """Valid events of a stream written by the file sink."""
    root = scratch_dir(s.spark, "valid")
    valid = streaming.stream_valid_events(streams.message_files(s.spark, _message_folder(s)))
    writer = valid.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start(f"{root}/events").awaitTermination()
    return s.spark.read.parquet(f"{root}/events").drop("_ingested_at")


@query("stream_split")
def stream_split(s: Sample) -> DataFrame:
    """Events per outcome after the streaming split."""
    valid, dead = _split(s)
    return dead.select("error_reason").unionByName(valid.select(F.lit("valid").alias("error_reason"))).groupBy(
        F.col("error_reason").alias("outcome")
    ).agg(_rows().alias("events"))


@query("stream_valid_sink")
def stream_valid_sink(s: Sample) -> DataFrame:
    return _split(s)[0].drop("_ingested_at", "batch_id")


@query("stream_dlq_sink")
def stream_dlq_sink(s: Sample) -> DataFrame:
    """Dead letters per reason; texts without a closing brace were cut in half."""
    return _split(s)[1].groupBy("error_reason", "source").agg(
        _rows().alias("dead_letters"),
        F.count_distinct("error_id").alias("error_ids"),
        F.count_if(~F.col("raw_payload").endswith("}")).alias("cut_payloads"),
    )


@query("stream_station_live")
def stream_station_live(s: Sample) -> DataFrame:
    root = scratch_dir(s.spark, "live")
    valid = streaming.stream_valid_events(streams.message_files(s.spark, _message_folder(s), files_per_batch=4))
    streaming.stream_station_live(valid, f"{root}/changes", f"{root}/checkpoint", period=None).awaitTermination()
    return streaming.station_live_table(s.spark.read.parquet(f"{root}/changes")).drop("_ingested_at")


@query("stream_status_fact")
def stream_status_fact(s: Sample) -> DataFrame:
    """Snapshots streamed twice over into the fact, which keeps each one once."""
    root = scratch_dir(s.spark, "status_fact")
    arrived = s.int_station_status.unionByName(s.int_station_status)
    arrived.write.parquet(f"{root}/status")
    arriving = s.spark.readStream.schema(s.int_station_status.schema).parquet(f"{root}/status")
    running = streaming.stream_status_fact(arriving, s.dim_station, f"{root}/fact", f"{root}/checkpoint", period=None)
    running.awaitTermination()
    return s.spark.read.parquet(f"{root}/fact").groupBy("snapshot_date").agg(
        _rows().alias("snapshots"), F.sum("available_capacity").alias("available_capacity")
    )


# Whole runs --------------------------------------------------------------------------------


def _layers(s: Sample, *day_tables: str) -> tables.Layers:
    """Databases of their own below the shared folder, with these tables split by day."""
    name = f"velolake_{uuid.uuid4().hex[:12]}"
    days = {table: tables.DAY_COLUMNS[table] for table in day_tables}
    return tables.Layers(s.spark, scratch_dir(s.spark, "layers"), name, days).create()


def _written(s: Sample, rows: list[tuple[str, int]]) -> DataFrame:
    return s.spark.createDataFrame(rows, "table_name string, rows bigint")


@query("daily_batch")
def daily_batch(s: Sample) -> DataFrame:
    """The daily batch over all raw trips in both modes, failures recorded: rows per table, and what gates and schema tests found.

    The given trips are few per day, so the trip tables stay whole here. Raw rows are derived from the
    given tables once: the second batch loads those of the first one's raw layer. What is found in a batch
    is stored with its end, and then its layers above the raw one are dropped.
    """
    parts, raw = [], (s.raw_trips, s.raw_station_information)
    for mode in ("reference", "complete"):
        layers = _layers(s)
        run = BatchRun(layers, run_id="batch", mode=mode, on_failure="record")
        written = run.run(*raw) | run.published
        raw = layers.read("raw", "raw_trips"), layers.read("raw", "station_information")
        checks, tests = layers.read("audit", AUDIT_TABLE), layers.read("audit", TESTS_TABLE)
        failed = F.col("status") == "FAIL"
        found = [part.select(F.lit(mode).alias("mode"), "item", "result") for part in (
            _written(s, list(written.items())).select(F.concat(F.lit("rows of "), "table_name").alias("item"), F.col("rows").cast("string").alias("result")),
            checks.where(failed).select(F.concat(F.lit("FAIL "), "table_name", F.lit("."), "check_name").alias("item"), F.col("actual_value").alias("result")),
            tests.where(failed).select(F.concat(F.lit("FAIL "), "test_name", F.lit(" "), "table_name", F.lit("."), "column_name").alias("item"),
                                       F.col("violations").cast("string").alias("result")),
            checks.agg(F.lit("audited checks").alias("item"), _rows().cast("string").alias("result")),
            tests.agg(F.lit("schema tests").alias("item"), _rows().cast("string").alias("result")),
        )]
        parts.append(stored(_union(found), f"found-{mode}"))
        layers.drop(*(layer for layer in tables.LAYERS if layer != "raw"))
    return _union(parts)


def _streamed_to_raw(s: Sample, layers: tables.Layers) -> None:
    """All event texts through the stream into the raw layer, in several batches."""
    checkpoint = scratch_dir(s.spark, "to_raw")
    path = _message_folder(s)
    for _ in range(2):  # the second start finds nothing new
        messages = streams.message_files(s.spark, path, files_per_batch=4)
        ledger.stream_to_raw(messages, layers, checkpoint, period=None).awaitTermination()


@query("stream_to_raw")
def stream_to_raw(s: Sample) -> DataFrame:
    """Events per raw table and outcome after the exactly-once stream, with the rows that its ledger counted."""
    layers = _layers(s)
    _streamed_to_raw(s, layers)
    valid = ledger.committed(layers, "station_status", RAW_STATION_STATUS).select(F.lit("station_status").alias("sink"), F.lit("valid").alias("outcome"))
    dead = ledger.committed(layers, "station_status_dlq", DEAD_LETTERS).select(F.lit("station_status_dlq").alias("sink"), F.col("error_reason").alias("outcome"))
    counted = ledger.status_ledger(layers).entries().groupBy("sink").agg(F.sum("rows").alias("ledger_rows"))
    return valid.unionByName(dead).groupBy("sink", "outcome").agg(_rows().alias("events")).join(counted, "sink").select(F.col("sink").alias("table_name"), "outcome", "events", "ledger_rows")


@query("realtime_from_stream")
def realtime_from_stream(s: Sample) -> DataFrame:
    """A refresh over what the stream wrote from all event texts: rows per table, and the audit row of the dead letters."""
    layers = _layers(s, "fact_station_status")
    layers.refresh(s.dim_station, "mart", "dim_station")
    _streamed_to_raw(s, layers)
    newest = layers.read("raw", "station_status").agg(F.max(F.unix_micros("snapshot_timestamp"))).first()[0]
    now = status.EPOCH + timedelta(microseconds=newest) + timedelta(minutes=1)
    written = RealtimeRefresh(layers, now, "from-stream").run()
    audited = layers.read("audit", AUDIT_TABLE).where("check_name = 'recent_dead_letters'").select(
        F.concat(F.lit("dead letters "), "status").alias("table_name"), F.col("actual_value").cast("bigint").alias("rows"))
    return _written(s, list(written.items())).unionByName(audited)


@query("realtime_refresh")
def realtime_refresh(s: Sample) -> DataFrame:
    """Three refreshes over valid events: the first days, the rest by update, and nothing new."""
    layers = _layers(s, "fact_station_status")
    layers.refresh(s.dim_station, "mart", "dim_station")
    valid = stored(events.valid_events(_validated(s)), "valid_events")
    early = F.col("snapshot_timestamp") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp")
    counts = []
    for number, arrived in enumerate((valid.where(early), valid.where(~early), valid.where("false")), start=1):
        layers.append(arrived, "raw", "station_status")
        newest = layers.read("raw", "station_status").agg(F.max(F.unix_micros("snapshot_timestamp"))).first()[0]
        now = status.EPOCH + timedelta(microseconds=newest) + timedelta(minutes=1)
        written = RealtimeRefresh(layers, now, f"refresh-{number}").run(live="update")
        counts += [(f"{table}_{number}", rows) for table, rows in written.items()]
    return _written(s, counts)
