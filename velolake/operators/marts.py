"""Marts over the trip fact and the station-status fact.

Trip marts aggregate the fact on its own keys first and join dimension attributes to the
groups, so the joins see groups, not trips. The last grouping merges groups whose keys
share the same attributes, as grouping after the join would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velolake.functions import mean_from_hundredths, to_hundredths


def ride_totals(fact: DataFrame, *keys: str) -> DataFrame:
    """Rides, and sums and counts of both metrics in hundredths, per key."""
    return fact.select(
        *keys,
        to_hundredths(F.col("ride_duration_minutes")).alias("minutes"),
        to_hundredths(F.col("trip_distance_km")).alias("km"),
    ).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rides"),
        F.sum("minutes").alias("minutes_sum"),
        F.count("minutes").alias("minutes_n"),
        F.sum("km").alias("km_sum"),
        F.count("km").alias("km_n"),
    )


def _rides_mart(groups: DataFrame, *keys: str) -> DataFrame:
    total = {name: F.sum(name) for name in ("rides", "minutes_sum", "minutes_n", "km_sum", "km_n")}
    return groups.groupBy(*keys).agg(
        total["rides"].alias("total_rides"),
        mean_from_hundredths(total["minutes_sum"], total["minutes_n"]).alias("avg_ride_duration_minutes"),
        mean_from_hundredths(total["km_sum"], total["km_n"]).alias("avg_trip_distance_km"),
    )


def hourly_totals(fact: DataFrame) -> DataFrame:
    """The finest groups of both ride marts; stored once, they save a scan of the fact."""
    return ride_totals(fact, "date_key", "ride_hour", "rider_type_key", "bike_type_key")


def daily_from_totals(totals: DataFrame, dates: DataFrame, riders: DataFrame, bikes: DataFrame) -> DataFrame:
    """The daily mart from totals whose keys include date, rider and bike."""
    days = dates.select("date_key", "day_name", "is_weekend")
    groups = _with_types(totals, riders, bikes).join(days, "date_key").withColumnRenamed("date_key", "ride_date")
    return _rides_mart(groups, "ride_date", "day_name", "is_weekend", "rider_type", "bike_type")


def hourly_from_totals(totals: DataFrame, riders: DataFrame, bikes: DataFrame) -> DataFrame:
    groups = _with_types(totals, riders, bikes).withColumnRenamed("date_key", "ride_date")
    return _rides_mart(groups, "ride_date", "ride_hour", "rider_type", "bike_type")


def _with_types(totals: DataFrame, riders: DataFrame, bikes: DataFrame) -> DataFrame:
    """Names of the two literal dimensions, which have two rows each."""
    return totals.join(F.broadcast(riders), "rider_type_key").join(F.broadcast(bikes), "bike_type_key")


def mart_daily_rides(fact: DataFrame, dates: DataFrame, riders: DataFrame, bikes: DataFrame) -> DataFrame:
    return daily_from_totals(ride_totals(fact, "date_key", "rider_type_key", "bike_type_key"), dates, riders, bikes)


def mart_hourly_rides(fact: DataFrame, riders: DataFrame, bikes: DataFrame) -> DataFrame:
    return hourly_from_totals(hourly_totals(fact), riders, bikes)


def station_departures(fact: DataFrame) -> DataFrame:
    return _station_trips(fact, "start_station_key", "total_departures")


def station_arrivals(fact: DataFrame) -> DataFrame:
    return _station_trips(fact, "end_station_key", "total_arrivals")


def _station_trips(fact: DataFrame, key: str, name: str) -> DataFrame:
    known = fact.where(F.col(key).isNotNull())
    return known.groupBy(F.col("date_key").alias("ride_date"), F.col(key).alias("station_key")).agg(
        F.count(F.lit(1)).alias(name)
    )


def station_date_spine(fact: DataFrame) -> DataFrame:
    """Every (date, station) with a departure or an arrival."""
    return station_activity(fact).select("ride_date", "station_key")


def station_activity(fact: DataFrame) -> DataFrame:
    """Departures and arrivals per (date, station), from one scan and one shuffle.

    Each trip yields a departure row and an arrival row; the sums combine on the map
    side, so a station with very many trips costs one row per task in the shuffle.
    """

    def end(key: str, departures: int, arrivals: int) -> Column:
        return F.struct(
            F.col(key).alias("station_key"),
            F.lit(departures).cast("bigint").alias("departures"),
            F.lit(arrivals).cast("bigint").alias("arrivals"),
        )

    ends = F.array(end("start_station_key", 1, 0), end("end_station_key", 0, 1))
    return (
        fact.select(F.col("date_key").alias("ride_date"), F.inline(ends))
        .where(F.col("station_key").isNotNull())
        .groupBy("ride_date", "station_key")
        .agg(F.sum("departures").alias("total_departures"), F.sum("arrivals").alias("total_arrivals"))
    )


def mart_station_performance(fact: DataFrame, stations: DataFrame) -> DataFrame:
    """Activity per date and station; attributes are NULL for a station not in `stations`."""
    activity = station_activity(fact).alias("a")
    described = stations.select("station_key", "station_code", "station_name", "latitude", "longitude").alias("s")
    return activity.join(described, F.col("a.station_key") == F.col("s.station_key"), "left").select(
        "a.ride_date",
        "s.station_key",
        "s.station_code",
        "s.station_name",
        "s.latitude",
        "s.longitude",
        "a.total_departures",
        "a.total_arrivals",
        (F.col("a.total_departures") + F.col("a.total_arrivals")).alias("total_trip_activity"),
    )


LIVE_COLUMNS = (
    "station_key", "station_code", "station_name", "latitude", "longitude", "capacity",
    "num_bikes_available", "num_ebikes_available", "num_docks_available",
    "num_bikes_disabled", "num_docks_disabled",
    "is_installed", "is_renting", "is_returning", "is_empty", "is_full",
    "last_reported", "snapshot_timestamp",
)


def latest_status(fact: DataFrame) -> DataFrame:
    """The newest status row of each station; _ingested_at and then the other columns break ties.

    row_number is limited to one row per station and task before the shuffle, so a
    station with very many rows is no hot spot.
    """
    newest_first = [name for name in ("snapshot_timestamp", "_ingested_at") if name in fact.columns]
    tie_break = [name for name in fact.columns if name not in ("station_key", *newest_first)]
    order = [F.desc(name) for name in newest_first] + [F.asc(name) for name in tie_break]
    rank = F.row_number().over(Window.partitionBy("station_key").orderBy(*order))
    return fact.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def mart_station_live(fact: DataFrame, stations: DataFrame) -> DataFrame:
    """Latest status per station, by one plan whatever the sizes: one scan, and one row per station and task in the shuffle."""
    return _described_once(latest_status(fact), stations.select(*LIVE_COLUMNS[:6]))


def _described_once(latest: DataFrame, described: DataFrame) -> DataFrame:
    """One row per station with its attributes, even where a station key repeats."""
    return latest_status(latest.join(described, "station_key")).select(*LIVE_COLUMNS)


def refreshed_station_live(live: DataFrame, new_facts: DataFrame, stations: DataFrame) -> DataFrame:
    """The live mart after `new_facts`, from the mart as it was; the fact is not read again.

    `new_facts` are all newer than the mart. Copies of one snapshot among them are ranked before
    the union, while _ingested_at is there. Equals a rebuild as long as `stations` has lost no
    station since the last one.
    """
    columns = [name for name in LIVE_COLUMNS if name not in LIVE_COLUMNS[1:6]]
    candidates = live.select(*columns).unionByName(latest_status(new_facts).select(*columns))
    described = stations.select(*LIVE_COLUMNS[:6])
    return _described_once(latest_status(candidates), described)
