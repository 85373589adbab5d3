"""Dashboard queries over the marts and the trip fact."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velolake.functions import mean_from_hundredths
from velolake.operators.marts import ride_totals


def filtered(mart: DataFrame, first: date | str | None = None, last: date | str | None = None,
             rider_types: Sequence[str] = (), bike_types: Sequence[str] = ()) -> DataFrame:
    """Global filters of a rides mart; the date range prunes its partitions."""
    if first is not None:
        mart = mart.where(F.col("ride_date") >= F.lit(first).cast("date"))
    if last is not None:
        mart = mart.where(F.col("ride_date") <= F.lit(last).cast("date"))
    if rider_types:
        mart = mart.where(F.col("rider_type").isin(*rider_types))
    if bike_types:
        mart = mart.where(F.col("bike_type").isin(*bike_types))
    return mart


def kpis(fact: DataFrame, riders: DataFrame) -> DataFrame:
    """Total rides, mean rides per day, mean duration per ride, rides per rider type."""
    groups = ride_totals(fact, "date_key", "rider_type_key").join(F.broadcast(riders), "rider_type_key")
    days = groups.groupBy("date_key").agg(
        F.sum("rides").alias("rides"),
        F.sum("minutes_sum").alias("minutes_sum"),
        F.sum("minutes_n").alias("minutes_n"),
        *[F.sum(F.when(F.col("rider_type") == rider, F.col("rides")).otherwise(0)).alias(rider)
          for rider in ("member", "casual")],
    )
    rides, day_count = F.sum("rides"), F.count(F.lit(1))
    return days.agg(
        rides.alias("total_rides"),
        mean_from_hundredths(100 * rides, day_count).alias("avg_daily_rides"),
        mean_from_hundredths(F.sum("minutes_sum"), F.sum("minutes_n")).alias("avg_duration_minutes"),
        F.sum("member").alias("member_rides"),
        F.sum("casual").alias("casual_rides"),
    )


def daily_trend(daily: DataFrame) -> DataFrame:
    return daily.groupBy("ride_date").agg(F.sum("total_rides").alias("total_rides")).orderBy("ride_date")


def rides_by_hour(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("ride_hour").agg(F.sum("total_rides").alias("total_rides")).orderBy("ride_hour")


def top_stations(performance: DataFrame, size: int = 5) -> DataFrame:
    """The stations with the most activity; the station code breaks ties."""
    return (
        performance.groupBy("station_code", "station_name")
        .agg(F.sum("total_trip_activity").alias("total_trip_activity"))
        .orderBy(F.desc("total_trip_activity"), "station_code", "station_name")
        .limit(size)
    )


def live_totals(live: DataFrame) -> DataFrame:
    return live.agg(
        F.count(F.lit(1)).alias("stations"),
        F.sum("num_bikes_available").alias("bikes"),
        F.sum("num_ebikes_available").alias("ebikes"),
        F.sum("num_docks_available").alias("docks"),
        F.max("snapshot_timestamp").alias("last_update"),
    )
