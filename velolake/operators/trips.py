"""Trips: the clean and rejected sets, enrichment, and optional deduplication."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velolake.functions import (
    day_name,
    from_hundredths,
    great_circle_metres,
    is_weekend_day,
    time_of_day,
)
from velolake.functions.numeric import integer_div

# Fixed values.
RIDER_TYPES = ("member", "casual")
BIKE_TYPES = ("classic_bike", "electric_bike")
LATITUDES, LONGITUDES = ("start_lat", "end_lat"), ("start_lng", "end_lng")
STATION_IDS = ("start_station_id", "end_station_id")
STATION_NAMES = ("start_station_name", "end_station_name")

# The reasons a trip is rejected.
MISSING_RIDE_ID = "missing ride_id"
MISSING_TIMESTAMP = "missing timestamp"
INVALID_TRIP_TIME = "invalid trip time"
INVALID_USER_TYPE = "invalid user type"
INVALID_BIKE_TYPE = "invalid bike type"
MISSING_STATION = "missing station"
MISSING_COORDINATES = "missing coordinates"
INVALID_COORDINATES = "invalid coordinates"


def valid_trip() -> Column:
    """The rules a trip must meet. NULL when only a NULL category or coordinate is at fault."""
    present = ("ride_id", "started_at", "ended_at", *STATION_IDS, *STATION_NAMES)
    rules = [F.col(name).isNotNull() for name in present]
    rules.append(F.col("ended_at") > F.col("started_at"))
    rules.append(F.col("member_casual").isin(*RIDER_TYPES))
    rules.append(F.col("rideable_type").isin(*BIKE_TYPES))
    rules += [F.col(name).between(-90, 90) for name in LATITUDES]
    rules += [F.col(name).between(-180, 180) for name in LONGITUDES]
    return reduce(and_, rules)


def rejected_trip(mode: str = "reference") -> Column:
    """Trips of the rejected set.

    "reference" negates the rules with SQL's three-valued logic, so a trip whose only
    fault is a NULL category or coordinate is in neither set. "complete" rejects it,
    so clean and rejected trips add up to the staged trips.
    """
    if mode == "reference":
        return ~valid_trip()
    if mode == "complete":
        return ~F.coalesce(valid_trip(), F.lit(False))
    raise ValueError(f"unknown mode: {mode}")


def reject_reason() -> Column:
    """The first reason that applies, in a fixed order."""

    def unknown(name: str, known: tuple[str, ...]) -> Column:
        return F.col(name).isNull() | ~F.col(name).isin(*known)

    def any_null(*names: str) -> Column:
        return reduce(or_, [F.col(name).isNull() for name in names])

    return (
        F.when(any_null("ride_id"), MISSING_RIDE_ID)
        .when(any_null("started_at", "ended_at"), MISSING_TIMESTAMP)
        .when(F.col("ended_at") <= F.col("started_at"), INVALID_TRIP_TIME)
        .when(unknown("member_casual", RIDER_TYPES), INVALID_USER_TYPE)
        .when(unknown("rideable_type", BIKE_TYPES), INVALID_BIKE_TYPE)
        .when(any_null(*STATION_IDS), MISSING_STATION)
        .when(any_null(*LATITUDES, *LONGITUDES), MISSING_COORDINATES)
        .otherwise(INVALID_COORDINATES)
    )


def clean_trips(staged: DataFrame) -> DataFrame:
    """Valid trips with duration, distance and calendar attributes.

    Everything is a narrow projection over the filter, so a reader that needs three
    columns computes three columns, and both metrics round through whole hundredths:
    seconds * 100 / 60 = seconds * 5 / 3 is never a tie.
    """
    started = F.col("started_at")
    seconds = F.timestamp_diff("SECOND", started, F.col("ended_at"))
    minutes = integer_div(10 * seconds + 3, F.lit(6).cast("bigint"))
    trip_date = F.to_date(started)
    metres = great_circle_metres(*[F.col(n) for n in ("start_lat", "start_lng", "end_lat", "end_lng")])
    return staged.where(valid_trip()).select(
        "ride_id",
        "rideable_type",
        "member_casual",
        "started_at",
        "ended_at",
        trip_date.alias("trip_date"),
        from_hundredths(minutes).alias("ride_duration_minutes"),
        F.year(trip_date).cast("bigint").alias("ride_year"),
        F.month(trip_date).cast("bigint").alias("ride_month"),
        day_name(trip_date).alias("ride_day_of_week"),
        F.hour(started).cast("bigint").alias("ride_hour"),
        is_weekend_day(trip_date).alias("is_weekend"),
        time_of_day(F.hour(started)).alias("time_of_day"),
        "start_station_id",
        "start_station_name",
        "start_lat",
        "start_lng",
        "end_station_id",
        "end_station_name",
        "end_lat",
        "end_lng",
        from_hundredths(F.floor(metres / 10.0 + 0.5)).alias("trip_distance_km"),
    )


def rejected_trips(staged: DataFrame, mode: str = "reference") -> DataFrame:
    return staged.where(rejected_trip(mode)).select(
        "ride_id", "rideable_type", "member_casual", "started_at", "ended_at",
        *STATION_IDS, reject_reason().alias("invalid_reason"),
    )


def split_trips(staged: DataFrame, mode: str = "reference") -> tuple[DataFrame, DataFrame]:
    """The clean and the rejected trips."""
    return clean_trips(staged), rejected_trips(staged, mode)


def reject_reason_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("invalid_reason").agg(F.count(F.lit(1)).alias("trips"))


def time_of_day_counts(clean: DataFrame) -> DataFrame:
    return clean.groupBy("time_of_day", "is_weekend").agg(F.count(F.lit(1)).alias("trips"))


def dedupe_trips(trips: DataFrame) -> DataFrame:
    """One trip per ride_id, the first by start, end and then every other column.

    Optional. Trips without an id are all kept. A minimum over the whole row combines
    on the map side, so a ride_id with very many rows is no hot spot in the shuffle.
    """
    ranked = ["started_at", "ended_at"]
    ranked += [name for name in trips.columns if name not in ("ride_id", *ranked)]
    # A NULL sorts after every value of its column.
    order = [part for name in ranked for part in (F.col(name).isNull().alias(f"{name}_absent"), F.col(name))]
    first = F.min(F.struct(*order)).alias("first")
    identified = trips.where(F.col("ride_id").isNotNull()).groupBy("ride_id").agg(first)
    anonymous = trips.where(F.col("ride_id").isNull())
    one_each = identified.select("ride_id", *[f"first.{name}" for name in ranked])
    return one_each.select(*trips.columns).unionByName(anonymous)
