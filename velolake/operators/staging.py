"""Staging: names, types and categories of the three raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velolake.functions import category, trimmed
from velolake.schemas import COUNT_FIELDS, FLAG_FIELDS

COORDINATES = ("start_lat", "start_lng", "end_lat", "end_lng")


def stage_trips(raw: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Typed trips. A malformed timestamp is an error, a malformed coordinate becomes NULL."""
    stations = [
        trimmed(F.col(name)).alias(name)
        for name in ("start_station_id", "start_station_name", "end_station_id", "end_station_name")
    ]
    return raw.select(
        F.col("ride_id").cast("string").alias("ride_id"),
        category(F.col("rideable_type")).alias("rideable_type"),
        category(F.col("member_casual")).alias("member_casual"),
        F.col("started_at").cast("timestamp").alias("started_at"),
        F.col("ended_at").cast("timestamp").alias("ended_at"),
        *stations,
        *[F.col(name).try_cast("double").alias(name) for name in COORDINATES],
        _or_now(ingested_at).alias("_ingested_at"),
    )


def stage_station_information(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("station_id").cast("string").alias("station_id"),
        trimmed(F.col("name")).alias("station_name"),
        trimmed(F.col("short_name")).alias("short_name"),
        F.col("lat").try_cast("double").alias("latitude"),
        F.col("lon").try_cast("double").alias("longitude"),
        F.col("region_id").cast("string").alias("region_id"),
        F.col("capacity").try_cast("bigint").alias("capacity"),
        category(F.col("station_type")).alias("station_type"),
        "rental_methods",
        "_ingested_at",
    )


def stage_station_status(raw: DataFrame) -> DataFrame:
    instants = ("last_reported", "snapshot_timestamp", "_ingested_at")
    return raw.select(
        F.col("station_id").cast("string").alias("station_id"),
        *[F.col(name).try_cast("bigint").alias(name) for name in COUNT_FIELDS],
        *[F.col(name).cast("boolean").alias(name) for name in FLAG_FIELDS],
        *[F.col(name).cast("timestamp").alias(name) for name in instants],
    )


def _or_now(instant: Column | None) -> Column:
    return F.current_timestamp() if instant is None else instant.cast("timestamp")
