"""Warehouse: the small dimensions and the trip fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.functions import day_name, is_weekend_day, month_name
from velolake.operators.trips import BIKE_TYPES, RIDER_TYPES


def _numbered(spark: SparkSession, name: str, values: tuple[str, ...]) -> DataFrame:
    rows = ", ".join(f"({key}L, '{value}')" for key, value in enumerate(values, start=1))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({name}_key, {name})")


def dim_rider_type(spark: SparkSession) -> DataFrame:
    return _numbered(spark, "rider_type", RIDER_TYPES)


def dim_bike_type(spark: SparkSession) -> DataFrame:
    return _numbered(spark, "bike_type", BIKE_TYPES)


def dim_date(clean: DataFrame) -> DataFrame:
    """One row per date with trips; attributes are computed after the distinct."""
    day = F.col("date_key")
    return clean.select(F.col("trip_date").alias("date_key")).distinct().select(
        "date_key",
        F.dayofmonth(day).cast("bigint").alias("day"),
        day_name(day).alias("day_name"),
        is_weekend_day(day).alias("is_weekend"),
        F.month(day).cast("bigint").alias("month"),
        month_name(day).alias("month_name"),
        F.year(day).cast("bigint").alias("year"),
    )


def fact_trips(clean: DataFrame, stations: DataFrame, riders: DataFrame, bikes: DataFrame) -> DataFrame:
    """Trips with dimension keys; a trip whose station is unknown keeps a NULL key.

    The two literal dimensions have two rows each and are broadcast. `stations` should be
    a stored table: its file size lets the optimizer broadcast the two key columns, or
    sort-merge when it is large, where adaptive execution splits busy stations.
    """
    codes = stations.select("station_code", "station_key")
    start = codes.toDF("start_station_id", "start_station_key")
    end = codes.toDF("end_station_id", "end_station_key")
    rider = F.broadcast(riders.withColumnRenamed("rider_type", "member_casual"))
    bike = F.broadcast(bikes.withColumnRenamed("bike_type", "rideable_type"))
    return (
        clean.join(start, "start_station_id", "left")
        .join(end, "end_station_id", "left")
        .join(rider, "member_casual", "left")
        .join(bike, "rideable_type", "left")
        .select(
            "ride_id",
            F.col("trip_date").alias("date_key"),
            "start_station_key",
            "end_station_key",
            "rider_type_key",
            "bike_type_key",
            "started_at",
            "ended_at",
            "ride_duration_minutes",
            "trip_distance_km",
            "ride_hour",
            "is_weekend",
            "time_of_day",
        )
    )
