"""Stations: clean feed rows, stations seen in trips, and the station dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_station_information(staged: DataFrame) -> DataFrame:
    return staged.where(
        F.col("station_id").isNotNull()
        & F.col("short_name").isNotNull()
        & F.col("station_name").isNotNull()
        & F.col("latitude").between(-90, 90)
        & F.col("longitude").between(-180, 180)
        & (F.col("capacity").isNull() | (F.col("capacity") >= 0))
    )


def station_observations(clean: DataFrame) -> DataFrame:
    """Both ends of every trip as (station_code, station_name, latitude, longitude).

    The two ends come out of one scan; a union would read the trips twice.
    """

    def end(role: str) -> Column:
        return F.struct(
            F.col(f"{role}_station_id").alias("station_code"),
            F.col(f"{role}_station_name").alias("station_name"),
            F.col(f"{role}_lat").alias("latitude"),
            F.col(f"{role}_lng").alias("longitude"),
        )

    return clean.select(F.inline(F.array(end("start"), end("end"))))


def stations_in_trips(clean: DataFrame) -> DataFrame:
    """One observation per station code: the smallest by name, latitude, longitude.

    Equal observations collapse first in a hash aggregation over all four columns, which
    spreads a busy station over many tasks; the minimum then sees few rows per station. The
    count, which is never 0, keeps the optimizer from merging both groupings into one sort.
    """
    counted = station_observations(clean).groupBy("station_code", "station_name", "latitude", "longitude").agg(F.count(F.lit(1)).alias("ends"))
    smallest = F.min(F.struct("station_name", "latitude", "longitude")).alias("seen")
    return counted.where("ends > 0").groupBy("station_code").agg(smallest).select("station_code", "seen.*")


def dim_station(information: DataFrame, clean: DataFrame) -> DataFrame:
    """Feed stations and stations seen in trips; the feed's attributes win."""
    feed, seen = information.alias("feed"), stations_in_trips(clean).alias("seen")
    code = F.coalesce("feed.short_name", "seen.station_code")
    joined = feed.join(seen, F.col("feed.short_name") == F.col("seen.station_code"), "full_outer")
    return joined.select(
        F.md5(code).alias("station_key"),
        code.alias("station_code"),
        F.col("feed.station_id").alias("gbfs_station_id"),
        *[F.coalesce(f"feed.{name}", f"seen.{name}").alias(name)
          for name in ("station_name", "latitude", "longitude")],
        "feed.region_id",
        "feed.capacity",
        "feed.station_type",
        "feed.rental_methods",
    )
