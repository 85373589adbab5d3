"""Station status: valid snapshots, the status fact and its incremental load."""

from __future__ import annotations

from datetime import date, datetime, timezone
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velolake.schemas import COUNT_FIELDS, FLAG_FIELDS

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
STATUS_KEY = ("station_key", "snapshot_timestamp")


def valid_status() -> Column:
    """Ids are present and no count is negative; a NULL count fails the comparison."""
    rules = [F.col("station_id").isNotNull(), F.col("snapshot_timestamp").isNotNull()]
    return reduce(and_, rules + [F.col(name) >= 0 for name in COUNT_FIELDS])


def clean_station_status(staged: DataFrame) -> DataFrame:
    """Valid snapshots with derived capacity (e-bikes are part of the bikes) and two flags."""
    capacity = [F.col(name) for name in COUNT_FIELDS if name != "num_ebikes_available"]
    return staged.where(valid_status()).select(
        "*",
        reduce(add, capacity).alias("available_capacity"),
        (F.col("num_bikes_available") == 0).alias("is_empty"),
        (F.col("num_docks_available") == 0).alias("is_full"),
    )


def fact_station_status(status: DataFrame, stations: DataFrame) -> DataFrame:
    """Snapshots of known stations; snapshots of unknown stations are dropped.

    `stations` should be a stored table, see warehouse.fact_trips. Works on streams too.
    """
    keys = stations.where(F.col("gbfs_station_id").isNotNull()).select(
        F.col("gbfs_station_id").alias("station_id"), "station_key"
    )
    return status.join(keys, "station_id").select(
        "station_key",
        "snapshot_timestamp",
        F.to_date("snapshot_timestamp").alias("snapshot_date"),
        *COUNT_FIELDS,
        "available_capacity",
        *FLAG_FIELDS,
        "is_empty",
        "is_full",
        "last_reported",
        "_ingested_at",
    )


def high_watermark(loaded: DataFrame, newest_day: date | None = None) -> datetime:
    """Newest loaded snapshot, or the epoch for an empty table; read from the newest day only.

    Give `newest_day` when the catalog knows it; otherwise every file is opened to find it.
    """
    day = newest_day or loaded.agg(F.max("snapshot_date")).first()[0]
    if day is None:
        return EPOCH
    newest = loaded.where(F.col("snapshot_date") == F.lit(day))
    micros = newest.agg(F.max(F.unix_micros("snapshot_timestamp"))).first()[0]
    return EPOCH if micros is None else _instant(micros)


def _instant(micros: int) -> datetime:
    return datetime.fromtimestamp(micros // 1_000_000, tz=timezone.utc).replace(microsecond=micros % 1_000_000)


def newer_than(status: DataFrame, watermark: datetime) -> DataFrame:
    """Rows above the watermark; the literal is pushed into the scan, and prunes a table split by day."""
    newer = status.where(F.col("snapshot_timestamp") > F.lit(watermark))
    if "snapshot_date" in status.columns:
        newer = newer.where(F.col("snapshot_date") >= F.lit(watermark.date()))
    return newer


def increment(status: DataFrame, stations: DataFrame, loaded: DataFrame, mode: str = "watermark",
              newest_day: date | None = None) -> DataFrame:
    """Fact rows to append to `loaded`.

    "watermark" takes snapshots newer than everything loaded, so a late row is ignored
    for good. "by_key" takes every (station, snapshot) that is not loaded, late or not;
    only the days that occur in `status` are compared.
    """
    if mode == "watermark":
        return fact_station_status(newer_than(status, high_watermark(loaded, newest_day)), stations)
    if mode == "by_key":
        return not_loaded(fact_station_status(status, stations), loaded)
    raise ValueError(f"unknown mode: {mode}")


def not_loaded(candidates: DataFrame, loaded: DataFrame) -> DataFrame:
    """Candidates whose (station, snapshot) is not in `loaded`.

    The semi-join with the days of the candidates lets Spark skip all other days of `loaded`
    when it runs.
    """
    key = [*STATUS_KEY, "snapshot_date"]
    same_days = loaded.select(*key).join(candidates.select("snapshot_date").distinct(), "snapshot_date", "left_semi")
    return candidates.join(same_days, key, "left_anti")


def first_of_each(fact: DataFrame) -> DataFrame:
    """One row per (station, snapshot), the smallest by the other columns.

    Copies combine on the map side, so a snapshot with very many copies is no hot spot.
    """
    rest = [name for name in fact.columns if name not in STATUS_KEY]
    kept = fact.groupBy(*STATUS_KEY).agg(F.min(F.struct(*rest)).alias("kept"))
    return kept.select(*STATUS_KEY, "kept.*").select(*fact.columns)


def newest_of_each(fact: DataFrame) -> DataFrame:
    """One row per (station, snapshot): the one ingested last, of several the largest by the other columns."""
    rest = [name for name in fact.columns if name not in (*STATUS_KEY, "_ingested_at")]
    kept = fact.groupBy(*STATUS_KEY).agg(F.max(F.struct("_ingested_at", *rest)).alias("kept"))
    return kept.select(*STATUS_KEY, "kept.*").select(*fact.columns)


def corrections(status: DataFrame, stations: DataFrame, loaded: DataFrame) -> DataFrame:
    """Fact rows to merge into `loaded`: what was ingested since its newest row, new, late or corrected.

    Rows ingested at the very instant of the newest one are taken again; merging them twice
    changes nothing.
    """
    newest = loaded.agg(F.max(F.unix_micros("_ingested_at"))).first()[0]
    since = EPOCH if newest is None else _instant(newest)
    arrived = status.where(F.col("_ingested_at") >= F.lit(since))
    return newest_of_each(fact_station_status(arrived, stations))


def late_rows(status: DataFrame, stations: DataFrame, loaded: DataFrame, newest_day: date | None = None) -> DataFrame:
    """Fact rows that the watermark load ignores although they were never loaded; reads their days only."""
    candidates = fact_station_status(status, stations)
    late = candidates.where(F.col("snapshot_timestamp") <= F.lit(high_watermark(loaded, newest_day)))
    return not_loaded(late, loaded)
