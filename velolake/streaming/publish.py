"""Publishing a status snapshot as one message per station, and faulty test events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from velolake.sources.station_feed import payload_stations

ADDED_FIELDS = ("source_last_updated", "snapshot_timestamp")


def fan_out_snapshot(payloads: DataFrame, snapshot_timestamp: Column | None = None, strict: bool = True) -> DataFrame:
    """Messages (key, value) of every station in the feed documents of `payload`.

    A message is the station's own fields plus the feed's last_updated and the time of
    the snapshot. Stations without an id have `value` NULL and are not to be published.
    If not `strict`, documents that are no feed come back in `bad_document` instead of failing.
    """
    taken = F.current_timestamp() if snapshot_timestamp is None else snapshot_timestamp
    iso = F.date_format(taken, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    updated = F.try_variant_get((F.parse_json if strict else F.try_parse_json)(F.col("payload")), "$.last_updated", "variant")
    stations = payload_stations(payloads.withColumns({"updated": updated, "iso": iso}), "updated", "iso", strict=strict)

    station_id = F.try_variant_get("station", "$.station_id", "variant")
    text = F.try_variant_get("station", "$.station_id", "string")
    has_id = F.coalesce(~_is_falsy(station_id, text), F.lit(False))
    own = F.map_filter(
        F.try_variant_get("station", "$", "map<string,variant>"), lambda name, _: ~name.isin(*ADDED_FIELDS)
    )
    added = F.create_map(
        F.lit(ADDED_FIELDS[0]), F.coalesce(F.col("updated"), F.parse_json(F.lit("null"))),
        F.lit(ADDED_FIELDS[1]), F.col("iso").cast("variant"),
    )
    message = F.to_json(F.map_concat(own, added))
    bad = [] if strict else ["bad_document"]
    return stations.select(F.when(has_id, text).alias("key"), F.when(has_id, message).alias("value"), *bad)


def _is_falsy(value: Column, text: Column) -> Column:
    kind = F.schema_of_variant(value)
    zero = kind.rlike("^(BIGINT|DOUBLE|DECIMAL.*)$") & (text.try_cast("double") == 0)
    return (kind == "VOID") | (text == "") | zero | ((kind == "BOOLEAN") & (text == "false"))


def publish_snapshot(messages: DataFrame, path: str) -> tuple[int, int]:
    """Write the messages as text lines, one file per task; returns (published, skipped)."""
    counts = Observation()
    has_value = F.col("value").isNotNull()
    observed = messages.observe(
        counts, F.count_if(has_value).alias("published"), F.count_if(~has_value).alias("skipped")
    )
    observed.where(has_value).select("value").write.mode("append").text(path)
    return counts.get["published"], counts.get["skipped"]


def invalid_events(numbers: DataFrame, now: datetime | Column) -> DataFrame:
    """Test messages (key, value) for the numbers 1, 2, 3, ... in column `n`.

    The faults take turns: an empty station id, a negative count, an unreadable timestamp.
    """
    iso = F.date_format(now if isinstance(now, Column) else F.lit(now), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    turn = F.pmod(F.col("n") - 1, F.lit(3))
    name = F.when(turn == 0, "TEST-DLQ-EMPTY-").when(turn == 1, "TEST-DLQ-NEGATIVE-").otherwise("TEST-DLQ-TIMESTAMP-")
    key = F.concat(name, F.col("n").cast("string"))
    value = F.to_json(F.struct(
        F.when(turn == 0, "").otherwise(key).alias("station_id"),
        F.when(turn == 1, -5).otherwise(10).alias("num_bikes_available"),
        F.when(turn == 2, "invalid-timestamp").otherwise(iso).alias("snapshot_timestamp"),
    ))
    return numbers.select(key.alias("key"), value.alias("value"))


def generate_invalid_events(spark: SparkSession, total: int, now: datetime | Column | None = None) -> DataFrame:
    if total < 1:
        raise ValueError("total must be at least 1")
    return invalid_events(spark.range(1, total + 1).toDF("n"), F.current_timestamp() if now is None else now)
