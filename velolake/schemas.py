"""Declared schemas of the inputs and of the append-only output tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(kind: T.DataType, *names: str, nullable: bool = True) -> list[T.StructField]:
    return [T.StructField(name, kind, nullable) for name in names]


STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
BOOL, INSTANT = T.BooleanType(), T.TimestampType()

# Trip files keep every value as text; staging casts them. Ids must never be inferred as numbers.
RAW_TRIPS = T.StructType(
    _fields(STRING, "ride_id", "rideable_type", "started_at", "ended_at",
            "start_station_name", "start_station_id", "end_station_name", "end_station_id",
            "start_lat", "start_lng", "end_lat", "end_lng", "member_casual")
)

RAW_STATION_INFORMATION = T.StructType(
    _fields(STRING, "station_id", nullable=False)
    + _fields(STRING, "name", "short_name")
    + _fields(DOUBLE, "lat", "lon")
    + _fields(STRING, "region_id")
    + _fields(LONG, "capacity")
    + _fields(STRING, "station_type")
    + _fields(T.ArrayType(STRING), "rental_methods")
    + _fields(INSTANT, "_ingested_at", nullable=False)
)

COUNT_FIELDS = (
    "num_bikes_available",
    "num_ebikes_available",
    "num_docks_available",
    "num_bikes_disabled",
    "num_docks_disabled",
)
FLAG_FIELDS = ("is_installed", "is_renting", "is_returning")

RAW_STATION_STATUS = T.StructType(
    _fields(STRING, "station_id", nullable=False)
    + _fields(LONG, *COUNT_FIELDS)
    + _fields(BOOL, *FLAG_FIELDS)
    + _fields(INSTANT, "last_reported")
    + _fields(INSTANT, "snapshot_timestamp", "_ingested_at", nullable=False)
)

DEAD_LETTERS = T.StructType(
    _fields(STRING, "error_id", "raw_payload", "error_reason", "source", nullable=False)
    + _fields(INSTANT, "detected_at", nullable=False)
)

AUDIT = T.StructType(
    _fields(STRING, "audit_id", nullable=False)
    + _fields(STRING, "run_id", "dag_id")
    + _fields(STRING, "layer", "table_name", "check_name", nullable=False)
    + _fields(STRING, "actual_value", "expected_value")
    + _fields(STRING, "status", nullable=False)
    + _fields(STRING, "message")
    + _fields(INSTANT, "checked_at", nullable=False)
)

SCHEMA_TESTS = T.StructType(
    _fields(STRING, "run_id", "dag_id")
    + _fields(STRING, "layer", "table_name", "column_name", "test_name", nullable=False)
    + _fields(LONG, "violations", nullable=False)
    + _fields(STRING, "status", nullable=False)
    + _fields(INSTANT, "checked_at", nullable=False)
)
