"""Raw trips, stations, status and events derived from order, supplier and event tables.

The derivations are row by row (plus one equi-join), so they grow with the tables.
They plant every fault that the clean-up rules look for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.schemas import COUNT_FIELDS, FLAG_FIELDS

INGESTED_AT = "2024-02-01 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_trips(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_linestatus", "l_returnflag"
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # Both tables grow with the data, so the join is a sort-merge join at every size; it
    # also spreads the rows evenly, and adaptive execution splits a frequent order.
    joined = lines.join(orders.hint("merge"), lines.l_orderkey == orders.o_orderkey)
    start = "o_orderdate + make_dt_interval(0, 0, cast((l_partkey * 7 + l_orderkey) % 1440 as int), 0)"
    length = "make_dt_interval(0, 0, 0, cast(l_quantity as bigint) * 60 + l_suppkey - 180)"
    return joined.selectExpr(
        """CASE WHEN l_partkey % 499 = 7 THEN NULL
                ELSE concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) END AS ride_id""",
        """CASE WHEN l_partkey % 61 = 3 THEN 'docked_bike' WHEN l_partkey % 67 = 5 THEN NULL
                WHEN l_linestatus = 'O' THEN ' Classic_Bike ' ELSE 'ELECTRIC_BIKE' END AS rideable_type""",
        f"CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE {start} END AS started_at",
        f"{start} + {length} AS ended_at",
        """CASE WHEN l_partkey % 79 = 2 THEN NULL
                ELSE concat('Station ', 20 + o_custkey % 90) END AS start_station_name""",
        "CASE WHEN l_suppkey % 83 = 1 THEN NULL ELSE concat(' S', 20 + o_custkey % 90) END AS start_station_id",
        "concat('Station ', 10 + l_suppkey % 90) AS end_station_name",
        "concat('S', 10 + l_suppkey % 90) AS end_station_id",
        """CASE WHEN l_suppkey % 37 = 5 THEN NULL WHEN l_partkey % 71 = 8 THEN 95D
                ELSE 40 + (20 + o_custkey % 90) / 100D END AS start_lat""",
        "-74D AS start_lng",
        "40 + (10 + l_suppkey % 90) / 100D AS end_lat",
        "-74 + (10 + l_suppkey % 90) / 200D AS end_lng",
        """CASE WHEN l_partkey % 59 = 4 THEN 'unknown' WHEN l_partkey % 53 = 6 THEN NULL
                WHEN l_returnflag = 'N' THEN 'Casual ' ELSE 'member' END AS member_casual""",
    )


def raw_station_information(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").selectExpr(
        "concat('g', s_suppkey) AS station_id",
        "s_name AS name",
        "concat('S', s_suppkey) AS short_name",
        "40 + s_suppkey / 100D AS lat",
        "-74 + s_suppkey / 200D AS lon",
        "cast(s_nationkey AS string) AS region_id",
        """CASE WHEN s_suppkey % 17 = 16 THEN NULL WHEN s_suppkey % 19 = 7 THEN -1
                ELSE 10 + s_suppkey % 40 END AS capacity""",
        "' CLASSIC ' AS station_type",
        "array('key', 'creditcard') AS rental_methods",
        f"timestamp '{INGESTED_AT}' AS _ingested_at",
    )


def raw_station_status(spark: SparkSession, folder: str) -> DataFrame:
    """Status rows; `event_id` and `event_type` stay for the event and lateness samples."""
    return table(spark, folder, "events").selectExpr(
        "event_id", "event_type", "user_id", "cast(ts AS timestamp) AS ts",
        "cast(get_json_object(props, '$.k') AS int) AS k",
    ).selectExpr(
        "event_id",
        "event_type",
        "concat('g', user_id) AS station_id",
        """cast(CASE WHEN event_type = 'error' AND k % 5 = 0 THEN -k
                     ELSE k % 31 END AS bigint) AS num_bikes_available""",
        "cast(k % 7 AS bigint) AS num_ebikes_available",
        """cast(CASE WHEN event_type = 'signup' AND k % 11 = 0 THEN NULL
                     ELSE (k * 3) % 29 END AS bigint) AS num_docks_available""",
        "cast(k % 3 AS bigint) AS num_bikes_disabled",
        "cast(k % 2 AS bigint) AS num_docks_disabled",
        "event_type <> 'error' AS is_installed",
        "event_type <> 'view' AS is_renting",
        "true AS is_returning",
        "date_trunc('SECOND', ts) - INTERVAL 1 MINUTE AS last_reported",
        "ts AS snapshot_timestamp",
        "ts + INTERVAL 30 SECONDS AS _ingested_at",
    )


def status_events(spark: SparkSession, folder: str) -> DataFrame:
    """Event texts: blank ids, unreadable timestamps and texts cut in half are planted."""
    flags = [F.col(name).cast("int").alias(name) for name in FLAG_FIELDS]
    iso = F.date_format("snapshot_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    text = F.to_json(F.struct(
        F.when(F.col("event_id") % 50 == 0, F.lit("")).otherwise(F.col("station_id")).alias("station_id"),
        *COUNT_FIELDS,
        *flags,
        F.unix_timestamp("last_reported").alias("last_reported"),
        F.when(F.col("event_id") % 50 == 1, F.lit("invalid-timestamp")).otherwise(iso).alias("snapshot_timestamp"),
    ))
    halved = F.when(F.col("event_id") % 50 == 2, F.expr("left(text, length(text) div 2)"))
    return (
        raw_station_status(spark, folder)
        .withColumn("text", text)
        .select("event_id", F.col("_ingested_at").alias("arrived_at"),
                halved.otherwise(F.col("text")).alias("value"))
    )
