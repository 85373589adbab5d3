"""Station feeds: payload documents, station rows, and snapshots as newline-delimited JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.schemas import RAW_STATION_INFORMATION


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Feed documents, one per file, as the text column `payload`."""
    return spark.read.text(path, wholetext=True).toDF("payload")


def payload_stations(payloads: DataFrame, *keep: str, strict: bool = True) -> DataFrame:
    """One row per entry of data.stations, as the variant column `station`.

    A document that is not JSON, or whose data.stations is no list, is an error. If not
    `strict`, it is a row with the document in the column `bad_document` instead, which is
    NULL in all other rows.
    """
    document = (F.parse_json if strict else F.try_parse_json)(F.col("payload"))
    listed = F.try_variant_get(F.try_variant_get(document, "$.data.stations", "variant"), "$", "array<variant>")
    if not strict:
        bad = F.when(listed.isNull(), F.col("payload")).alias("bad_document")
        one = F.when(listed.isNull(), F.array(F.lit(None).cast("variant"))).otherwise(listed)
        return payloads.select(*keep, bad, F.explode(one).alias("station"))
    failure = F.raise_error(F.lit("data.stations is not a list")).cast("array<variant>")
    return payloads.select(*keep, F.explode(F.coalesce(listed, failure)).alias("station"))


def flatten_station_info(payloads: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Station rows of the feed documents.

    An absent rental_methods becomes an empty list, an explicit null stays NULL.
    """
    station = F.col("station")
    given = F.variant_get(station, "$.rental_methods", "variant")
    methods = F.when(given.isNull(), F.array().cast("array<string>")).otherwise(
        F.variant_get(station, "$.rental_methods", "array<string>")
    )
    kinds = {"lat": "double", "lon": "double", "capacity": "bigint"}
    fields = [name for name in RAW_STATION_INFORMATION.names if name not in ("rental_methods", "_ingested_at")]
    return payload_stations(payloads).select(
        *[F.variant_get(station, f"$.{name}", kinds.get(name, "string")).alias(name) for name in fields],
        methods.alias("rental_methods"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("_ingested_at"),
    )


def require_stations(stations: DataFrame) -> DataFrame:
    """Raise when the payload had no station; looks at one row."""
    if stations.isEmpty():
        raise ValueError("station information payload is empty")
    return stations


def write_station_snapshot(stations: DataFrame, root: str) -> None:
    """Newline-delimited JSON under dt=YYYY-MM-DD; a rerun replaces its own days only."""
    (
        stations.withColumn("dt", F.date_format("_ingested_at", "yyyy-MM-dd"))
        .hint("rebalance", "dt")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", False)
        .partitionBy("dt")
        .json(root)
    )


def scan_station_info_json(spark: SparkSession, path: str) -> DataFrame:
    """A snapshot folder, or all of them, with the declared schema."""
    return spark.read.schema(RAW_STATION_INFORMATION).json(path)
