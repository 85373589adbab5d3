"""Trip files: scans of CSV, the day-split layout, and replacing one month.

The layout is year=YYYY/month=MM/day=DD with zero-padded text values; partition
discovery reads them back as numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velolake.schemas import RAW_TRIPS

CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DAY_FORMATS = {"year": "yyyy", "month": "MM", "day": "dd"}


def scan_trips_csv(spark: SparkSession, path: str) -> DataFrame:
    """Trip files with a header line; columns are matched by the declared schema."""
    return spark.read.schema(RAW_TRIPS).option("header", True).option("enforceSchema", False).csv(path)


def scan_partitioned_trips(spark: SparkSession, root: str, *folders: str) -> DataFrame:
    """The day-split layout below `root`, or only some of its folders; adds year, month, day."""
    paths = [f"{root}/{folder}" for folder in folders] or [root]
    reader = spark.read.schema(RAW_TRIPS).option("header", True).option("enforceSchema", False)
    return reader.option("basePath", root).csv(paths)


def filter_period(trips: DataFrame, year: int, month: int) -> DataFrame:
    """Trips that start in the month; an unreadable start is dropped, a missing column is an error."""
    if "started_at" not in trips.columns:
        raise ValueError("column 'started_at' not found")
    next_year, next_month = (year + 1, 1) if month == 12 else (year, month + 1)
    first, after = f"{year:04d}-{month:02d}-01", f"{next_year:04d}-{next_month:02d}-01"
    started = F.col("started_at")
    if isinstance(trips.schema["started_at"].dataType, T.StringType):
        started = F.try_to_timestamp(started)
    trips = trips.withColumn("started_at", started.cast("timestamp"))
    return trips.where(
        (F.col("started_at") >= F.lit(first).cast("timestamp"))
        & (F.col("started_at") < F.lit(after).cast("timestamp"))
    )


def partition_day_count(trips: DataFrame) -> DataFrame:
    """Number of days with trips, which is the number of daily folders."""
    return trips.agg(F.count_distinct(F.to_date("started_at")).alias("days"))


def write_daily_partitions(trips: DataFrame, root: str) -> None:
    """Write the day-split layout, replacing what is below `root`.

    Rebalancing by day gives every day few files and splits a day that holds much
    of the data over several tasks.
    """
    write_trips_csv(_by_day(trips, *DAY_FORMATS), root, *DAY_FORMATS)


def replace_month(trips: DataFrame, root: str, year: int, month: int) -> tuple[int, int]:
    """Replace one month's folder with its trips; returns (rows, days) as written.

    The month's own folder is overwritten as a whole, so a day that has no trips any
    more disappears, and other months stay. The counts are observed during the write: the
    days of one month fit in the bits of one number.
    """
    written = Observation()
    day_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth("started_at"))
    # Observed behind the rebalancing, in the writing tasks: a repeated earlier stage is not counted.
    selected = _by_day(filter_period(trips, year, month), "day").observe(
        written, F.count(F.lit(1)).alias("rows"), F.bit_count(F.bit_or(day_bit)).alias("days")
    )
    write_trips_csv(selected, f"{root}/year={year:04d}/month={month:02d}", "day")
    return written.get["rows"], written.get["days"] or 0


def extract_months(spark: SparkSession, sources: dict[str, str], root: str) -> dict[str, tuple[int, int]]:
    """Replace every month of `sources` (YYYYMM -> path of its CSV files); (rows, days) per month."""
    return {
        month: replace_month(scan_trips_csv(spark, path), root, int(month[:4]), int(month[4:]))
        for month, path in sources.items()
    }


def _by_day(trips: DataFrame, *levels: str) -> DataFrame:
    parts = {level: F.date_format("started_at", DAY_FORMATS[level]) for level in levels}
    return trips.withColumns(parts).hint("rebalance", *levels)


def write_trips_csv(trips: DataFrame, path: str, *levels: str) -> None:
    """Replace the CSV files at `path`; `levels` are columns that become folders."""
    instants = (T.TimestampType, T.TimestampNTZType)

    def text(field: T.StructField) -> Column:
        column = F.col(field.name)
        return F.date_format(column, CSV_TIMESTAMP).alias(field.name) if isinstance(field.dataType, instants) else column

    (
        trips.select(*[text(field) for field in trips.schema.fields])
        .write.mode("overwrite")
        .partitionBy(*levels)
        .option("header", True)
        # Values are written as they are; by default the writer trims them.
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
