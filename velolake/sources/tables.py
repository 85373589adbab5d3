"""Layered tables: one database per layer, refresh at once, appends, merges by key, absent tables.

A table is a view of its newest version, a stored table of its own. Replacing the view is the
commit of a refresh, so readers never meet an absent or half-written table.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from py4j.java_gateway import JavaObject
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velolake.session import _CLEANUP, _read_folders, setting, stored

LAYERS = ("raw", "staging", "intermediate", "mart", "audit")

# The property of a view that tells the version it shows: the end of its name, as Spark hides values with "url" in them ("hourly").
VERSION = "velolake.version"

# Instants are written as the whole microseconds that Spark holds, which is quicker to write and to read than its 96-bit default.
INSTANTS = ("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
# The layers of a run hold each trip several times, so they are packed more tightly than by default.
PACKED = ("spark.sql.parquet.compression.codec", "zstd")

# Tables that are split by day, and by which column.
DAY_COLUMNS = {"fact_trips": "date_key", "mart_daily_rides": "ride_date", "fact_station_status": "snapshot_date"}


@dataclass(frozen=True)
class Layers:
    """The databases `<prefix>_<layer>`, stored below `root`.

    `day_columns` names the tables to split by day. A table with few rows per day is
    better left whole, because each day is a folder with a file of its own. `kept_versions`
    replaced versions stay for readers that began before the last refreshes.
    """

    spark: SparkSession
    root: str
    prefix: str = "velolake"
    day_columns: Mapping[str, str] = field(default_factory=lambda: dict(DAY_COLUMNS))
    kept_versions: int = 1

    def create(self) -> Layers:
        for layer in LAYERS:
            location = f"{self.root}/{self.prefix}_{layer}"
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}_{layer} LOCATION '{location}'")
        return self

    def drop(self, *layers: str) -> None:
        """Drop these layers with all versions of their tables; other layers stay."""
        for layer in layers:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.prefix}_{layer} CASCADE")

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}_{layer}.{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def read_or_empty(self, layer: str, table: str, schema: T.StructType) -> DataFrame:
        """The table, or no rows of `schema` while it does not exist."""
        if self.exists(layer, table):
            return self.read(layer, table)
        return self.spark.createDataFrame([], schema)

    def newest_day(self, layer: str, table: str) -> date | None:
        """The newest folder of a table that is split by day, from the catalog alone."""
        if table not in self.day_columns:
            return None
        days = self.spark.sql(f"SHOW PARTITIONS {self._name_of_version(layer, table)}")
        newest = days.agg(F.max(F.try_to_date(F.regexp_extract("partition", r"=(\d{4}-\d{2}-\d{2})$", 1))))
        return newest.first()[0]

    def refresh(self, df: DataFrame, layer: str, table: str) -> int:
        """Replace the table with `df` at once; returns the number of rows written.

        Everything is written as a new version before the view of the table is replaced: a
        reader sees the old rows or the new ones, and after a failure the old ones. Refreshes of
        one table must not overlap. One that reads its own table is refused, because repeating
        it would give other rows.
        """
        current = self.version(layer, table)
        if current and current in _read_folders(df):
            raise AnalysisException(f"{self.name(layer, table)} cannot be refreshed from itself")
        return self._replace(df, layer, table)

    def append(self, df: DataFrame, layer: str, table: str) -> int:
        """Append to the table, creating it if needed; returns the number of rows written."""
        if not self.exists(layer, table):
            return self._replace(df, layer, table)
        return self._write(df, self._name_of_version(layer, table), table, "append")

    def merge(self, changes: DataFrame, layer: str, table: str, key: Sequence[str]) -> int:
        """Add `changes`, in place of the rows that have the same `key`; returns the rows of `changes`.

        Keys of `changes` must be distinct, as in SQL; NULL in a key equals nothing. Of a table
        that is split by day, which the key must determine, only the days that occur in
        `changes` are read and written anew. Each of them changes at once and its old files stay
        for running readers until its next merge; repeating a merge that was stopped half-way
        completes it. Any other table is written anew as a whole.
        """
        rows = stored(changes, f"merge-{table}")
        if rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).take(1):
            raise ValueError(f"rows to merge into {self.name(layer, table)} share a key")
        if not self.exists(layer, table):
            return self._replace(rows, layer, table)
        loaded, day = self.read(layer, table), self.day_columns.get(table)
        if day is None:
            self._replace(_merged(loaded, rows, key), layer, table)
            return rows.count()
        per_day = {row[day]: row.n for row in rows.groupBy(day).agg(F.count(F.lit(1)).alias("n")).collect()}  # calendar days
        if None in per_day:
            raise ValueError(f"rows to merge into {self.name(layer, table)} have no {day}")
        if per_day:
            touched = loaded.where(F.col(day).isin(list(per_day)))
            self._replace_days(_merged(touched, rows, key), self._name_of_version(layer, table), day, list(per_day))
        return sum(per_day.values())

    def version(self, layer: str, table: str) -> str | None:
        """The stored table that the view shows now; None for an absent table or one written by other means."""
        if not self.exists(layer, table):
            return None
        shown = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(layer, table)}").where(F.col("key") == VERSION).collect()
        return f"{table}__{shown[0].value}" if shown else None

    def _name_of_version(self, layer: str, table: str) -> str:
        return self.name(layer, self.version(layer, table) or table)

    def _replace(self, df: DataFrame, layer: str, table: str) -> int:
        current, name = self.version(layer, table), self.name(layer, table)
        number = int(current.rsplit("_", 2)[-2]) + 1 if current else 1
        new = f"{table}__{number:06d}_{uuid.uuid4().hex[:8]}"
        rows = self._write(df, self.name(layer, new), table, "errorifexists")
        if current is None and self.exists(layer, table):  # a table that this class did not write
            self.spark.sql(f"DROP TABLE {name}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSION}' = '{new.removeprefix(f'{table}__')}') AS SELECT * FROM {self.name(layer, new)}")
        shown = self.spark.sql(f"SHOW TABLES IN {self.prefix}_{layer} LIKE '{table}__*_*'").collect()
        numbers = {row.tableName: re.fullmatch(rf"{re.escape(table)}__(\d+)_[0-9a-f]{{8}}", row.tableName) for row in shown}
        for old, found in numbers.items():
            if found and old != new and not 0 < number - int(found[1]) <= self.kept_versions:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, old)}")
        return rows

    def _replace_days(self, df: DataFrame, name: str, day: str, days: list[date]) -> None:
        """Write the days to a new folder of the stored table and point its partitions there, one by one."""
        root = self.spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first().data_type.rstrip("/")
        folder = f"{root}/_merge-{uuid.uuid4().hex}"
        with setting(self.spark, *INSTANTS), setting(self.spark, *PACKED), setting(self.spark, _CLEANUP, "true"):
            df.hint("rebalance", day).write.partitionBy(day).parquet(folder)
        there = {row.partition for row in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}
        added = [f"PARTITION ({day} = DATE'{value}') LOCATION '{folder}/{day}={value}'" for value in days if f"{day}={value}" not in there]
        if added:
            self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(added)}")
        for value in (value for value in days if f"{day}={value}" in there):
            part, new = f"PARTITION ({day} = DATE'{value}')", f"{folder}/{day}={value}"
            old = self.spark.sql(f"DESCRIBE EXTENDED {name} {part}").where("col_name = 'Location'").first().data_type
            self.spark.sql(f"ALTER TABLE {name} {part} SET LOCATION '{new}'")
            self._drop_unused(root, f"{day}={value}", {_path(old), _path(new)})
        self.spark.catalog.refreshTable(name)

    def _drop_unused(self, root: str, part: str, used: set[str]) -> None:
        """Delete the folders of a day that merges before the last one replaced."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(root)
        files: JavaObject = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for pattern in (f"{root}/{part}", f"{root}/_merge-*/{part}"):
            for found in files.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(pattern)) or []:
                if _path(found.getPath().toString()) not in used:
                    files.delete(found.getPath(), True)

    def _write(self, df: DataFrame, name: str, table: str, mode: str) -> int:
        day = self.day_columns.get(table)
        # Few files per day; a day with much of the data is split over several tasks.
        balanced = df.hint("rebalance", day) if day else df
        # Observed in the writing tasks, so that a repeated earlier stage is not counted.
        written = Observation()
        writer = balanced.observe(written, F.count(F.lit(1)).alias("rows")).write.mode(mode)
        if day:
            writer = writer.partitionBy(day)
        with setting(self.spark, *INSTANTS), setting(self.spark, *PACKED), setting(self.spark, _CLEANUP, "true"):
            writer.saveAsTable(name)
        return written.get["rows"]


def _merged(loaded: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    kept = loaded.join(changes.select(*key), list(key), "left_anti")
    return kept.select(loaded.columns).unionByName(changes.select(loaded.columns))


def _path(location: str) -> str:
    """The location without its scheme, however it is written."""
    return "/" + location.split(":", 1)[-1].strip("/")


def full_refresh_load(df: DataFrame, path: str) -> int:
    """Replace the parquet files at `path`, which `df` must not read; returns the rows written."""
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return written.get["rows"]
