"""Exactly-once output of a stream into several tables of the raw layer.

A micro-batch writes one partition batch_id=N of every table and then one ledger file N.json, by
renaming it into place. The rename is the commit: readers take the batches up to the newest ledger
file, so a batch is in all tables or in none. A batch that was stopped before its commit is written
anew as a whole; one that is repeated after it is left alone.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from velolake.schemas import DEAD_LETTERS, RAW_STATION_STATUS
from velolake.sources.tables import Layers
from velolake.streaming.events import dead_letters, valid_events, validate_events
from velolake.streaming.queries import SNAPSHOT_PERIOD, _start

LEDGER_SCHEMA = "sink string, batch_id long, files long, rows long, source string"
STATUS_TABLES = {"station_status": RAW_STATION_STATUS, "station_status_dlq": DEAD_LETTERS}


class BatchLedger:
    """The committed micro-batches of one stream, as files <batch_id>.json in a folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _path(self, name: str = "") -> JavaObject:
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _files(self) -> JavaObject:
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _batches(self) -> Iterator[int]:
        files = self._files()
        if files.exists(self._path()):
            for status in files.listStatus(self._path()):
                name = status.getPath().getName()
                if name.removesuffix(".json").isdigit():
                    yield int(name.removesuffix(".json"))

    def newest(self) -> int:
        """The newest committed batch, -1 before the first; from the names of the files alone."""
        return max(self._batches(), default=-1)

    def holds(self, batch_id: int) -> bool:
        return self._files().exists(self._path(f"{batch_id}.json"))

    def commit(self, batch_id: int, source: str, written: dict[str, tuple[int, int]]) -> None:
        """Commit the batch: for each table, the numbers of files and rows that it wrote."""
        lines = [json.dumps({"sink": sink, "batch_id": batch_id, "files": files, "rows": rows, "source": source}) for sink, (files, rows) in written.items()]
        files, draft = self._files(), self._path(f".{batch_id}.draft")
        out = files.create(draft, True)
        try:
            out.write(bytearray("\n".join(lines).encode()))
        finally:
            out.close()
        if not files.rename(draft, self._path(f"{batch_id}.json")) and not self.holds(batch_id):
            raise OSError(f"batch {batch_id} could not be committed in {self.folder}")

    def entries(self) -> DataFrame:
        """sink, batch_id, files, rows, source of every committed batch."""
        if self.newest() < 0:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).json(f"{self.folder}/*.json")

    def source(self) -> str | None:
        """The checkpoint of the stream that commits here."""
        first = min(self._batches(), default=None)
        if first is None:
            return None
        return self.spark.read.schema(LEDGER_SCHEMA).json(f"{self.folder}/{first}.json").first().source


def status_ledger(layers: Layers) -> BatchLedger:
    """The ledger of raw.station_status and raw.station_status_dlq."""
    return BatchLedger(layers.spark, f"{layers.root}/{layers.prefix}_raw/_ledger_station_status")


def create_batch_table(layers: Layers, table: str, schema: T.StructType) -> None:
    """The raw table, partitioned by micro-batch, if it is not there."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    layers.spark.sql(f"CREATE TABLE IF NOT EXISTS {layers.name('raw', table)} ({columns}, batch_id BIGINT) USING parquet PARTITIONED BY (batch_id)")


def write_partition(layers: Layers, table: str, df: DataFrame, batch_id: int) -> tuple[int, int]:
    """Replace the batch's partition of the table; returns its numbers of files and rows."""
    name = layers.name("raw", table)
    path = f"{_location(layers, name)}/batch_id={batch_id}"
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    layers.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (batch_id = {batch_id}) LOCATION '{path}'")
    layers.spark.catalog.refreshTable(name)
    folder = layers.spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = folder.getFileSystem(layers.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    return sum(status.getPath().getName().startswith("part-") for status in listed), written.get["rows"]


def _location(layers: Layers, name: str) -> str:
    rows = layers.spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0].data_type.rstrip("/")


def committed(layers: Layers, table: str, schema: T.StructType) -> DataFrame:
    """Rows of a raw table that readers may see: those of committed batches, or all where no stream writes it."""
    rows = layers.read_or_empty("raw", table, schema)
    if "batch_id" not in rows.columns:
        return rows
    return rows.where(F.col("batch_id") <= status_ledger(layers).newest()).drop("batch_id")


def stream_to_raw(messages: DataFrame, layers: Layers, checkpoint: str, period: str | None = SNAPSHOT_PERIOD) -> StreamingQuery:
    """Validate the messages once per batch into raw.station_status and raw.station_status_dlq, each batch exactly once.

    The ledger belongs to one checkpoint: another one numbers its batches anew, and is refused.
    """
    ledger = status_ledger(layers)
    known = ledger.source()
    if known not in (None, checkpoint):
        raise ValueError(f"the tables were written with the checkpoint {known}")
    for table, schema in STATUS_TABLES.items():
        create_batch_table(layers, table, schema)

    def split(batch: DataFrame, batch_id: int) -> None:
        if ledger.holds(batch_id):
            return
        validated = validate_events(batch).persist()
        try:
            valid = valid_events(validated).select(*RAW_STATION_STATUS.names)
            # Dead letters are few in most batches: rebalancing gives them few files.
            dead = dead_letters(validated).select(*DEAD_LETTERS.names).hint("rebalance")
            written = {"station_status": write_partition(layers, "station_status", valid, batch_id),
                       "station_status_dlq": write_partition(layers, "station_status_dlq", dead, batch_id)}
        finally:
            validated.unpersist()
        ledger.commit(batch_id, checkpoint, written)

    return _start(messages.writeStream.foreachBatch(split), checkpoint, period)
