"""Streaming queries: validated split, status fact, live status, dead-letter windows.

Every sink is written by micro-batch into a folder batch_id=N that is replaced as a
whole, so a batch that is repeated after a failure leaves the same rows once. A sink and
its checkpoint belong together: with a new checkpoint, start a new sink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from velolake.operators.status import fact_station_status, first_of_each, not_loaded
from velolake.schemas import COUNT_FIELDS, FLAG_FIELDS
from velolake.streaming.events import dead_letters, valid_events, validate_events
from velolake.streaming.publish import fan_out_snapshot

SNAPSHOT_PERIOD = "60 seconds"


def _start(writer: DataStreamWriter, checkpoint: str, period: str | None) -> StreamingQuery:
    """Run every `period`, or, without one, take everything available and stop."""
    trigger = {"processingTime": period} if period else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def write_batch(df: DataFrame, path: str, batch_id: int, *partitions: str) -> None:
    """Replace one micro-batch of a sink, laid out as path/batch_id=N[/partition=...]."""
    df.write.mode("overwrite").partitionBy(*partitions).parquet(f"{path}/batch_id={batch_id}")


def stream_split(messages: DataFrame, valid_path: str, dead_letter_path: str, checkpoint: str,
                 period: str | None = SNAPSHOT_PERIOD) -> StreamingQuery:
    """Validate the messages once per batch and append both outcomes to their tables."""

    def split(batch: DataFrame, batch_id: int) -> None:
        validated = validate_events(batch).persist()
        try:
            write_batch(valid_events(validated), valid_path, batch_id)
            # Dead letters are few in most batches: rebalancing gives them few files.
            write_batch(dead_letters(validated).hint("rebalance"), dead_letter_path, batch_id)
        finally:
            validated.unpersist()

    return _start(messages.writeStream.foreachBatch(split), checkpoint, period)


def stream_publish(payloads: DataFrame, path: str, checkpoint: str, period: str | None = SNAPSHOT_PERIOD) -> StreamingQuery:
    """Publish each arriving feed document as one message line per station with an id.

    A document that is no feed goes to the folder <path>-rejected and the stream goes on. The
    observed metrics `publishing` count published and skipped stations and rejected documents.
    """
    messages = fan_out_snapshot(payloads, strict=False)
    has_value, rejected = F.col("value").isNotNull(), F.col("bad_document").isNotNull()
    counted = messages.observe(
        "publishing", F.count_if(has_value).alias("published"), F.count_if(~has_value & ~rejected).alias("skipped"),
        F.count_if(rejected).alias("rejected")
    )

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batch.where(has_value).select("value").write.mode("overwrite").text(f"{path}/batch_id={batch_id}")
            bad = batch.where(rejected).select("bad_document")
            if not bad.isEmpty():
                write_batch(bad, f"{path}-rejected", batch_id)
        finally:
            batch.unpersist()

    return _start(counted.where(has_value | rejected).writeStream.foreachBatch(publish), checkpoint, period)


def stream_valid_events(messages: DataFrame) -> DataFrame:
    """Valid events of a message stream, as a stream."""
    return valid_events(validate_events(messages))


def stream_status_fact(status: DataFrame, stations: DataFrame, path: str, checkpoint: str,
                       period: str | None = SNAPSHOT_PERIOD) -> StreamingQuery:
    """Append valid snapshots of known stations to the fact, each (station, snapshot) once.

    A batch drops its own repeats, combining them on the map side, and what earlier batches
    wrote for the same days, however late it comes. A repeated batch compares with the
    batches before it only, so it writes the same rows again.
    """
    schema = T.StructType([*fact_station_status(status, stations).schema.fields, T.StructField("batch_id", T.LongType())])

    def append(batch: DataFrame, batch_id: int) -> None:
        new = first_of_each(fact_station_status(batch, stations)).persist()
        try:
            if batch_id > 0:
                written = batch.sparkSession.read.schema(schema).parquet(path)
                fresh = not_loaded(new, written.where(F.col("batch_id") < batch_id))
            else:
                fresh = new
            write_batch(fresh.hint("rebalance", "snapshot_date"), path, batch_id, "snapshot_date")
        finally:
            new.unpersist()

    return _start(status.writeStream.foreachBatch(append), checkpoint, period)


def stream_station_live(status: DataFrame, path: str, checkpoint: str,
                        period: str | None = SNAPSHOT_PERIOD) -> StreamingQuery:
    """Keep the newest snapshot per station in state and write the stations that changed."""
    details = F.struct("snapshot_timestamp", "_ingested_at", *COUNT_FIELDS, *FLAG_FIELDS, "last_reported")
    newest = status.groupBy("station_id").agg(F.max(details).alias("newest")).select("station_id", "newest.*")

    def changes(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)

    return _start(newest.writeStream.outputMode("update").foreachBatch(changes), checkpoint, period)


def station_live_table(changes: DataFrame) -> DataFrame:
    """The newest change per station of what stream_station_live wrote."""
    columns = [name for name in changes.columns if name not in ("station_id", "batch_id")]
    newest = changes.groupBy("station_id").agg(F.max_by(F.struct(*columns), "batch_id").alias("newest"))
    return newest.select("station_id", "newest.*")


def dead_letter_windows(letters: DataFrame, length: str = "5 minutes", late_by: str | None = None) -> DataFrame:
    """Dead letters per window; a stream needs `late_by` to close its windows."""
    if late_by:
        letters = letters.withWatermark("detected_at", late_by)
    window: Column = F.window("detected_at", length)
    return letters.groupBy(window.alias("window")).agg(F.count(F.lit(1)).alias("dead_letters")).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "dead_letters",
    )
