"""The exactly-once output of the stream into the raw layer."""

import pytest
from pyspark.errors import StreamingQueryException

from tests.test_events import event, write_messages
from velolake.schemas import DEAD_LETTERS, RAW_STATION_STATUS
from velolake.session import scratch_dir
from velolake.sources import streams
from velolake.streaming import ledger

GOOD = [event(snapshot_timestamp=f"2026-01-01T00:0{i}:00Z") for i in range(5)]
BAD = ["no json", "[]"]


def run(spark, layers, root):
    source = streams.message_files(spark, f"{root}/in", files_per_batch=1)
    ledger.stream_to_raw(source, layers, f"{root}/checkpoint", period=None).awaitTermination()


def seen(layers):
    valid = ledger.committed(layers, "station_status", RAW_STATION_STATUS)
    dead = ledger.committed(layers, "station_status_dlq", DEAD_LETTERS)
    return sorted(r.snapshot_timestamp.minute for r in valid.collect()), sorted(r.raw_payload for r in dead.collect())


def test_each_batch_is_in_both_tables_once(spark, layers):
    root = scratch_dir(spark, "to-raw")
    assert seen(layers) == ([], [])
    write_messages(spark, f"{root}/in", GOOD[:3] + BAD[:1])
    run(spark, layers, root)
    assert seen(layers) == ([0, 1, 2], ["no json"])
    write_messages(spark, f"{root}/in", GOOD[3:] + BAD[1:])
    for _ in range(2):
        run(spark, layers, root)
    assert seen(layers) == ([0, 1, 2, 3, 4], ["[]", "no json"])
    rows = {(r.sink, r.batch_id): r["rows"] for r in ledger.status_ledger(layers).entries().collect()}
    assert rows == {("station_status", 0): 3, ("station_status_dlq", 0): 1, ("station_status", 1): 2, ("station_status_dlq", 1): 1}
    assert layers.read("raw", "station_status").columns == [*RAW_STATION_STATUS.names, "batch_id"]


@pytest.mark.parametrize("broken", ["station_status", "station_status_dlq", "commit"])
def test_a_batch_that_is_stopped_is_unseen_and_then_whole(spark, layers, monkeypatch, broken):
    """Stopped before the first write, between the writes, or before the commit."""
    root = scratch_dir(spark, "to-raw")
    write_messages(spark, f"{root}/in", GOOD[:2] + BAD[:1])
    run(spark, layers, root)
    write_messages(spark, f"{root}/in", GOOD[2:] + BAD[1:])
    with monkeypatch.context() as patch:
        write, commit = ledger.write_partition, ledger.BatchLedger.commit

        def stop_write(where, table, df, batch_id):
            if table == broken:
                raise RuntimeError("stopped")
            return write(where, table, df, batch_id)

        def stop_commit(self, *arguments):
            if broken == "commit":
                raise RuntimeError("stopped")
            return commit(self, *arguments)

        patch.setattr(ledger, "write_partition", stop_write)
        patch.setattr(ledger.BatchLedger, "commit", stop_commit)
        with pytest.raises(StreamingQueryException):
            run(spark, layers, root)
    assert seen(layers) == ([0, 1], ["no json"])
    run(spark, layers, root)
    assert seen(layers) == ([0, 1, 2, 3, 4], ["[]", "no json"])


def test_a_committed_batch_is_not_written_again(spark, layers):
    entries = ledger.status_ledger(layers)
    assert entries.newest() == -1 and entries.source() is None and entries.entries().count() == 0
    entries.commit(0, "x", {"station_status": (1, 5)})
    entries.commit(0, "x", {"station_status": (1, 5)})
    assert entries.holds(0) and not entries.holds(1)
    entries.commit(10, "x", {"station_status": (1, 7)})
    entries.commit(9, "x", {"station_status": (1, 6)})
    assert entries.newest() == 10
    assert sorted(r["rows"] for r in entries.entries().collect()) == [5, 6, 7]


def test_another_checkpoint_is_refused(spark, layers):
    root = scratch_dir(spark, "to-raw")
    write_messages(spark, f"{root}/in", GOOD)
    run(spark, layers, root)
    source = streams.message_files(spark, f"{root}/in")
    with pytest.raises(ValueError, match="checkpoint"):
        ledger.stream_to_raw(source, layers, f"{root}/other", period=None)


def test_reader_plans_leave_uncommitted_batches_out(spark, layers):
    root = scratch_dir(spark, "to-raw")
    write_messages(spark, f"{root}/in", GOOD)
    run(spark, layers, root)
    plan = ledger.committed(layers, "station_status", RAW_STATION_STATUS)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan
