"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3). Every time is the median of the runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from velolake.operators import dashboard, marts, quality, status
from velolake.registry.queries import QUERIES
from velolake.registry.sample import Sample
from velolake.session import build_session, scratch_dir, stored
from velolake.sources import streams
from velolake.streaming.queries import stream_split

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def run(df: DataFrame) -> None:
    """Compute every row without collecting any."""
    df.write.format("noop").mode("overwrite").save()


def seconds(action: Callable[[], object]) -> float:
    action()
    times = []
    for _ in range(RUNS):
        started = time.perf_counter()
        action()
        times.append(time.perf_counter() - started)
    return round(statistics.median(times), 3)


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def batch_chain() -> None:
        """Raw trips to all four marts, with the stored tables in between."""
        sample = Sample(spark, FOLDER, share=False)
        fact = sample.stored_fact_trips
        for mart in (sample.mart_daily_rides(fact), sample.mart_hourly_rides(fact),
                     sample.mart_station_performance(fact), sample.mart_station_live):
            run(mart)

    times["batch_chain_raw_to_marts"] = seconds(batch_chain)
    for name in ("stg_trips", "int_trips_clean", "int_trips_invalid", "reject_reason_counts", "dq_stg_trips"):
        times[name] = seconds(lambda name=name: run(QUERIES[name](spark, FOLDER)))

    sample = Sample(spark, FOLDER)
    fact, dimensions = sample.stored_fact_trips, sample.dimensions
    times["dim_station"] = seconds(lambda: run(Sample(spark, FOLDER, share=False).dim_station))
    times["fact_trips"] = seconds(lambda: run(sample.fact_trips))
    times["mart_daily_rides"] = seconds(lambda: run(sample.mart_daily_rides(fact)))
    times["mart_hourly_rides"] = seconds(lambda: run(sample.mart_hourly_rides(fact)))
    times["mart_station_performance"] = seconds(lambda: run(sample.mart_station_performance(fact)))
    times["dashboard_kpis"] = seconds(lambda: run(dashboard.kpis(fact, sample.dim_rider_type)))
    times["dq_fact_trips"] = seconds(lambda: run(quality.check_fact_trips(fact, sample.stored_trips, dimensions)))

    snapshots = stored(sample.int_station_status, "int_station_status")
    statuses = stored(sample.fact_station_status, "fact_station_status")
    times["fact_station_status"] = seconds(lambda: run(status.fact_station_status(snapshots, sample.dim_station)))
    times["mart_station_live"] = seconds(lambda: run(marts.mart_station_live(statuses, sample.dim_station)))
    times["validate_events_batch"] = seconds(lambda: run(QUERIES["validate_events_batch"](spark, FOLDER)))

    messages = scratch_dir(spark, "messages")
    sample.status_events.select("value").repartition(int(CPUS)).write.text(messages)
    events = spark.read.text(messages).count()

    def split() -> None:
        root = scratch_dir(spark, "split")
        source = streams.message_files(spark, messages)
        stream_split(source, f"{root}/valid", f"{root}/dead", f"{root}/checkpoint", period=None).awaitTermination()

    times["stream_split"] = seconds(split)

    print(json.dumps({
        "metric": "headline queries, sum of median seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")),
        "stream_split_events_per_sec": round(events / times["stream_split"]),
    }))


if __name__ == "__main__":
    main()
