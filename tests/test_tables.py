"""Refreshes that swap versions, and merges that rewrite touched days only."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_status import NOON, at
from tests.test_status import raw as raw_status
from tests.test_status import stations as stations
from velolake.plans.realtime import RealtimeRefresh


def facts(spark, *rows):
    return spark.createDataFrame([(k, v, date(2026, 1, d)) for k, v, d in rows], "id long, v string, date_key date")


def found(df):
    return sorted((r.id, r.v, r.date_key.day) for r in df.collect())


def test_reader_from_before_a_refresh_finishes(spark, layers):
    layers.refresh(spark.range(5), "mart", "t")
    before = layers.read("mart", "t")
    layers.refresh(spark.range(3), "mart", "t")
    assert before.count() == 5 and layers.read("mart", "t").count() == 3
    first = layers.version("mart", "t")
    for n in (7, 8, 9):
        layers.refresh(spark.range(n), "mart", "t")
    stored = {r.tableName for r in spark.sql(f"SHOW TABLES IN {layers.prefix}_mart").collect()}
    assert first not in stored and layers.version("mart", "t") in stored and len(stored) == 3  # view, newest, the one before


def test_failed_refresh_leaves_the_table(spark, layers):
    layers.refresh(spark.range(5), "mart", "t")
    broken = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        layers.refresh(broken, "mart", "t")
    assert layers.read("mart", "t").count() == 5
    assert layers.refresh(spark.range(2), "mart", "t") == 2 and layers.read("mart", "t").count() == 2


def test_reader_during_a_refresh_sees_a_whole_table(spark, layers, monkeypatch):
    layers.refresh(spark.range(5), "mart", "t")
    seen, write = [], type(layers)._write

    def watched(self, *args):
        rows = write(self, *args)
        seen.append(layers.read("mart", "t").count())
        return rows

    monkeypatch.setattr(type(layers), "_write", watched)
    layers.refresh(spark.range(2), "mart", "t")
    assert seen == [5] and layers.read("mart", "t").count() == 2


def test_refresh_replaces_a_table_of_other_origin(spark, layers):
    spark.range(4).write.saveAsTable(layers.name("mart", "t"))
    assert layers.version("mart", "t") is None
    layers.append(spark.range(1), "mart", "t")
    assert layers.read("mart", "t").count() == 5
    layers.refresh(spark.range(2), "mart", "t")
    assert layers.read("mart", "t").count() == 2 and layers.version("mart", "t")


def test_similar_names_are_other_tables(spark, layers):
    for table in ("t", "t_x", "t__y"):
        for n in (1, 2, 3):
            layers.refresh(spark.range(n), "mart", table)
    assert [layers.read("mart", table).count() for table in ("t", "t_x", "t__y")] == [3, 3, 3]


def test_merge_by_day(spark, layers):
    table = ("mart", "fact_trips")
    layers.append(facts(spark, (1, "a", 1), (2, "a", 1), (3, "a", 2), (4, "a", 3)), *table)
    untouched = set(layers.read(*table).where("date_key = date'2026-01-02'").inputFiles())
    replaced = layers.read(*table).where("date_key = date'2026-01-01'").inputFiles()
    changes = facts(spark, (2, "b", 1), (5, "b", 1), (6, "b", 4))
    assert layers.merge(changes, *table, ["id"]) == 3
    expected = [(1, "a", 1), (2, "b", 1), (3, "a", 2), (4, "a", 3), (5, "b", 1), (6, "b", 4)]
    assert found(layers.read(*table)) == expected
    assert found(spark.read.schema(changes.schema).option("basePath", replaced[0].split("/date_key=")[0]).parquet(*replaced)) == [
        (1, "a", 1), (2, "a", 1)]  # what a running reader has planned to read
    assert set(layers.read(*table).where("date_key = date'2026-01-02'").inputFiles()) == untouched
    assert layers.merge(changes, *table, ["id"]) == 3 and found(layers.read(*table)) == expected
    assert layers.merge(facts(spark, (1, "c", 1)), *table, ["id"]) == 1
    assert found(layers.read(*table)) == [(1, "c", 1), *expected[1:]]
    assert layers.merge(facts(spark), *table, ["id"]) == 0 and layers.newest_day(*table) == date(2026, 1, 4)
    layers.append(facts(spark, (7, "d", 4)), *table)
    assert found(layers.read(*table))[-1] == (7, "d", 4) and layers.read(*table).count() == 7


def test_merge_keeps_the_last_two_folders_of_a_day(spark, layers, tmp_path):
    table = ("mart", "fact_trips")
    layers.append(facts(spark, (1, "a", 1)), *table)
    for v in "bcde":
        layers.merge(facts(spark, (1, v, 1)), *table, ["id"])
    assert len(list(tmp_path.rglob("date_key=2026-01-01"))) == 2
    assert found(layers.read(*table)) == [(1, "e", 1)]


def test_merge_reads_the_touched_days_only(spark, layers):
    table = ("mart", "fact_trips")
    layers.append(facts(spark, *((i, "a", 1 + i % 9) for i in range(90))), *table)
    for file in layers.read(*table).where("date_key > date'2026-01-02'").inputFiles():
        with open(file.removeprefix("file://"), "wb") as broken:
            broken.write(b"not read")
    assert layers.merge(facts(spark, (0, "b", 1), (1, "b", 2)), *table, ["id"]) == 2
    assert layers.read(*table).where("date_key <= date'2026-01-02' AND v = 'b'").count() == 2


def test_merge_refuses_shared_keys_and_takes_whole_tables(spark, layers):
    with pytest.raises(ValueError):
        layers.merge(facts(spark, (1, "a", 1), (1, "b", 1)), "mart", "t", ["id"])
    assert layers.merge(facts(spark, (1, "a", 1), (2, "a", 1)), "mart", "t", ["id"]) == 2
    assert layers.merge(facts(spark, (2, "b", 5)), "mart", "t", ["id"]) == 1
    assert found(layers.read("mart", "t")) == [(1, "a", 1), (2, "b", 5)]


def test_realtime_refresh_merges_corrections(spark, layers, stations):
    def load(minute, *changes):
        ingested = {"_ingested_at": NOON + timedelta(minutes=minute)}
        layers.append(raw_status(spark, *({**ingested, **change} for change in changes)), "raw", "station_status")
        return RealtimeRefresh(layers, NOON + timedelta(minutes=minute)).run(mode="merge")

    layers.refresh(stations, "mart", "dim_station")
    assert load(1, at(0), {**at(0), "station_id": "g2"}) == {"fact_station_status": 2, "mart_station_live": 2}
    # a correction, a late row, a new one, and what was ingested at the instant of the newest row once more
    assert load(9, {**at(0), "num_bikes_available": 8}, at(-2000), at(5))["fact_station_status"] == 4
    fact = layers.read("mart", "fact_station_status")
    assert fact.count() == 4
    assert [r.num_bikes_available for r in fact.where((F.col("station_key") == "k1") & (F.col("snapshot_timestamp") == F.lit(NOON))).collect()] == [8]
