"""Realtime refresh: freshness -> staging -> intermediate -> status fact -> live mart.

Reads what the streaming split appended to the raw layer and loads only snapshots
that are newer than the status fact.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from velolake.operators import marts, quality, staging, status
from velolake.plans.batch import AUDIT_TABLE
from velolake.schemas import DEAD_LETTERS, RAW_STATION_STATUS
from velolake.session import stored, use_library_settings
from velolake.sources.tables import Layers
from velolake.streaming.ledger import committed


@dataclass
class RealtimeRefresh:
    """One refresh at the instant `now` over raw.station_status and mart.dim_station.

    Loads always read what is newer than the status fact, and the live mart what is newer than
    itself, so a refresh that was missed or that failed is made up for by the next. Checks read
    the whole tables or, with a `window`, only the snapshots of the trailing time.
    """

    layers: Layers
    now: datetime | None = None
    run_id: str | None = None
    dag_id: str = "realtime_refresh"
    window: timedelta | None = None

    def __post_init__(self) -> None:
        use_library_settings(self.layers.spark)
        self.now = self.now or datetime.now(timezone.utc)

    def raw(self) -> DataFrame:
        """The raw snapshots to check."""
        return self._recent(self._arrived())

    def staged(self) -> DataFrame:
        return staging.stage_station_status(self.raw())

    def clean(self) -> DataFrame:
        return status.clean_station_status(self.staged())

    def loadable(self) -> DataFrame:
        """Clean snapshots of any age."""
        return status.clean_station_status(staging.stage_station_status(self._arrived()))

    def check_raw(self) -> int:
        """Raises when the feed is empty, faulty or stale."""
        return quality.require_raw_status(self.raw(), self.now)

    def check_dead_letters(self) -> str:
        """PASS or WARN, kept as an audit row; no table means no dead letters."""
        letters = committed(self.layers, "station_status_dlq", DEAD_LETTERS)
        recent = quality.recent_dead_letters(letters, self.now)
        checked = recent.select(
            F.lit("STREAMING_RAW").alias("layer"),
            F.lit("station_status_dlq").alias("table_name"),
            F.lit("recent_dead_letters").alias("check_name"),
            F.col("dead_letters").cast("string").alias("actual_value"),
            F.lit(f"<= {quality.DEAD_LETTER_LIMIT}").alias("expected_value"),
            "status",
            F.concat(F.lit("recent_dead_letters: "), F.col("dead_letters").cast("string")).alias("message"),
        )
        return self._gate("STREAMING_RAW", checked)[0].status

    def load_fact(self, mode: str = "watermark") -> int:
        """Bring the status fact up to date; returns the rows added or replaced.

        "watermark" and "by_key" append, see status.increment. "merge" takes everything ingested
        since the last load and replaces loaded snapshots of the same station and instant.
        """
        stations = self.layers.read("mart", "dim_station")
        if mode == "merge":
            empty = status.fact_station_status(self.loadable(), stations).schema
            new = status.corrections(self.loadable(), stations, self.layers.read_or_empty("mart", "fact_station_status", empty))
            return self.layers.merge(new, "mart", "fact_station_status", status.STATUS_KEY)
        if not self.layers.exists("mart", "fact_station_status"):
            return self.layers.append(status.fact_station_status(self.loadable(), stations), "mart", "fact_station_status")
        loaded, newest_day = self._loaded()
        new = status.increment(self.loadable(), stations, loaded, mode, newest_day)
        return self.layers.append(new, "mart", "fact_station_status")

    def build_live(self) -> int:
        """Rebuild the live mart from the whole fact."""
        fact, stations = self.layers.read("mart", "fact_station_status"), self.layers.read("mart", "dim_station")
        return self.layers.refresh(marts.mart_station_live(fact, stations), "mart", "mart_station_live")

    def update_live(self) -> int:
        """Bring the live mart up to date with the snapshots that are newer than its own."""
        live, stations = self.layers.read("mart", "mart_station_live"), self.layers.read("mart", "dim_station")
        newest = live.agg(F.max(F.unix_micros("snapshot_timestamp"))).first()[0]
        since = status.EPOCH if newest is None else status.EPOCH + timedelta(microseconds=newest)
        new = status.newer_than(self.layers.read("mart", "fact_station_status"), since)
        # A table cannot be replaced while it is read; the live mart has one row per station.
        updated = stored(marts.refreshed_station_live(live, new, stations), "mart_station_live")
        return self.layers.refresh(updated, "mart", "mart_station_live")

    def run(self, mode: str = "watermark", live: str = "rebuild") -> dict[str, int]:
        """All steps in order; returns the rows written per table.

        `live` is "rebuild", or "update" to read only the snapshots newer than the live mart,
        which needs the "watermark" mode and stations that stay the same.
        """
        update = live == "update" and mode == "watermark" and self.layers.exists("mart", "mart_station_live")
        self.check_raw()
        self.check_dead_letters()
        self._gate("STREAMING_STAGING", quality.check_staged_status(self.staged()))
        self._gate("STREAMING_INTERMEDIATE", quality.check_clean_status(self.clean()))
        rows = {"fact_station_status": self.load_fact(mode)}
        fact = self._recent(self.layers.read("mart", "fact_station_status"))
        self._gate("STREAMING_WAREHOUSE", quality.check_status_fact(fact))
        rows["mart_station_live"] = self.update_live() if update else self.build_live()
        self._gate("STREAMING_ANALYTICS", quality.check_station_live(self.layers.read("mart", "mart_station_live")))
        return rows

    def _arrived(self) -> DataFrame:
        return committed(self.layers, "station_status", RAW_STATION_STATUS)

    def _recent(self, status_rows: DataFrame) -> DataFrame:
        return status.newer_than(status_rows, self.now - self.window) if self.window else status_rows

    def _loaded(self) -> tuple[DataFrame, date | None]:
        table = ("mart", "fact_station_status")
        return self.layers.read(*table), self.layers.newest_day(*table)

    def _gate(self, layer: str, checked: DataFrame) -> list[Row]:
        return quality.finish_gate(layer, checked, self.layers.name("audit", AUDIT_TABLE), self.run_id, self.dag_id)
