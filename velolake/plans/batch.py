"""Daily batch: raw tables -> staging -> intermediate -> warehouse -> analytics.

Staged, clean and rejected rows are published as tables of their layers, so raw trips are read once
and every later step reads a stored table, pruned to the columns it needs. Each layer ends with its
gate, which appends its checks to the audit table, and then its schema tests (declared columns that
are not NULL, unique, of accepted values, or keys of a parent), which have a table of their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from velolake.operators import marts, quality, staging, stations, trips, warehouse
from velolake.session import _CLEANUP, setting, stored, use_library_settings
from velolake.sources.station_feed import require_stations
from velolake.sources.tables import Layers

AUDIT_TABLE = "quality_audit"
TESTS_TABLE = "schema_tests"

# The tables that the schema tests of a layer read.
TESTED = {
    "STAGING": (("staging", "stg_trips"), ("staging", "stg_station_information")),
    "INTERMEDIATE": (("intermediate", "int_trips_clean"), ("intermediate", "int_trips_invalid"),
                     ("intermediate", "int_station_information_clean")),
    "WAREHOUSE": (("mart", "dim_date"), ("mart", "dim_station"), ("mart", "dim_rider_type"), ("mart", "dim_bike_type"),
                  ("mart", "fact_trips")),
    "ANALYTICS": (("mart", "mart_daily_rides"), ("mart", "mart_hourly_rides"), ("mart", "mart_station_performance")),
}


@dataclass
class BatchRun:
    """One run over the raw tables `raw_trips` and `station_information`.

    `mode` chooses the rejected set, see trips.rejected_trips. In "reference" mode the
    intermediate gate fails when a trip is neither clean nor rejected. `on_failure` is "stop",
    or "record" to keep every result of gates and schema tests and go on.
    """

    layers: Layers
    run_id: str | None = None
    dag_id: str = "daily_batch"
    mode: str = "reference"
    rows: dict[str, int] = field(default_factory=dict)
    published: dict[str, int] = field(default_factory=dict)
    on_failure: str = "stop"

    def __post_init__(self) -> None:
        if self.on_failure not in ("stop", "record"):
            raise ValueError(f"unknown on_failure: {self.on_failure}")

    def load_raw(self, raw_trips: DataFrame, station_information: DataFrame) -> None:
        use_library_settings(self.layers.spark)
        self._refresh(raw_trips, "raw", "raw_trips")
        self._refresh(require_stations(station_information), "raw", "station_information")

    def build_staging(self) -> None:
        raw = {name: self.layers.read("raw", name) for name in ("raw_trips", "station_information")}
        self._publish(staging.stage_trips(raw["raw_trips"]), "staging", "stg_trips")
        self._publish(staging.stage_station_information(raw["station_information"]), "staging", "stg_station_information")

    def build_intermediate(self) -> None:
        clean, rejected = trips.split_trips(self.staged_trips(), self.mode)
        self._publish(clean, "intermediate", "int_trips_clean")
        self._publish(rejected, "intermediate", "int_trips_invalid")
        self._publish(stations.clean_station_information(self.staged_stations()), "intermediate", "int_station_information_clean")

    def staged_trips(self) -> DataFrame:
        return self.layers.read("staging", "stg_trips")

    def staged_stations(self) -> DataFrame:
        return self.layers.read("staging", "stg_station_information")

    def clean_trips(self) -> DataFrame:
        return self.layers.read("intermediate", "int_trips_clean")

    def rejected_trips(self) -> DataFrame:
        return self.layers.read("intermediate", "int_trips_invalid")

    def clean_stations(self) -> DataFrame:
        return self.layers.read("intermediate", "int_station_information_clean")

    def check_staging(self) -> None:
        tally = self._tally(self.staged_trips())
        self._gate("STAGING", {"stg_trips": tally}, quality.check_staged_trips(self.staged_trips(), tally=tally),
                   quality.check_staged_station_information(self.staged_stations()))

    def check_intermediate(self) -> None:
        tally = self._tally(self.clean_trips())
        self._gate("INTERMEDIATE", {"int_trips_clean": tally},
                   quality.check_split_trips(self.staged_trips(), self.clean_trips(), self.rejected_trips(), tally=tally),
                   quality.check_station_information(self.clean_stations()))

    def build_warehouse(self) -> None:
        spark = self.layers.spark
        self._refresh(warehouse.dim_date(self.clean_trips()), "mart", "dim_date")
        self._refresh(stations.dim_station(self.clean_stations(), self.clean_trips()), "mart", "dim_station")
        self._refresh(warehouse.dim_rider_type(spark), "mart", "dim_rider_type")
        self._refresh(warehouse.dim_bike_type(spark), "mart", "dim_bike_type")
        dims = self.dimensions()
        fact = warehouse.fact_trips(self.clean_trips(), dims["dim_station"], dims["dim_rider_type"], dims["dim_bike_type"])
        self._refresh(fact, "mart", "fact_trips")

    def check_warehouse(self) -> None:
        dims = self.dimensions()
        keys = {"dim_date": "date_key", "dim_station": "station_key",
                "dim_rider_type": "rider_type_key", "dim_bike_type": "bike_type_key"}
        fact = self.layers.read("mart", "fact_trips")
        tally = self._tally(fact)
        self._gate("WAREHOUSE", {"fact_trips": tally}, quality.check_fact_trips(fact, self.clean_trips(), dims, tally=tally),
                   *[quality.check_dimension(dims[name], name, key) for name, key in keys.items()])

    def build_analytics(self) -> None:
        dims, fact = self.dimensions(), self.layers.read("mart", "fact_trips")
        riders, bikes = dims["dim_rider_type"], dims["dim_bike_type"]
        totals = stored(marts.hourly_totals(fact), "hourly_totals")
        self._refresh(marts.daily_from_totals(totals, dims["dim_date"], riders, bikes), "mart", "mart_daily_rides")
        self._refresh(marts.hourly_from_totals(totals, riders, bikes), "mart", "mart_hourly_rides")
        self._refresh(marts.mart_station_performance(fact, dims["dim_station"]), "mart", "mart_station_performance")

    def check_analytics(self) -> None:
        names = ("fact_trips", "mart_daily_rides", "mart_hourly_rides", "mart_station_performance")
        self._gate("ANALYTICS", {}, quality.check_marts(*[self.layers.read("mart", name) for name in names]))

    def run(self, raw_trips: DataFrame, station_information: DataFrame) -> dict[str, int]:
        """All steps in order; returns the rows written per raw table and mart, `published` has those between."""
        self.load_raw(raw_trips, station_information)
        self.build_staging()
        self.check_staging()
        self.build_intermediate()
        self.check_intermediate()
        self.build_warehouse()
        self.check_warehouse()
        self.build_analytics()
        self.check_analytics()
        return self.rows

    def dimensions(self) -> dict[str, DataFrame]:
        names = ("dim_date", "dim_station", "dim_rider_type", "dim_bike_type")
        return {name: self.layers.read("mart", name) for name in names}

    def _refresh(self, df: DataFrame, layer: str, table: str) -> None:
        self.rows[table] = self.layers.refresh(df, layer, table)

    def _publish(self, df: DataFrame, layer: str, table: str) -> None:
        self.published[table] = self.layers.refresh(df, layer, table)

    def _tally(self, trips: DataFrame) -> DataFrame:
        """The ride ids of a stored table are counted once, for the gate and the schema tests of its layer."""
        with setting(self.layers.spark, _CLEANUP, "true"):
            counted = quality.key_tally(trips, "ride_id")
            return self.layers.spark.createDataFrame(counted.collect(), counted.schema)

    def _gate(self, layer: str, ride_ids: dict[str, DataFrame], *checked: DataFrame) -> None:
        """`ride_ids` has the tally of the ride ids per table."""
        results = checked[0]
        for more in checked[1:]:
            results = results.unionByName(more)
        tables = {table: self.layers.read(place, table) for place, table in TESTED[layer]}
        parents = self.dimensions() if layer == "WAREHOUSE" else {}
        tallies = {(table, "ride_id"): tally for table, tally in ride_ids.items()}
        finish = (
            lambda: quality.finish_gate(layer, results, self.layers.name("audit", AUDIT_TABLE), self.run_id, self.dag_id),
            lambda: quality.finish_schema_tests(layer, quality.schema_tests(tables, parents, tallies),
                                                self.layers.name("audit", TESTS_TABLE), self.run_id, self.dag_id),
        )
        for step in finish:
            try:
                with setting(self.layers.spark, _CLEANUP, "true"):  # the shuffles of a gate go with it
                    step()
            except quality.QualityGateError:
                if self.on_failure == "stop":
                    raise
