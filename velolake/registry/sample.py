"""The layers over one folder of given tables, built when a query asks for them."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.operators import marts, staging, stations, status, trips, warehouse
from velolake.session import fingerprint, stored, stored_once, use_library_settings, was_stored
from velolake.sources import samples


class Sample:
    """Layers over `folder`; tables with several readers are stored once in the shared folder.

    Queries of one application share the stored tables as long as the given files are the
    same ones; `share=False` stores them anew.
    """

    def __init__(self, spark: SparkSession, folder: str, share: bool = True) -> None:
        self.spark = use_library_settings(spark)
        self.folder = folder
        self.share = share

    @cached_property
    def version(self) -> tuple:
        """Identifies the given files that the stored tables are built from."""
        names = ("lineitem", "orders", "supplier")
        return (self.folder, *fingerprint(self.spark, *[f"{self.folder}/{name}.parquet" for name in names]))

    def _stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return stored_once(self.spark, self.version, name, build) if self.share else stored(build(), name)

    @cached_property
    def raw_trips(self) -> DataFrame:
        return samples.raw_trips(self.spark, self.folder)

    @cached_property
    def stg_trips(self) -> DataFrame:
        return staging.stage_trips(self.raw_trips, F.lit(samples.INGESTED_AT))

    @cached_property
    def int_trips_clean(self) -> DataFrame:
        return trips.clean_trips(self.stg_trips)

    def int_trips_invalid(self, mode: str = "reference") -> DataFrame:
        return trips.rejected_trips(self.stg_trips, mode)

    @cached_property
    def stored_trips(self) -> DataFrame:
        """Clean trips, read by both dimensions and by the fact."""
        return self._stored("int_trips_clean", lambda: self.int_trips_clean)

    @property
    def station_trips(self) -> DataFrame:
        """Clean trips for the station dimension: the stored ones if there are any.

        A query that reads nothing else of the trips does not have all their columns computed
        and written; the dimension takes both ends of a trip out of the scan of the raw tables.
        """
        if "stored_trips" in self.__dict__ or self.share and was_stored(self.spark, self.version, "int_trips_clean"):
            return self.stored_trips
        return self.int_trips_clean

    @cached_property
    def raw_station_information(self) -> DataFrame:
        return samples.raw_station_information(self.spark, self.folder)

    @cached_property
    def stg_station_information(self) -> DataFrame:
        return staging.stage_station_information(self.raw_station_information)

    @cached_property
    def int_station_information(self) -> DataFrame:
        return stations.clean_station_information(self.stg_station_information)

    @cached_property
    def dim_station(self) -> DataFrame:
        return self._stored("dim_station", lambda: stations.dim_station(self.int_station_information, self.station_trips))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._stored("dim_date", lambda: warehouse.dim_date(self.stored_trips))

    @cached_property
    def dim_rider_type(self) -> DataFrame:
        return warehouse.dim_rider_type(self.spark)

    @cached_property
    def dim_bike_type(self) -> DataFrame:
        return warehouse.dim_bike_type(self.spark)

    @property
    def dimensions(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in ("dim_date", "dim_station", "dim_rider_type", "dim_bike_type")}

    @cached_property
    def fact_trips(self) -> DataFrame:
        return warehouse.fact_trips(self.stored_trips, self.dim_station, self.dim_rider_type, self.dim_bike_type)

    @cached_property
    def stored_fact_trips(self) -> DataFrame:
        """The trip fact, for queries that read it more than once."""
        return self._stored("fact_trips", lambda: self.fact_trips)

    def mart_daily_rides(self, fact: DataFrame | None = None) -> DataFrame:
        fact = self.fact_trips if fact is None else fact
        return marts.mart_daily_rides(fact, self.dim_date, self.dim_rider_type, self.dim_bike_type)

    def mart_hourly_rides(self, fact: DataFrame | None = None) -> DataFrame:
        fact = self.fact_trips if fact is None else fact
        return marts.mart_hourly_rides(fact, self.dim_rider_type, self.dim_bike_type)

    def mart_station_performance(self, fact: DataFrame | None = None) -> DataFrame:
        return marts.mart_station_performance(self.fact_trips if fact is None else fact, self.dim_station)

    @cached_property
    def raw_station_status(self) -> DataFrame:
        return samples.raw_station_status(self.spark, self.folder)

    @cached_property
    def stg_station_status(self) -> DataFrame:
        return staging.stage_station_status(self.raw_station_status)

    @cached_property
    def int_station_status(self) -> DataFrame:
        return status.clean_station_status(self.stg_station_status)

    @cached_property
    def fact_station_status(self) -> DataFrame:
        return status.fact_station_status(self.int_station_status, self.dim_station)

    @cached_property
    def mart_station_live(self) -> DataFrame:
        return marts.mart_station_live(self.fact_station_status, self.dim_station)

    @cached_property
    def status_events(self) -> DataFrame:
        return samples.status_events(self.spark, self.folder)
