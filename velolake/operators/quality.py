"""Data-quality checks: measures per table, audit rows, gates and column tests.

All measures of one table come from one aggregation. Measures of several tables are
stacked into (measure, value) rows and merged into one row, so every check of a layer
is a projection of a single row, and only that row's audit rows reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from velolake.functions import trimmed
from velolake.operators.trips import BIKE_TYPES, LATITUDES, LONGITUDES, RIDER_TYPES, STATION_IDS
from velolake.schemas import AUDIT, COUNT_FIELDS, SCHEMA_TESTS

# Fixed values.
FRESHNESS_LIMIT_MINUTES = 5
DEAD_LETTER_LIMIT = 100
REPORTED_COUNTS = COUNT_FIELDS[:3]

RESULT_COLUMNS = ("layer", "table_name", "check_name", "actual_value", "expected_value", "status", "message")


class QualityGateError(RuntimeError):
    """At least one check of a layer failed."""


@dataclass(frozen=True)
class Check:
    """One audit row: `actual` is shown, `passed` decides, both read the measures."""

    table: str
    name: str
    actual: Column
    expected: Column
    passed: Column


def is_zero(table: str, name: str, measure: str) -> Check:
    return Check(table, name, F.col(measure), F.lit("0"), F.col(measure) == 0)


def has_rows(table: str, measure: str) -> Check:
    return Check(table, "row_count", F.col(measure), F.lit("> 0"), F.col(measure) > 0)


def equals(table: str, name: str, actual: str, expected: str) -> Check:
    return Check(table, name, F.col(actual), F.col(expected), F.col(actual) == F.col(expected))


# Measures ---------------------------------------------------------------------------------


def rows() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def duplicates(*key: str) -> Column:
    """Rows minus distinct keys; a row with a NULL in its key counts as a duplicate."""
    return rows() - F.count_distinct(*key)


def any_null(*names: str) -> Column:
    return reduce(or_, [F.col(name).isNull() for name in names])


def any_negative(*names: str) -> Column:
    return reduce(or_, [F.col(name) < 0 for name in names])


def measure(df: DataFrame, **measures: Column) -> DataFrame:
    return df.agg(*[column.cast("bigint").alias(name) for name, column in measures.items()])


def merge_measures(*single_rows: DataFrame) -> DataFrame:
    """One row with the measures of all inputs, which have one row each."""
    names = [name for df in single_rows for name in df.columns]
    stacked = [
        df.select(F.stack(F.lit(len(df.columns)), *[part for name in df.columns for part in (F.lit(name), F.col(name))])
                  .alias("measure", "value"))
        for df in single_rows
    ]
    picked = [F.max(F.when(F.col("measure") == name, F.col("value"))).alias(name) for name in names]
    return reduce(DataFrame.unionByName, stacked).agg(*picked)


def key_tally(df: DataFrame, column: str) -> DataFrame:
    """One row, from one shuffle of counts per value: total rows, distinct keys, repeated keys; NULL is no key.

    The duplicates of a gate and the unique test of the same column both follow from it.
    """
    counts = df.groupBy(F.col(column).alias("key")).agg(rows().alias("occurrences"))
    return counts.agg(
        F.coalesce(F.sum("occurrences"), F.lit(0).cast("bigint")).alias("total"),
        F.count("key").alias("distinct_keys"),
        F.count_if(F.col("key").isNotNull() & (F.col("occurrences") > 1)).alias("repeated_keys"),
    )


def measure_ids(df: DataFrame, tally: DataFrame | None, **measures: Column) -> DataFrame:
    """`measures`, NULLs and duplicates of ride_id; the duplicates come from its key_tally if there is one."""
    measures["null_id"] = count_where(any_null("ride_id"))
    if tally is None:
        return measure(df, **measures, duplicate_id=duplicates("ride_id"))
    return merge_measures(measure(df, **measures), tally.select((F.col("total") - F.col("distinct_keys")).alias("duplicate_id")))


# Audit rows and gates ----------------------------------------------------------------------


def results(layer: str, measures: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check, in order; a check that cannot be decided (NULL) fails."""
    row = []
    for check in checks:
        actual = F.coalesce(check.actual.cast("string"), F.lit("None"))
        row.append(F.struct(
            F.lit(layer).alias("layer"),
            F.lit(check.table).alias("table_name"),
            F.lit(check.name).alias("check_name"),
            actual.alias("actual_value"),
            F.coalesce(check.expected.cast("string"), F.lit("None")).alias("expected_value"),
            F.when(check.passed, "PASS").otherwise("FAIL").alias("status"),
            F.concat(F.lit(f"{check.name}: "), actual).alias("message"),
        ))
    return measures.select(F.inline(F.array(*row)))


def audit_rows(checked: DataFrame, run_id: str | None = None, dag_id: str | None = None) -> DataFrame:
    """Check results in the schema of the audit table."""
    return checked.select(
        F.uuid().alias("audit_id"),
        F.lit(run_id).cast("string").alias("run_id"),
        F.lit(dag_id).cast("string").alias("dag_id"),
        *RESULT_COLUMNS,
        F.current_timestamp().alias("checked_at"),
    )


def finish_gate(layer: str, checked: DataFrame, audit_table: str | None = None,
                run_id: str | None = None, dag_id: str | None = None) -> list[Row]:
    """Append every result to the audit table, then raise if any check failed.

    The checks are evaluated once: their audit rows, one per check, are what is
    appended, decided on and returned.
    """
    spark = checked.sparkSession
    audited = audit_rows(checked, run_id, dag_id).collect()
    if audit_table:
        spark.createDataFrame(audited, AUDIT).coalesce(1).write.mode("append").saveAsTable(audit_table)
    failed = [f"{row.table_name}.{row.check_name}" for row in audited if row.status == "FAIL"]
    if failed:
        raise QualityGateError(f"{layer} quality gate FAILED: {', '.join(failed)}")
    return audited


# Batch layers ------------------------------------------------------------------------------


def trips_out_of_rules() -> Column:
    outside = [~F.col(name).between(-90, 90) for name in LATITUDES]
    outside += [~F.col(name).between(-180, 180) for name in LONGITUDES]
    return reduce(or_, [
        F.col("ended_at") <= F.col("started_at"),
        ~F.col("member_casual").isin(*RIDER_TYPES),
        ~F.col("rideable_type").isin(*BIKE_TYPES),
        any_null(*STATION_IDS),
        *outside,
    ])


def check_staged_trips(staged: DataFrame, layer: str = "STAGING", table: str = "stg_trips", tally: DataFrame | None = None) -> DataFrame:
    """`tally`, here and below, is the key_tally of the ride ids of the checked table."""
    measures = measure_ids(staged, tally, total=rows())
    return results(layer, measures, [
        has_rows(table, "total"),
        is_zero(table, "ride_id_not_null", "null_id"),
        is_zero(table, "ride_id_unique", "duplicate_id"),
    ])


def check_staged_station_information(staged: DataFrame, layer: str = "STAGING",
                                     table: str = "stg_station_information") -> DataFrame:
    measures = measure(
        staged,
        total=rows(),
        invalid_id=count_where(any_null("station_id", "short_name")),
        duplicate_id=duplicates("station_id"),
        duplicate_short_name=duplicates("short_name"),
    )
    return results(layer, measures, [
        has_rows(table, "total"),
        is_zero(table, "station_id_valid", "invalid_id"),
        is_zero(table, "station_id_unique", "duplicate_id"),
        is_zero(table, "short_name_unique", "duplicate_short_name"),
    ])


def check_split_trips(staged: DataFrame, clean: DataFrame, rejected: DataFrame, layer: str = "INTERMEDIATE",
                      table: str = "int_trips_clean", tally: DataFrame | None = None) -> DataFrame:
    measures = merge_measures(
        measure(staged, staged_rows=rows()),
        measure_ids(clean, tally, clean_rows=rows(), out_of_rules=count_where(trips_out_of_rules())),
        measure(rejected, rejected_rows=rows()),
    )
    staged_rows, clean_rows, rejected_rows = (F.col(f"{name}_rows") for name in ("staged", "clean", "rejected"))
    balance = F.format_string("%d=%d+%d", staged_rows, clean_rows, rejected_rows)
    return results(layer, measures, [
        is_zero(table, "ride_id_not_null", "null_id"),
        is_zero(table, "ride_id_unique", "duplicate_id"),
        is_zero(table, "business_rules", "out_of_rules"),
        Check(table, "clean_invalid_reconciliation", balance, F.lit("staging=clean+invalid"),
              staged_rows == clean_rows + rejected_rows),
    ])


def check_station_information(clean: DataFrame, layer: str = "INTERMEDIATE",
                              table: str = "int_station_information_clean") -> DataFrame:
    outside = ~F.col("latitude").between(-90, 90) | ~F.col("longitude").between(-180, 180) | (F.col("capacity") < 0)
    measures = measure(
        clean,
        total=rows(),
        invalid_id=count_where(any_null("station_id", "short_name", "station_name")),
        duplicate_id=duplicates("station_id"),
        duplicate_short_name=duplicates("short_name"),
        out_of_rules=count_where(outside),
    )
    return results(layer, measures, [
        has_rows(table, "total"),
        is_zero(table, "station_identity_valid", "invalid_id"),
        is_zero(table, "station_id_unique", "duplicate_id"),
        is_zero(table, "short_name_unique", "duplicate_short_name"),
        is_zero(table, "business_rules", "out_of_rules"),
    ])


def check_dimension(dimension: DataFrame, table: str, key: str, layer: str = "WAREHOUSE") -> DataFrame:
    measures = measure(dimension, total=rows(), null_key=count_where(any_null(key)), duplicate_key=duplicates(key))
    return results(layer, measures, [
        has_rows(table, "total"),
        is_zero(table, f"{key}_not_null", "null_key"),
        is_zero(table, f"{key}_unique", "duplicate_key"),
    ])


FACT_KEYS = {
    "date_key": ("dim_date", "date_key"),
    "start_station_key": ("dim_station", "station_key"),
    "end_station_key": ("dim_station", "station_key"),
    "rider_type_key": ("dim_rider_type", "rider_type_key"),
    "bike_type_key": ("dim_bike_type", "bike_type_key"),
}


# Dimensions of two rows each, whatever the size of the data.
LITERAL_DIMENSIONS = ("dim_rider_type", "dim_bike_type")


def orphan_facts(fact: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Facts with a key that no dimension row has (a NULL key is such a key).

    The other dimensions should be stored tables, see warehouse.fact_trips.
    """
    flagged = fact.select("ride_id", *FACT_KEYS)
    for key, (dimension, column) in FACT_KEYS.items():
        known = dimensions[dimension].select(F.col(column).alias(key), F.lit(True).alias(f"{key}_known"))
        known = F.broadcast(known) if dimension in LITERAL_DIMENSIONS else known
        flagged = flagged.join(known, key, "left")
    return flagged.where(any_null(*[f"{key}_known" for key in FACT_KEYS])).select("ride_id", *FACT_KEYS)


def check_fact_trips(fact: DataFrame, clean: DataFrame, dimensions: dict[str, DataFrame],
                     layer: str = "WAREHOUSE", table: str = "fact_trips", tally: DataFrame | None = None) -> DataFrame:
    measures = merge_measures(
        measure(clean, clean_rows=rows()),
        measure_ids(fact, tally, fact_rows=rows(), null_fk=count_where(any_null(*FACT_KEYS))),
        measure(orphan_facts(fact, dimensions), invalid_fk=rows()),
    )
    return results(layer, measures, [
        has_rows(table, "fact_rows"),
        is_zero(table, "ride_id_not_null", "null_id"),
        is_zero(table, "ride_id_unique", "duplicate_id"),
        is_zero(table, "foreign_keys_not_null", "null_fk"),
        is_zero(table, "foreign_keys_valid", "invalid_fk"),
        equals(table, "clean_fact_reconciliation", "fact_rows", "clean_rows"),
    ])


def check_marts(fact: DataFrame, daily: DataFrame, hourly: DataFrame, performance: DataFrame,
                layer: str = "ANALYTICS") -> DataFrame:
    """Marts add up to the fact; the sum over an empty mart is NULL and fails."""
    measures = merge_measures(
        measure(fact, fact_rows=rows()),
        measure(daily, daily_rides=F.sum("total_rides")),
        measure(hourly, hourly_rides=F.sum("total_rides")),
        measure(performance, departures=F.sum("total_departures"), arrivals=F.sum("total_arrivals")),
    )
    return results(layer, measures, [
        equals("mart_daily_rides", "fact_reconciliation", "daily_rides", "fact_rows"),
        equals("mart_hourly_rides", "fact_reconciliation", "hourly_rides", "fact_rows"),
        equals("mart_station_performance", "departure_reconciliation", "departures", "fact_rows"),
        equals("mart_station_performance", "arrival_reconciliation", "arrivals", "fact_rows"),
    ])


# Streaming layers --------------------------------------------------------------------------


def raw_status_measures(raw: DataFrame, now: datetime | Column) -> DataFrame:
    """Row count, faulty rows, and whole minutes since the newest snapshot."""
    blank = F.col("station_id").isNull() | (trimmed(F.col("station_id")) == "")
    return measure(
        raw,
        total=rows(),
        invalid_station=count_where(blank),
        invalid_availability=count_where(any_negative(*REPORTED_COUNTS)),
        freshness_minutes=F.timestamp_diff("MINUTE", F.max("snapshot_timestamp"), _instant(now)),
    )


def raw_status_failure(limit: int = FRESHNESS_LIMIT_MINUTES) -> Column:
    """The first rule that the measures of the raw status break, or NULL."""
    stale = F.format_string("GBFS data stale | freshness=%sm", F.coalesce(F.col("freshness_minutes").cast("string"), F.lit("None")))
    return (
        F.when(F.col("total") == 0, "GBFS data kosong")
        .when(F.col("invalid_station") > 0, "GBFS station tidak valid")
        .when(F.col("invalid_availability") > 0, "GBFS availability tidak valid")
        .when(F.col("freshness_minutes").isNull() | (F.col("freshness_minutes") > limit), stale)
    )


def require_raw_status(raw: DataFrame, now: datetime | Column | None = None) -> int:
    """Raise at the first broken rule, without audit rows; returns the row count."""
    now = F.current_timestamp() if now is None else now
    row = raw_status_measures(raw, now).withColumn("failure", raw_status_failure()).first()
    if row.failure:
        raise ValueError(row.failure)
    return row.total


def check_staged_status(staged: DataFrame, layer: str = "STREAMING_STAGING", table: str = "stg_station_status") -> DataFrame:
    return _check_status(staged, layer, table, ("station_id", "snapshot_timestamp"), REPORTED_COUNTS,
                         "identity_valid", "availability_valid")


def check_clean_status(clean: DataFrame, layer: str = "STREAMING_INTERMEDIATE", table: str = "int_station_status") -> DataFrame:
    return _check_status(clean, layer, table, ("station_id", "snapshot_timestamp"), (*REPORTED_COUNTS, "available_capacity"),
                         "identity_valid", "business_rules")


def check_status_fact(fact: DataFrame, layer: str = "STREAMING_WAREHOUSE", table: str = "fact_station_status",
                      unique: bool = False) -> DataFrame:
    """`unique` adds the check that no (station, snapshot) repeats."""
    checked = _check_status(fact, layer, table, ("station_key", "snapshot_timestamp"), REPORTED_COUNTS,
                            "key_valid", "availability_valid")
    if not unique:
        return checked
    repeated = measure(fact, duplicate_event=duplicates("station_key", "snapshot_timestamp"))
    return checked.unionByName(results(layer, repeated, [is_zero(table, "duplicate_event", "duplicate_event")]))


def _check_status(df: DataFrame, layer: str, table: str, key: Sequence[str], counts: Sequence[str],
                  key_check: str, count_check: str) -> DataFrame:
    measures = measure(
        df,
        total=rows(),
        invalid_key=count_where(any_null(*key)),
        negative=count_where(any_negative(*counts)),
    )
    return results(layer, measures, [
        has_rows(table, "total"),
        is_zero(table, key_check, "invalid_key"),
        is_zero(table, count_check, "negative"),
    ])


def check_station_live(live: DataFrame, layer: str = "STREAMING_ANALYTICS", table: str = "mart_station_live") -> DataFrame:
    measures = measure(live, live_rows=rows(), live_stations=F.count_distinct("station_key"))
    return results(layer, measures, [equals(table, "station_unique", "live_rows", "live_stations")])


def check_freshness(snapshots: DataFrame, now: datetime | Column, limit: int = FRESHNESS_LIMIT_MINUTES) -> DataFrame:
    """Whole minutes since the newest snapshot; more than `limit`, or no snapshot at all, is stale."""
    newest = snapshots.agg(F.max("snapshot_timestamp").alias("newest"))
    minutes = F.timestamp_diff("MINUTE", F.col("newest"), _instant(now)).cast("bigint")
    return newest.select(
        minutes.alias("freshness_minutes"),
        F.coalesce(minutes > limit, F.lit(True)).alias("is_stale"),
    )


def recent_dead_letters(letters: DataFrame, now: datetime | Column, minutes: int = 5,
                        limit: int = DEAD_LETTER_LIMIT) -> DataFrame:
    """Dead letters of the trailing minutes; above the limit is a warning, never a failure."""
    since = _instant(now) - F.make_dt_interval(mins=F.lit(minutes))
    return letters.where(F.col("detected_at") >= since).agg(rows().alias("dead_letters")).select(
        "dead_letters",
        F.when(F.col("dead_letters") > limit, "WARN").otherwise("PASS").alias("status"),
    )


def _instant(now: datetime | Column) -> Column:
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp")


# Column tests ------------------------------------------------------------------------------

# Which columns of which table must not be NULL.
NOT_NULL_COLUMNS = {
    "stg_trips": ("ride_id",),
    "stg_station_information": ("station_id", "short_name"),
    "stg_station_status": ("station_id", "snapshot_timestamp"),
    "int_trips_clean": ("ride_id", "trip_date"),
    "int_trips_invalid": ("ride_id", "invalid_reason"),
    "int_station_information_clean": ("station_id", "short_name"),
    "int_station_status": ("station_id", "snapshot_timestamp"),
    "fact_trips": ("ride_id", *FACT_KEYS),
    "fact_station_status": ("station_key", "snapshot_timestamp"),
    "mart_daily_rides": ("ride_date", "rider_type", "bike_type", "total_rides"),
    "mart_hourly_rides": ("ride_date", "ride_hour", "rider_type", "bike_type", "total_rides"),
    "mart_station_performance": ("ride_date", "station_key", "total_departures", "total_arrivals"),
    "mart_station_live": ("station_key", "snapshot_timestamp"),
}

# Which columns of which table must not repeat.
UNIQUE_COLUMNS = {
    "stg_trips": ("ride_id",),
    "stg_station_information": ("station_id", "short_name"),
    "int_trips_clean": ("ride_id",),
    "int_station_information_clean": ("station_id", "short_name"),
    "fact_trips": ("ride_id",),
    "mart_station_live": ("station_key",),
}

# Metrics of the daily mart that must not be negative.
DAILY_METRICS = ("total_rides", "avg_ride_duration_minutes", "avg_trip_distance_km")

# Child table and column, parent table and column.
RELATIONSHIPS = tuple(("fact_trips", key, *parent) for key, parent in FACT_KEYS.items()) + (
    ("fact_station_status", "station_key", "dim_station", "station_key"),
)

# Which columns may only hold which values.
ACCEPTED_VALUES = {
    "int_trips_clean": {"member_casual": RIDER_TYPES, "rideable_type": BIKE_TYPES},
    "dim_rider_type": {"rider_type": RIDER_TYPES},
    "dim_bike_type": {"bike_type": BIKE_TYPES},
}


def not_null_violations(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """(table_name, column_name, violations) per column, from one aggregation."""
    return _per_column(df, table, columns, lambda name: count_where(F.col(name).isNull()))


def accepted_value_violations(df: DataFrame, table: str, accepted: dict[str, Sequence[str]]) -> DataFrame:
    """(table_name, column_name, violations); NULL is not a violation."""
    return _per_column(df, table, list(accepted), lambda name: count_where(~F.col(name).isin(*accepted[name])))


def _per_column(df: DataFrame, table: str, columns: Sequence[str], counted) -> DataFrame:
    counts = measure(df, **{name: counted(name) for name in columns})
    pairs = [F.struct(F.lit(name).alias("column_name"), F.col(name).alias("violations")) for name in columns]
    return counts.select(F.lit(table).alias("table_name"), F.inline(F.array(*pairs)))


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """Values of `column` that occur more than once; NULL is ignored."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(rows().alias("occurrences"))
    return counts.where("occurrences > 1")


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Keys without a parent, with their number of child rows; NULL is ignored.

    Child rows are counted per key before the join, so a frequent key is one row in it.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(rows().alias("occurrences"))
    return keys.join(parent.select(F.col(parent_column).alias("key")), "key", "left_anti")


def negative_metrics(daily: DataFrame) -> DataFrame:
    """Rows of the daily mart with a negative metric."""
    return daily.where(any_negative(*DAILY_METRICS))


# All declared tests of a layer -------------------------------------------------------------


def schema_tests(tables: Mapping[str, DataFrame], parents: Mapping[str, DataFrame] | None = None,
                 tallies: Mapping[tuple[str, str], DataFrame] | None = None) -> DataFrame:
    """(table_name, column_name, test_name, violations) of every rule declared above for these tables.

    One aggregation per table counts all its rules that look at single rows. A unique column is one
    more shuffle, of rows combined per key on the map side (violations are repeated keys), and so is
    a relationship (violations are rows without a parent). Relationships need their parents. A unique
    column of `tallies`, by table and column, was counted before (see key_tally).
    """
    parts = []
    for table, df in tables.items():
        counted = {("not_null", name): count_where(F.col(name).isNull()) for name in NOT_NULL_COLUMNS.get(table, ())}
        counted |= {("accepted_values", name): count_where(~F.col(name).isin(*values))
                    for name, values in ACCEPTED_VALUES.get(table, {}).items()}
        if table == "mart_daily_rides":
            counted["non_negative", "total_rides"] = count_where(any_negative(*DAILY_METRICS))
        if counted:
            measures = measure(df, **{f"m{i}": column for i, column in enumerate(counted.values())})
            rules = [F.struct(F.lit(column).alias("column_name"), F.lit(test).alias("test_name"), F.col(f"m{i}").alias("violations"))
                     for i, (test, column) in enumerate(counted)]
            parts.append(measures.select(F.lit(table).alias("table_name"), F.inline(F.array(*rules))))
        for column in UNIQUE_COLUMNS.get(table, ()):
            tally = (tallies or {}).get((table, column))
            repeated = repeated_keys(df, column).agg(rows().alias("violations")) if tally is None else tally.select(F.col("repeated_keys").alias("violations"))
            parts.append(_tested(repeated, table, column, "unique"))
    for child, column, parent, parent_column in RELATIONSHIPS:
        if child in tables and parent in (parents or {}):
            orphans = orphan_rows(tables[child], column, parents[parent], parent_column)
            orphans = orphans.agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("violations"))
            parts.append(_tested(orphans, child, column, "relationship"))
    return reduce(DataFrame.unionByName, parts)


def _tested(violations: DataFrame, table: str, column: str, test: str) -> DataFrame:
    return violations.select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.lit(test).alias("test_name"), "violations")


def finish_schema_tests(layer: str, tested: DataFrame, results_table: str | None = None,
                        run_id: str | None = None, dag_id: str | None = None) -> list[Row]:
    """Append the result of every test, one row each, then raise if any has violations."""
    spark = tested.sparkSession
    found = tested.select(
        F.lit(run_id).cast("string").alias("run_id"),
        F.lit(dag_id).cast("string").alias("dag_id"),
        F.lit(layer).alias("layer"),
        "table_name", "column_name", "test_name", "violations",
        F.when(F.col("violations") == 0, "PASS").otherwise("FAIL").alias("status"),
        F.current_timestamp().alias("checked_at"),
    ).collect()
    if results_table:
        spark.createDataFrame(found, SCHEMA_TESTS).coalesce(1).write.mode("append").saveAsTable(results_table)
    failed = [f"{row.table_name}.{row.column_name} {row.test_name}" for row in found if row.status == "FAIL"]
    if failed:
        raise QualityGateError(f"{layer} schema tests FAILED: {', '.join(failed)}")
    return found
