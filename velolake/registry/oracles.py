"""SQL over the given tables that every named query must agree with.

Written for an engine with standard SQL, independently of the Spark code: the tables are
built up in WITH clauses, and a query gets the clauses it needs.
"""

from __future__ import annotations

import re

COUNTS = "num_bikes_available, num_ebikes_available, num_docks_available, num_bikes_disabled, num_docks_disabled"
FLAGS = "is_installed, is_renting, is_returning"
STAMP = "TIMESTAMP '2024-02-01 00:00:00'"
TRIP = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
START = "o_orderdate + to_minutes((l_partkey * 7 + l_orderkey) % 1440)"


def _mean(column: str) -> str:
    """Mean of a two-decimal column, rounded to two decimals in whole numbers."""
    total = f"CAST(sum(CAST(round({column} * 100) AS BIGINT)) AS BIGINT)"
    return f"((2 * {total} + count({column})) // (2 * count({column}))) / 100.0::DOUBLE"


def _km(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    half = f"pow(sin(radians({lat2} - {lat1}) / 2), 2)"
    half += f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lng2} - {lng1}) / 2), 2)"
    return f"round(2 * 6371010.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, {half}))) / 1000, 2)"


VALID_TRIP = """ride_id IS NOT NULL AND ended_at > started_at
    AND start_station_id IS NOT NULL AND start_station_name IS NOT NULL
    AND end_station_id IS NOT NULL AND end_station_name IS NOT NULL
    AND member_casual IN ('member', 'casual') AND rideable_type IN ('classic_bike', 'electric_bike')
    AND abs(start_lat) <= 90 AND abs(end_lat) <= 90 AND abs(start_lng) <= 180 AND abs(end_lng) <= 180"""

# What makes a trip invalid when NULL categories and coordinates decide nothing.
KNOWN_FAULT = """ride_id IS NULL OR started_at IS NULL OR ended_at IS NULL OR ended_at <= started_at
    OR start_station_id IS NULL OR start_station_name IS NULL
    OR end_station_id IS NULL OR end_station_name IS NULL
    OR member_casual NOT IN ('member', 'casual') OR rideable_type NOT IN ('classic_bike', 'electric_bike')
    OR abs(start_lat) > 90 OR abs(end_lat) > 90 OR abs(start_lng) > 180 OR abs(end_lng) > 180"""

REASON = """CASE WHEN ride_id IS NULL THEN 'missing ride_id'
    WHEN started_at IS NULL OR ended_at IS NULL THEN 'missing timestamp'
    WHEN ended_at <= started_at THEN 'invalid trip time'
    WHEN member_casual IS NULL OR member_casual NOT IN ('member', 'casual') THEN 'invalid user type'
    WHEN rideable_type IS NULL OR rideable_type NOT IN ('classic_bike', 'electric_bike') THEN 'invalid bike type'
    WHEN start_station_id IS NULL OR end_station_id IS NULL THEN 'missing station'
    WHEN start_lat IS NULL OR start_lng IS NULL OR end_lat IS NULL OR end_lng IS NULL THEN 'missing coordinates'
    ELSE 'invalid coordinates' END"""

TABLES = {
    "raw_trips": f"""
        SELECT CASE WHEN l_partkey % 499 = 7 THEN NULL ELSE concat_ws('-', {TRIP}) END AS ride_id,
            CASE WHEN l_partkey % 61 = 3 THEN 'docked_bike' WHEN l_partkey % 67 = 5 THEN NULL
                 WHEN l_linestatus = 'O' THEN ' Classic_Bike ' ELSE 'ELECTRIC_BIKE' END AS rideable_type,
            CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE {START} END AS started_at,
            {START} + to_seconds(CAST(l_quantity AS BIGINT) * 60 + l_suppkey - 180) AS ended_at,
            CASE WHEN l_partkey % 79 = 2 THEN NULL ELSE 'Station ' || (20 + o_custkey % 90) END AS start_station_name,
            CASE WHEN l_suppkey % 83 = 1 THEN NULL ELSE ' S' || (20 + o_custkey % 90) END AS start_station_id,
            'Station ' || (10 + l_suppkey % 90) AS end_station_name,
            'S' || (10 + l_suppkey % 90) AS end_station_id,
            CASE WHEN l_suppkey % 37 = 5 THEN NULL WHEN l_partkey % 71 = 8 THEN 95.0::DOUBLE
                 ELSE 40 + (20 + o_custkey % 90) / 100.0::DOUBLE END AS start_lat,
            -74.0::DOUBLE AS start_lng,
            40 + (10 + l_suppkey % 90) / 100.0::DOUBLE AS end_lat,
            -74 + (10 + l_suppkey % 90) / 200.0::DOUBLE AS end_lng,
            CASE WHEN l_partkey % 59 = 4 THEN 'unknown' WHEN l_partkey % 53 = 6 THEN NULL
                 WHEN l_returnflag = 'N' THEN 'Casual ' ELSE 'member' END AS member_casual
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "stg_trips": f"""
        SELECT ride_id, lower(trim(rideable_type)) AS rideable_type, lower(trim(member_casual)) AS member_casual,
            started_at, ended_at, trim(start_station_id) AS start_station_id,
            trim(start_station_name) AS start_station_name, trim(end_station_id) AS end_station_id,
            trim(end_station_name) AS end_station_name, start_lat, start_lng, end_lat, end_lng, {STAMP} AS _ingested_at
        FROM raw_trips""",
    "int_trips_clean": f"""
        SELECT ride_id, rideable_type, member_casual, started_at, ended_at, CAST(started_at AS DATE) AS trip_date,
            round(date_sub('second', started_at, ended_at) / 60.0::DOUBLE, 2) AS ride_duration_minutes,
            year(started_at) AS ride_year, month(started_at) AS ride_month,
            strftime(started_at, '%A') AS ride_day_of_week, hour(started_at) AS ride_hour,
            isodow(started_at) >= 6 AS is_weekend,
            CASE WHEN hour(started_at) < 6 THEN 'late night' WHEN hour(started_at) < 10 THEN 'morning rush'
                 WHEN hour(started_at) < 16 THEN 'daytime' WHEN hour(started_at) < 20 THEN 'evening rush'
                 ELSE 'night' END AS time_of_day,
            start_station_id, start_station_name, start_lat, start_lng,
            end_station_id, end_station_name, end_lat, end_lng,
            {_km('start_lat', 'start_lng', 'end_lat', 'end_lng')} AS trip_distance_km
        FROM stg_trips WHERE {VALID_TRIP}""",
    "int_trips_invalid": f"""
        SELECT ride_id, rideable_type, member_casual, started_at, ended_at, start_station_id, end_station_id,
            {REASON} AS invalid_reason
        FROM stg_trips WHERE {KNOWN_FAULT}""",
    "int_trips_not_clean": f"""
        SELECT ride_id, rideable_type, member_casual, started_at, ended_at, start_station_id, end_station_id,
            {REASON} AS invalid_reason
        FROM stg_trips WHERE ({VALID_TRIP}) IS DISTINCT FROM TRUE""",
    "raw_station_information": f"""
        SELECT 'g' || s_suppkey AS station_id, s_name AS name, 'S' || s_suppkey AS short_name,
            40 + s_suppkey / 100.0::DOUBLE AS lat, -74 + s_suppkey / 200.0::DOUBLE AS lon,
            CAST(s_nationkey AS VARCHAR) AS region_id,
            CAST(CASE WHEN s_suppkey % 17 = 16 THEN NULL WHEN s_suppkey % 19 = 7 THEN -1
                      ELSE 10 + s_suppkey % 40 END AS BIGINT) AS capacity,
            ' CLASSIC ' AS station_type, 'key,creditcard' AS rental_methods, {STAMP} AS _ingested_at
        FROM supplier""",
    "stg_station_information": """
        SELECT station_id, trim(name) AS station_name, trim(short_name) AS short_name, lat AS latitude,
            lon AS longitude, region_id, capacity, lower(trim(station_type)) AS station_type, rental_methods, _ingested_at
        FROM raw_station_information""",
    "int_station_information_clean": """
        SELECT * FROM stg_station_information
        WHERE station_id IS NOT NULL AND short_name IS NOT NULL AND station_name IS NOT NULL
            AND abs(latitude) <= 90 AND abs(longitude) <= 180 AND coalesce(capacity, 0) >= 0""",
    "raw_station_status": """
        SELECT event_id, 'g' || user_id AS station_id,
            CASE WHEN event_type = 'error' AND k % 5 = 0 THEN -k ELSE k % 31 END AS num_bikes_available,
            k % 7 AS num_ebikes_available,
            CASE WHEN event_type = 'signup' AND k % 11 = 0 THEN NULL ELSE (k * 3) % 29 END AS num_docks_available,
            k % 3 AS num_bikes_disabled, k % 2 AS num_docks_disabled,
            event_type <> 'error' AS is_installed, event_type <> 'view' AS is_renting, TRUE AS is_returning,
            date_trunc('second', ts) - INTERVAL 1 MINUTE AS last_reported,
            ts AS snapshot_timestamp, ts + INTERVAL 30 SECOND AS _ingested_at
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "stg_station_status": f"""
        SELECT station_id, {COUNTS}, {FLAGS}, last_reported, snapshot_timestamp, _ingested_at
        FROM raw_station_status""",
    "int_station_status": f"""
        SELECT *, num_bikes_available + num_docks_available + num_bikes_disabled + num_docks_disabled AS available_capacity,
            num_bikes_available = 0 AS is_empty, num_docks_available = 0 AS is_full
        FROM stg_station_status
        WHERE station_id IS NOT NULL AND snapshot_timestamp IS NOT NULL AND num_docks_available IS NOT NULL
            AND least({COUNTS}) >= 0""",
    "station_ends": """
        SELECT start_station_id AS station_code, start_station_name AS station_name,
            start_lat AS latitude, start_lng AS longitude FROM int_trips_clean
        UNION ALL SELECT end_station_id, end_station_name, end_lat, end_lng FROM int_trips_clean""",
    "trip_stations": """
        SELECT * EXCLUDE (pick) FROM (
            SELECT *, row_number() OVER (PARTITION BY station_code ORDER BY station_name, latitude, longitude) AS pick
            FROM station_ends) WHERE pick = 1""",
    "dim_station": """
        SELECT md5(code) AS station_key, code AS station_code, gbfs_station_id, station_name, latitude, longitude,
            region_id, capacity, station_type, rental_methods
        FROM (
            SELECT short_name AS code, station_id AS gbfs_station_id, station_name, latitude, longitude,
                region_id, capacity, station_type, rental_methods
            FROM int_station_information_clean
            UNION ALL
            SELECT station_code, NULL, station_name, latitude, longitude, NULL, NULL, NULL, NULL
            FROM trip_stations
            WHERE station_code NOT IN (SELECT short_name FROM int_station_information_clean))""",
    "dim_date": """
        SELECT date_key, day(date_key) AS day, strftime(date_key, '%A') AS day_name,
            isodow(date_key) >= 6 AS is_weekend, month(date_key) AS month,
            strftime(date_key, '%B') AS month_name, year(date_key) AS year
        FROM (SELECT DISTINCT trip_date AS date_key FROM int_trips_clean)""",
    "dim_rider_type": """
        SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'member'), (2, 'casual')) AS riders(rider_type_key, rider_type)""",
    "dim_bike_type": """
        SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'classic_bike'), (2, 'electric_bike')) AS bikes(bike_type_key, bike_type)""",
    "fact_trips": """
        SELECT ride_id, trip_date AS date_key,
            (SELECT station_key FROM dim_station WHERE station_code = t.start_station_id) AS start_station_key,
            (SELECT station_key FROM dim_station WHERE station_code = t.end_station_id) AS end_station_key,
            CAST(CASE member_casual WHEN 'member' THEN 1 WHEN 'casual' THEN 2 END AS BIGINT) AS rider_type_key,
            CAST(CASE rideable_type WHEN 'classic_bike' THEN 1 WHEN 'electric_bike' THEN 2 END AS BIGINT) AS bike_type_key,
            started_at, ended_at, ride_duration_minutes, trip_distance_km, ride_hour, is_weekend, time_of_day
        FROM int_trips_clean AS t""",
    "mart_daily_rides": f"""
        SELECT date_key AS ride_date, strftime(date_key, '%A') AS day_name, is_weekend, rider_type, bike_type,
            count(*) AS total_rides, {_mean('ride_duration_minutes')} AS avg_ride_duration_minutes,
            {_mean('trip_distance_km')} AS avg_trip_distance_km
        FROM fact_trips JOIN dim_rider_type USING (rider_type_key) JOIN dim_bike_type USING (bike_type_key)
        GROUP BY ALL""",
    "mart_hourly_rides": f"""
        SELECT date_key AS ride_date, ride_hour, rider_type, bike_type,
            count(*) AS total_rides, {_mean('ride_duration_minutes')} AS avg_ride_duration_minutes,
            {_mean('trip_distance_km')} AS avg_trip_distance_km
        FROM fact_trips JOIN dim_rider_type USING (rider_type_key) JOIN dim_bike_type USING (bike_type_key)
        GROUP BY ALL""",
    "station_departures": """
        SELECT date_key AS ride_date, start_station_key AS station_key, count(*) AS total_departures
        FROM fact_trips WHERE start_station_key IS NOT NULL GROUP BY ALL""",
    "station_arrivals": """
        SELECT date_key AS ride_date, end_station_key AS station_key, count(*) AS total_arrivals
        FROM fact_trips WHERE end_station_key IS NOT NULL GROUP BY ALL""",
    "mart_station_performance": """
        SELECT ride_date, s.station_key, station_code, station_name, latitude, longitude,
            coalesce(total_departures, 0) AS total_departures, coalesce(total_arrivals, 0) AS total_arrivals,
            coalesce(total_departures, 0) + coalesce(total_arrivals, 0) AS total_trip_activity
        FROM station_departures FULL JOIN station_arrivals USING (ride_date, station_key)
        LEFT JOIN dim_station AS s USING (station_key)""",
    "fact_station_status": f"""
        SELECT station_key, snapshot_timestamp, CAST(snapshot_timestamp AS DATE) AS snapshot_date, {COUNTS},
            available_capacity, {FLAGS}, is_empty, is_full, last_reported, _ingested_at
        FROM int_station_status JOIN dim_station ON gbfs_station_id = station_id""",
    "mart_station_live": f"""
        SELECT station_key, station_code, station_name, latitude, longitude, capacity, {COUNTS}, {FLAGS},
            is_empty, is_full, last_reported, snapshot_timestamp
        FROM fact_station_status JOIN dim_station USING (station_key)
        WHERE (station_key, snapshot_timestamp) IN
            (SELECT (station_key, max(snapshot_timestamp)) FROM fact_station_status GROUP BY station_key)""",
    "event_outcomes": """
        SELECT *, CASE WHEN event_id % 50 = 2 THEN 'Payload bukan JSON.'
            WHEN event_id % 50 = 0 THEN 'station_id tidak valid.'
            WHEN num_bikes_available < 0 THEN 'num_bikes_available tidak boleh negatif.'
            WHEN event_id % 50 = 1 THEN 'snapshot_timestamp tidak valid.' END AS error_reason
        FROM raw_station_status""",
    "valid_events": f"""
        SELECT station_id, {COUNTS}, {FLAGS}, last_reported, snapshot_timestamp
        FROM event_outcomes WHERE error_reason IS NULL""",
    "known_events": """
        SELECT * FROM valid_events WHERE num_docks_available IS NOT NULL
            AND station_id IN (SELECT gbfs_station_id FROM dim_station WHERE gbfs_station_id IS NOT NULL)""",
    "dlq": """
        SELECT error_reason, _ingested_at AS detected_at FROM event_outcomes WHERE error_reason IS NOT NULL""",
}


def _with_tables(select: str) -> str:
    """Put the tables that `select` mentions, directly or not, in front of it."""
    needed: set[str] = set()
    pending = [select]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words & TABLES.keys() - needed:
            needed.add(name)
            pending.append(TABLES[name])
    clauses = [f"{name} AS ({body})" for name, body in TABLES.items() if name in needed]
    return f"WITH {', '.join(clauses)}\n{select}" if clauses else select


# Quality results ---------------------------------------------------------------------------


def _value(expression: str, table: str, where: str | None = None) -> str:
    return f"(SELECT {expression} FROM {table}{f' WHERE {where}' if where else ''})"


def _result(layer: str, table: str, check: str, actual: str, expected: str, passed: str) -> str:
    return f"""SELECT '{layer}' AS layer, '{table}' AS table_name, '{check}' AS check_name,
        coalesce(CAST(actual AS VARCHAR), 'None') AS actual_value, CAST(expected AS VARCHAR) AS expected_value,
        CASE WHEN {passed} THEN 'PASS' ELSE 'FAIL' END AS status,
        '{check}: ' || coalesce(CAST(actual AS VARCHAR), 'None') AS message
    FROM (SELECT {actual} AS actual, {expected} AS expected)"""


def _some(layer: str, table: str) -> str:
    return _result(layer, table, "row_count", _value("count(*)", table), "'> 0'", "actual > 0")


def _none(layer: str, table: str, check: str, where: str) -> str:
    return _result(layer, table, check, _value("count(*)", table, where), "0", "actual = 0")


def _distinct(layer: str, table: str, check: str, key: str) -> str:
    return _result(layer, table, check, _value(f"count(*) - count(DISTINCT {key})", table), "0", "actual = 0")


def _same(layer: str, table: str, check: str, actual: str, expected: str) -> str:
    return _result(layer, table, check, actual, expected, "actual = expected")


def _all(*selects: str) -> str:
    return "\nUNION ALL ".join(selects)


NEGATIVE = "num_bikes_available < 0 OR num_ebikes_available < 0 OR num_docks_available < 0"
OUT_OF_RULES = """ended_at <= started_at OR member_casual NOT IN ('member', 'casual')
    OR rideable_type NOT IN ('classic_bike', 'electric_bike') OR start_station_id IS NULL OR end_station_id IS NULL
    OR abs(start_lat) > 90 OR abs(end_lat) > 90 OR abs(start_lng) > 180 OR abs(end_lng) > 180"""
FACT_KEYS = "date_key, start_station_key, end_station_key, rider_type_key, bike_type_key".split(", ")


def _orphans(stations: str) -> str:
    return f"""date_key NOT IN (SELECT date_key FROM dim_date)
        OR start_station_key NOT IN (SELECT station_key FROM {stations})
        OR end_station_key NOT IN (SELECT station_key FROM {stations})
        OR rider_type_key NOT IN (SELECT rider_type_key FROM dim_rider_type)
        OR bike_type_key NOT IN (SELECT bike_type_key FROM dim_bike_type)
        OR {' OR '.join(f'{key} IS NULL' for key in FACT_KEYS)}"""


def _checked_trips(rejected: str) -> str:
    layer, table = "INTERMEDIATE", "int_trips_clean"
    parts = [_value("count(*)", name) for name in ("stg_trips", table, rejected)]
    balance = f"{parts[0]} || '=' || {parts[1]} || '+' || {parts[2]}"
    return _all(
        _none(layer, table, "ride_id_not_null", "ride_id IS NULL"),
        _distinct(layer, table, "ride_id_unique", "ride_id"),
        _none(layer, table, "business_rules", OUT_OF_RULES),
        _result(layer, table, "clean_invalid_reconciliation", balance, "'staging=clean+invalid'",
                f"{parts[0]} = {parts[1]} + {parts[2]}"),
    )


def _dimension(table: str, key: str) -> str:
    return _all(
        _some("WAREHOUSE", table),
        _none("WAREHOUSE", table, f"{key}_not_null", f"{key} IS NULL"),
        _distinct("WAREHOUSE", table, f"{key}_unique", key),
    )


STAGED_TRIPS = _all(
    _some("STAGING", "stg_trips"),
    _none("STAGING", "stg_trips", "ride_id_not_null", "ride_id IS NULL"),
    _distinct("STAGING", "stg_trips", "ride_id_unique", "ride_id"),
)
STAGED_STATIONS = _all(
    _some("STAGING", "stg_station_information"),
    _none("STAGING", "stg_station_information", "station_id_valid", "station_id IS NULL OR short_name IS NULL"),
    _distinct("STAGING", "stg_station_information", "station_id_unique", "station_id"),
    _distinct("STAGING", "stg_station_information", "short_name_unique", "short_name"),
)
FACT_COUNT = _value("count(*)", "fact_trips")

MONTH = "started_at >= TIMESTAMP '1996-03-01' AND started_at < TIMESTAMP '1996-04-01'"
NEWEST = "(SELECT max(snapshot_timestamp) FROM raw_station_status)"
FIRST_DAYS = "snapshot_timestamp < TIMESTAMP '2024-01-15'"
LATE = f"""NOT is_renting AND snapshot_timestamp <=
    (SELECT max(snapshot_timestamp) FROM fact_station_status WHERE {FIRST_DAYS} AND is_renting)"""

SELECTS: dict[str, str] = {
    # Sources and sinks
    "scan_trips_csv": """SELECT CAST(ended_at AS DATE) AS end_date, count(*) AS trips, count(ride_id) AS ride_ids,
        count(started_at) AS starts, count(*) FILTER (rideable_type = ' Classic_Bike ') AS untrimmed,
        count(start_lat) AS start_lats, CAST(sum(CAST(round(end_lat * 100) AS BIGINT)) AS BIGINT) AS end_lat_hundredths
        FROM raw_trips GROUP BY ALL""",
    "scan_partitioned_trips": """SELECT CAST(year(started_at) AS INTEGER) AS year, CAST(month(started_at) AS INTEGER) AS month,
        CAST(day(started_at) AS INTEGER) AS day, count(*) AS trips, count(ride_id) AS ride_ids,
        count(member_casual) AS rider_types FROM raw_trips WHERE started_at IS NOT NULL GROUP BY ALL""",
    "write_daily_partitions": """SELECT strftime(started_at, 'year=%Y/month=%m/day=%d') AS folder, count(*) AS trips
        FROM raw_trips WHERE started_at IS NOT NULL GROUP BY ALL""",
    "replace_month": f"""SELECT strftime(started_at, 'year=%Y/month=%m/day=%d') AS folder, count(*) AS trips,
        CAST(sum(count(*)) OVER () AS BIGINT) AS written_rows, count(*) OVER () AS written_days
        FROM raw_trips WHERE member_casual = 'member' AND {MONTH} GROUP BY folder""",
    "full_refresh_load": """SELECT rideable_type AS bike, count(*) AS trips,
        CAST(sum(count(*)) OVER () AS BIGINT) AS loaded_rows FROM raw_trips WHERE ride_id IS NOT NULL GROUP BY bike""",
    "scan_station_info_json": "SELECT * FROM raw_station_information",
    "write_station_snapshot": """SELECT 'dt=2024-02-01' AS folder, count(*) AS stations FROM raw_station_information
        UNION ALL SELECT 'dt=2024-02-02', count(capacity) FROM raw_station_information""",
    "flatten_station_info": """SELECT * FROM raw_station_information
        UNION ALL SELECT * REPLACE (station_id || 't' AS station_id, '' AS rental_methods) FROM raw_station_information""",
    "fan_out_snapshot": """SELECT station_id AS key, station_id, CAST(bikes AS VARCHAR) AS num_bikes_available,
        CAST(ebikes AS VARCHAR) AS num_ebikes_available, CAST(docks AS VARCHAR) AS num_docks_available,
        CASE WHEN station_id IS NOT NULL THEN CAST(updated AS VARCHAR) END AS source_last_updated,
        CASE WHEN station_id IS NOT NULL THEN '2024-02-01T00:00:00.000000Z' END AS snapshot_timestamp
        FROM (
            SELECT CASE WHEN event_id % 50 <> 0 THEN station_id END AS station_id,
                CASE WHEN event_id % 50 <> 0 THEN num_bikes_available END AS bikes, NULL AS ebikes,
                CASE WHEN event_id % 50 <> 0 THEN num_docks_available END AS docks,
                CAST(floor(epoch(snapshot_timestamp)) AS BIGINT) AS updated FROM raw_station_status
            UNION ALL
            SELECT station_id || 't', NULL, num_ebikes_available, NULL,
                CAST(floor(epoch(snapshot_timestamp)) AS BIGINT) FROM raw_station_status)""",
    "write_day_partitions": """SELECT snapshot_date, count(*) AS snapshots,
        CAST(sum(available_capacity) AS BIGINT) AS available_capacity FROM fact_station_status GROUP BY ALL""",
    # Staging and intermediate
    "stg_trips": "SELECT * FROM stg_trips",
    "stg_station_information": "SELECT * FROM stg_station_information",
    "stg_station_status": "SELECT * FROM stg_station_status",
    "filter_period": f"SELECT ride_id, started_at, ended_at, end_station_id FROM raw_trips WHERE {MONTH}",
    "partition_day_count": "SELECT count(DISTINCT CAST(started_at AS DATE)) AS days FROM raw_trips",
    "int_trips_clean": "SELECT * FROM int_trips_clean",
    "int_trips_invalid": "SELECT * FROM int_trips_invalid",
    "int_trips_invalid_complete": "SELECT * FROM int_trips_not_clean",
    "reject_reason_counts": "SELECT invalid_reason, count(*) AS trips FROM int_trips_invalid GROUP BY ALL",
    "time_of_day_counts": "SELECT time_of_day, is_weekend, count(*) AS trips FROM int_trips_clean GROUP BY ALL",
    "dedupe_trips": """SELECT * EXCLUDE (pick) FROM (
        SELECT *, row_number() OVER (PARTITION BY ride_id
            ORDER BY started_at, ended_at, start_station_id, end_station_id, member_casual) AS pick
        FROM (SELECT split_part(ride_id, '-', 1) AS ride_id, started_at, ended_at, start_station_id, end_station_id,
            member_casual FROM int_trips_clean)) WHERE pick = 1""",
    "int_station_information_clean": "SELECT * FROM int_station_information_clean",
    "int_station_status": "SELECT * FROM int_station_status",
    "station_observations": """SELECT station_code, station_name, latitude, longitude, count(*) AS trip_ends
        FROM station_ends GROUP BY ALL""",
    # Warehouse and marts
    "dim_date": "SELECT * FROM dim_date",
    "dim_station": "SELECT * FROM dim_station",
    "dim_rider_type": """SELECT rider_type_key, rider_type, (SELECT nullif(count(*), 0) FROM int_trips_clean
        WHERE member_casual = rider_type) AS trips FROM dim_rider_type""",
    "dim_bike_type": """SELECT bike_type_key, bike_type, (SELECT nullif(count(*), 0) FROM int_trips_clean
        WHERE rideable_type = bike_type) AS trips FROM dim_bike_type""",
    "fact_trips": "SELECT * FROM fact_trips",
    "mart_daily_rides": "SELECT * FROM mart_daily_rides",
    "mart_hourly_rides": "SELECT * FROM mart_hourly_rides",
    "station_departures": "SELECT * FROM station_departures",
    "station_arrivals": "SELECT * FROM station_arrivals",
    "station_date_spine": """SELECT ride_date, station_key FROM station_departures
        UNION SELECT ride_date, station_key FROM station_arrivals""",
    "mart_station_performance": "SELECT * FROM mart_station_performance",
    "fact_station_status": "SELECT * FROM fact_station_status",
    "fact_station_status_incremental": f"""SELECT CAST(CASE WHEN {FIRST_DAYS} THEN 1 ELSE 2 END AS BIGINT) AS load,
        snapshot_date, count(*) AS snapshots, CAST(sum(available_capacity) AS BIGINT) AS available_capacity
        FROM fact_station_status GROUP BY ALL""",
    "fact_station_status_merge": f"""SELECT snapshot_date, count(*) AS snapshots,
        CAST(sum(available_capacity + CASE WHEN {FIRST_DAYS} AND is_renting THEN 1 ELSE 0 END) AS BIGINT) AS available_capacity
        FROM fact_station_status GROUP BY ALL""",
    "late_rows_dropped": f"""SELECT snapshot_date, count(*) AS late_rows FROM fact_station_status
        WHERE {LATE} GROUP BY ALL""",
    "late_rows_by_key": f"""SELECT snapshot_date, count(*) AS added_rows FROM fact_station_status
        WHERE NOT (is_renting AND {FIRST_DAYS}) GROUP BY ALL""",
    "mart_station_live": "SELECT * FROM mart_station_live",
    # Dashboard
    "dashboard_kpis": f"""SELECT count(*) AS total_rides,
        ((200 * count(*) + count(DISTINCT date_key)) // (2 * count(DISTINCT date_key))) / 100.0::DOUBLE AS avg_daily_rides,
        {_mean('ride_duration_minutes')} AS avg_duration_minutes,
        count(*) FILTER (rider_type_key = 1) AS member_rides, count(*) FILTER (rider_type_key = 2) AS casual_rides
        FROM fact_trips""",
    "dashboard_daily_trend": "SELECT date_key AS ride_date, count(*) AS total_rides FROM fact_trips GROUP BY ALL ORDER BY 1",
    "dashboard_rides_by_hour": "SELECT ride_hour, count(*) AS total_rides FROM fact_trips GROUP BY ALL ORDER BY 1",
    "dashboard_top_stations": """SELECT station_code, station_name,
        CAST(sum(total_trip_activity) AS BIGINT) AS total_trip_activity FROM mart_station_performance
        GROUP BY ALL ORDER BY 3 DESC, 1 LIMIT 5""",
    "dashboard_filtered_daily": """SELECT * FROM mart_daily_rides WHERE ride_date >= DATE '1996-01-01'
        AND ride_date <= DATE '1997-06-30' AND rider_type = 'member' AND bike_type = 'classic_bike'""",
    "dashboard_live_totals": """SELECT count(*) AS stations, CAST(sum(num_bikes_available) AS BIGINT) AS bikes,
        CAST(sum(num_ebikes_available) AS BIGINT) AS ebikes, CAST(sum(num_docks_available) AS BIGINT) AS docks,
        max(snapshot_timestamp) AS last_update FROM mart_station_live""",
    # Quality
    "dq_stg_trips": STAGED_TRIPS,
    "dq_stg_station_information": STAGED_STATIONS,
    "dq_int_trips": _checked_trips("int_trips_invalid"),
    "dq_int_trips_complete": _checked_trips("int_trips_not_clean"),
    "dq_int_station_information": _all(
        _some("INTERMEDIATE", "int_station_information_clean"),
        _none("INTERMEDIATE", "int_station_information_clean", "station_identity_valid",
              "station_id IS NULL OR short_name IS NULL OR station_name IS NULL"),
        _distinct("INTERMEDIATE", "int_station_information_clean", "station_id_unique", "station_id"),
        _distinct("INTERMEDIATE", "int_station_information_clean", "short_name_unique", "short_name"),
        _none("INTERMEDIATE", "int_station_information_clean", "business_rules",
              "abs(latitude) > 90 OR abs(longitude) > 180 OR capacity < 0"),
    ),
    "dq_dimensions": _all(
        _dimension("dim_date", "date_key"), _dimension("dim_station", "station_key"),
        _dimension("dim_rider_type", "rider_type_key"), _dimension("dim_bike_type", "bike_type_key"),
    ),
    "dq_dim_date": _dimension("dim_date", "date_key"),
    "dq_dim_station": _dimension("dim_station", "station_key"),
    "dq_dim_rider_type": f"""SELECT *, (SELECT count(*) FROM int_trips_clean) AS clean_trips
        FROM ({_dimension('dim_rider_type', 'rider_type_key')})""",
    "dq_dim_bike_type": f"""SELECT *, (SELECT count(*) FROM int_trips_clean) AS clean_trips
        FROM ({_dimension('dim_bike_type', 'bike_type_key')})""",
    "dq_fact_trips": _all(
        _some("WAREHOUSE", "fact_trips"),
        _none("WAREHOUSE", "fact_trips", "ride_id_not_null", "ride_id IS NULL"),
        _distinct("WAREHOUSE", "fact_trips", "ride_id_unique", "ride_id"),
        _none("WAREHOUSE", "fact_trips", "foreign_keys_not_null", " OR ".join(f"{key} IS NULL" for key in FACT_KEYS)),
        _none("WAREHOUSE", "fact_trips", "foreign_keys_valid", _orphans("dim_station")),
        _same("WAREHOUSE", "fact_trips", "clean_fact_reconciliation", FACT_COUNT, _value("count(*)", "int_trips_clean")),
    ),
    "dq_analytics": _all(
        _same("ANALYTICS", "mart_daily_rides", "fact_reconciliation",
              _value("sum(total_rides)", "mart_daily_rides"), FACT_COUNT),
        _same("ANALYTICS", "mart_hourly_rides", "fact_reconciliation",
              _value("sum(total_rides)", "mart_hourly_rides"), FACT_COUNT),
        _same("ANALYTICS", "mart_station_performance", "departure_reconciliation",
              _value("sum(total_departures)", "mart_station_performance"), FACT_COUNT),
        _same("ANALYTICS", "mart_station_performance", "arrival_reconciliation",
              _value("sum(total_arrivals)", "mart_station_performance"), FACT_COUNT),
    ),
    "dq_raw_status": f"""SELECT *, CASE WHEN total = 0 THEN 'GBFS data kosong'
            WHEN invalid_station > 0 THEN 'GBFS station tidak valid'
            WHEN invalid_availability > 0 THEN 'GBFS availability tidak valid' END AS failure
        FROM (SELECT count(*) AS total, count(*) FILTER (coalesce(trim(station_id), '') = '') AS invalid_station,
            count(*) FILTER ({NEGATIVE}) AS invalid_availability, CAST(4 AS BIGINT) AS freshness_minutes
            FROM raw_station_status)""",
    "dq_stg_status": _all(
        _some("STREAMING_STAGING", "stg_station_status"),
        _none("STREAMING_STAGING", "stg_station_status", "identity_valid", "station_id IS NULL OR snapshot_timestamp IS NULL"),
        _none("STREAMING_STAGING", "stg_station_status", "availability_valid", NEGATIVE),
    ),
    "dq_int_status": _all(
        _some("STREAMING_INTERMEDIATE", "int_station_status"),
        _none("STREAMING_INTERMEDIATE", "int_station_status", "identity_valid",
              "station_id IS NULL OR snapshot_timestamp IS NULL"),
        _none("STREAMING_INTERMEDIATE", "int_station_status", "business_rules", f"{NEGATIVE} OR available_capacity < 0"),
    ),
    "dq_fact_station_status": _all(
        _some("STREAMING_WAREHOUSE", "fact_station_status"),
        _none("STREAMING_WAREHOUSE", "fact_station_status", "key_valid", "station_key IS NULL OR snapshot_timestamp IS NULL"),
        _none("STREAMING_WAREHOUSE", "fact_station_status", "availability_valid", NEGATIVE),
        _distinct("STREAMING_WAREHOUSE", "fact_station_status", "duplicate_event", "(station_key, snapshot_timestamp)"),
    ),
    "dq_station_live": _same("STREAMING_ANALYTICS", "mart_station_live", "station_unique",
                             _value("count(*)", "mart_station_live"), _value("count(DISTINCT station_key)", "mart_station_live")),
    "check_freshness": f"""SELECT checked_after, date_sub('minute', newest, newest + waited) AS freshness_minutes,
            date_sub('minute', newest, newest + waited) > 5 AS is_stale
        FROM (SELECT {NEWEST} AS newest),
            (VALUES ('4m', INTERVAL 4 MINUTE), ('5m59s', INTERVAL 359 SECOND), ('6m', INTERVAL 6 MINUTE))
            AS moments(checked_after, waited)""",
    "check_trips_business_rules": f"""SELECT 'stg_trips' AS table_name, count(*) AS trips,
            count(*) FILTER ({OUT_OF_RULES}) AS out_of_rules FROM stg_trips
        UNION ALL SELECT 'int_trips_clean', count(*), count(*) FILTER ({OUT_OF_RULES}) FROM int_trips_clean""",
    "check_fact_foreign_keys": f"""SELECT 'all' AS stations, count(*) AS orphans FROM fact_trips
            WHERE {_orphans('dim_station')}
        UNION ALL SELECT 'feed', count(*) FROM fact_trips
            WHERE {_orphans('dim_station WHERE gbfs_station_id IS NOT NULL')}""",
    "check_status_duplicate_events": """SELECT count(*) - count(DISTINCT (station_key, snapshot_timestamp))
        AS duplicate_event FROM fact_station_status""",
    "check_non_negative_metrics": """SELECT * FROM mart_daily_rides
        WHERE least(total_rides, avg_ride_duration_minutes, avg_trip_distance_km) < 0""",
    "check_accepted_values": _all(*[
        f"""SELECT '{table}' AS table_name, '{column}' AS column_name,
            count(*) FILTER ({column} NOT IN ({values})) AS violations FROM {table}"""
        for table, column, values in (
            ("int_trips_clean", "member_casual", "'member', 'casual'"),
            ("int_trips_clean", "rideable_type", "'classic_bike', 'electric_bike'"),
            ("dim_rider_type", "rider_type", "'member', 'casual'"),
            ("dim_bike_type", "bike_type", "'classic_bike', 'electric_bike'"),
            ("stg_trips", "member_casual", "'member', 'casual'"),
            ("stg_trips", "rideable_type", "'classic_bike', 'electric_bike'"),
        )
    ]),
    "check_reconciliation_staging": f"""SELECT {_value('count(*)', 'stg_trips')} AS staged_rows,
        {_value('count(*)', 'int_trips_clean')} AS clean_rows, {_value('count(*)', 'int_trips_invalid')} AS rejected_rows""",
    "check_reconciliation_fact": f"""SELECT {_value('count(*)', 'int_trips_clean')} AS clean_rows,
        {FACT_COUNT} AS fact_rows""",
    "check_reconciliation_marts": f"""SELECT {FACT_COUNT} AS fact_rows,
        {_value('CAST(sum(total_rides) AS BIGINT)', 'mart_daily_rides')} AS daily_rides,
        {_value('CAST(sum(total_rides) AS BIGINT)', 'mart_hourly_rides')} AS hourly_rides,
        {_value('CAST(sum(total_departures) AS BIGINT)', 'mart_station_performance')} AS departures,
        {_value('CAST(sum(total_arrivals) AS BIGINT)', 'mart_station_performance')} AS arrivals""",
    "audit_rows": f"""SELECT run_id, 'daily' AS dag_id, results.*
        FROM (VALUES ('run-1'), ('run-2')) AS runs(run_id), ({_all(STAGED_TRIPS, STAGED_STATIONS)}) AS results""",
    # Events and streams
    "validate_events_batch": f"""SELECT event_id, error_reason, {', '.join(
        f'CASE WHEN error_reason IS NULL THEN {name} END AS {name}'
        for name in f'station_id, {COUNTS}, {FLAGS}, last_reported, snapshot_timestamp'.split(', '))}
        FROM event_outcomes""",
    "recent_dlq_count": """SELECT minutes AS trailing_minutes, count(*) AS dead_letters,
            CASE WHEN count(*) > 100 THEN 'WARN' ELSE 'PASS' END AS status
        FROM (VALUES (CAST(5 AS BIGINT)), (28800)) AS spans(minutes), dlq
        WHERE detected_at >= (SELECT max(detected_at) FROM dlq) - to_minutes(minutes) GROUP BY ALL""",
    "dlq_window_counts": """SELECT time_bucket(INTERVAL 5 MINUTE, detected_at) AS window_start,
            time_bucket(INTERVAL 5 MINUTE, detected_at) + INTERVAL 5 MINUTE AS window_end, count(*) AS dead_letters
        FROM dlq GROUP BY ALL""",
    "generate_invalid_events": """SELECT CASE event_id % 3 WHEN 0 THEN 'station_id tidak valid.'
            WHEN 1 THEN 'num_bikes_available tidak boleh negatif.' ELSE 'snapshot_timestamp tidak valid.' END AS error_reason,
            count(*) AS events FROM events GROUP BY ALL""",
    "stream_publish": """SELECT station_id, count(*) AS messages, CAST(sum(ebikes) AS BIGINT) AS ebikes FROM (
            SELECT station_id, NULL AS ebikes FROM raw_station_status WHERE event_id % 50 <> 0
            UNION ALL SELECT station_id || 't', num_ebikes_available FROM raw_station_status) GROUP BY ALL""",
    "stream_source": """SELECT count(*) AS messages, count(*) FILTER (event_id % 50 = 0) AS blank_ids FROM events""",
    "stream_validate": "SELECT * FROM valid_events",
    "stream_split": """SELECT coalesce(error_reason, 'valid') AS outcome, count(*) AS events
        FROM event_outcomes GROUP BY ALL""",
    "stream_valid_sink": "SELECT * FROM valid_events",
    "stream_dlq_sink": """SELECT error_reason, 'gbfs_station_status' AS source, count(*) AS dead_letters,
        count(*) AS error_ids, count(*) FILTER (event_id % 50 = 2) AS cut_payloads
        FROM event_outcomes WHERE error_reason IS NOT NULL GROUP BY ALL""",
    "stream_station_live": """SELECT * FROM valid_events WHERE (station_id, snapshot_timestamp) IN
        (SELECT (station_id, max(snapshot_timestamp)) FROM valid_events GROUP BY station_id)""",
    "realtime_refresh": """SELECT 'fact_station_status_' || load AS table_name,
            (SELECT count(*) FROM known_events WHERE (snapshot_timestamp < TIMESTAMP '2024-01-15') = (load = 1) AND load < 3) AS rows
        FROM (VALUES (1), (2), (3)) AS loads(load)
        UNION ALL SELECT 'mart_station_live_' || load, (SELECT count(DISTINCT station_id) FROM known_events
            WHERE snapshot_timestamp < TIMESTAMP '2024-01-15' OR load > 1) FROM (VALUES (1), (2), (3)) AS loads(load)""",
    "stream_to_raw": """SELECT CASE WHEN error_reason IS NULL THEN 'station_status' ELSE 'station_status_dlq' END AS table_name,
            coalesce(error_reason, 'valid') AS outcome, count(*) AS events,
            CAST(sum(count(*)) OVER (PARTITION BY error_reason IS NULL) AS BIGINT) AS ledger_rows
        FROM event_outcomes GROUP BY error_reason""",
    "realtime_from_stream": """SELECT 'fact_station_status' AS table_name, count(*) AS rows FROM known_events
        UNION ALL SELECT 'mart_station_live', count(DISTINCT station_id) FROM known_events
        UNION ALL SELECT 'dead letters ' || CASE WHEN count(*) > 100 THEN 'WARN' ELSE 'PASS' END, count(*) FROM event_outcomes WHERE error_reason IS NOT NULL""",
    "stream_status_fact": """SELECT snapshot_date, count(*) AS snapshots,
        CAST(sum(available_capacity) AS BIGINT) AS available_capacity FROM fact_station_status GROUP BY ALL""",
}


def _add_column_tests() -> None:
    not_null = {
        "stg_trips": "ride_id",
        "stg_station_information": "station_id, short_name",
        "stg_station_status": "station_id, snapshot_timestamp",
        "int_trips_clean": "ride_id, trip_date",
        "int_trips_invalid": "ride_id, invalid_reason",
        "int_station_information_clean": "station_id, short_name",
        "int_station_status": "station_id, snapshot_timestamp",
        "fact_trips": f"ride_id, {', '.join(FACT_KEYS)}",
        "fact_station_status": "station_key, snapshot_timestamp",
        "mart_daily_rides": "ride_date, rider_type, bike_type, total_rides",
        "mart_hourly_rides": "ride_date, ride_hour, rider_type, bike_type, total_rides",
        "mart_station_performance": "ride_date, station_key, total_departures, total_arrivals",
        "mart_station_live": "station_key, snapshot_timestamp",
    }
    SELECTS["check_not_null"] = _all(*[
        f"""SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) - count({column}) AS violations
            FROM {table}"""
        for table, columns in not_null.items() for column in columns.split(", ")
    ])
    unique = {
        "stg_trips": "ride_id",
        "stg_station_information": "station_id, short_name",
        "int_trips_clean": "ride_id",
        "int_station_information_clean": "station_id, short_name",
        "fact_trips": "ride_id",
        "mart_station_live": "station_key",
    }
    for table, columns in unique.items():
        for column in columns.split(", "):
            SELECTS[f"check_{table}_{column}_unique"] = f"""SELECT count(*) AS total,
                count(*) - count(DISTINCT {column}) AS duplicates FROM {table}"""
            SELECTS[f"check_{table}_{column}_unique_test"] = f"""SELECT {column} AS key, count(*) AS occurrences
                FROM {table} WHERE {column} IS NOT NULL GROUP BY ALL HAVING count(*) > 1"""
    parents = dict(zip(FACT_KEYS, ("dim_date", "dim_station", "dim_station", "dim_rider_type", "dim_bike_type"), strict=True))
    relationships = [("fact_trips", key, parent, key.removeprefix("start_").removeprefix("end_"))
                     for key, parent in parents.items()]
    SELECTS["check_unique"] = _all(*[
        f"""SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS repeated_keys,
            CAST(coalesce(sum(n), 0) AS BIGINT) AS repeated_rows FROM (SELECT count(*) AS n FROM {table}
            WHERE {column} IS NOT NULL GROUP BY {column}) WHERE n > 1"""
        for table, columns in unique.items() for column in columns.split(", ")
    ])
    relationships.append(("fact_station_status", "station_key", "dim_station", "station_key"))
    SELECTS["check_relationship"] = _all(*[
        f"""SELECT '{child}' AS table_name, '{key}' AS column_name, count(DISTINCT {key}) AS orphan_keys,
            count({key}) AS orphan_rows FROM {child} WHERE {key} NOT IN (SELECT {parent_key} FROM {parent})"""
        for child, key, parent, parent_key in relationships
    ])
    for child, key, parent, parent_key in relationships:
        SELECTS[f"check_relationship_{child}_{key}"] = f"""SELECT count(DISTINCT {key}) AS orphan_keys,
            count(*) AS orphan_rows FROM {child}
            WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {parent_key} FROM {parent})"""


_add_column_tests()


def _whole_batch(mode: str, rejected: str) -> str:
    """Rows per table of a run over all trips, and whatever gates and schema tests find."""
    sources = {
        "raw_trips": "raw_trips", "station_information": "raw_station_information", "stg_trips": "stg_trips",
        "stg_station_information": "stg_station_information", "int_trips_clean": "int_trips_clean",
        "int_trips_invalid": rejected, "int_station_information_clean": "int_station_information_clean",
        **{name: name for name in ("dim_date", "dim_station", "dim_rider_type", "dim_bike_type", "fact_trips",
                                   "mart_daily_rides", "mart_hourly_rides", "mart_station_performance")},
    }
    gates = _all(STAGED_TRIPS, STAGED_STATIONS, _checked_trips(rejected), SELECTS["dq_int_station_information"],
                 SELECTS["dq_dimensions"], SELECTS["dq_fact_trips"], SELECTS["dq_analytics"])
    not_null = " AND ".join(f"table_name <> '{name}'" for name in
                            ("stg_station_status", "int_station_status", "fact_station_status", "mart_station_live", "int_trips_invalid"))
    tests = _all(
        f"SELECT 'not_null' AS test, table_name, column_name, violations FROM ({SELECTS['check_not_null']}) WHERE {not_null}",
        *[f"SELECT 'not_null', 'int_trips_invalid', '{name}', count(*) - count({name}) FROM {rejected}" for name in ("ride_id", "invalid_reason")],
        f"SELECT 'accepted_values', * FROM ({SELECTS['check_accepted_values']}) WHERE table_name <> 'stg_trips'",
        f"""SELECT 'unique', table_name, column_name, repeated_keys FROM ({SELECTS['check_unique']})
            WHERE table_name <> 'mart_station_live'""",
        f"""SELECT 'relationship', table_name, column_name, orphan_rows FROM ({SELECTS['check_relationship']})
            WHERE table_name <> 'fact_station_status'""",
        f"SELECT 'non_negative', 'mart_daily_rides', 'total_rides', count(*) FROM ({SELECTS['check_non_negative_metrics']})",
    )
    return _all(
        *[f"SELECT '{mode}' AS mode, 'rows of {table}' AS item, CAST(count(*) AS VARCHAR) AS result FROM {source}"
          for table, source in sources.items()],
        f"SELECT '{mode}', 'FAIL ' || table_name || '.' || check_name, actual_value FROM ({gates}) WHERE status = 'FAIL'",
        f"SELECT '{mode}', 'FAIL ' || test || ' ' || table_name || '.' || column_name, CAST(violations AS VARCHAR) FROM ({tests}) WHERE violations > 0",
        f"SELECT '{mode}', 'audited checks', CAST(count(*) AS VARCHAR) FROM ({gates})",
        f"SELECT '{mode}', 'schema tests', CAST(count(*) AS VARCHAR) FROM ({tests})",
    )


SELECTS["daily_batch"] = _all(_whole_batch("reference", "int_trips_invalid"), _whole_batch("complete", "int_trips_not_clean"))

ORACLES: dict[str, str] = {name: _with_tables(select) for name, select in SELECTS.items()}
