"""DuckDB SQL that states what each registered query has to return."""

from __future__ import annotations

# Relations, each naming the ones it reads.
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def relation(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (sql, needs)


def with_relations(sql: str, *needs: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][1]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for need in needs:
        visit(need)
    body = ",\n".join(f"{name} AS ({CTES[name][0]})" for name in ordered)
    return f"WITH {body}\n{sql}" if body else sql


def r(value: str, digits: int) -> str:
    """Round half up on the decimal value."""
    return f"CAST(round(CAST({value} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def mean(column: str, digits: int) -> str:
    """Mean of values with so many decimals, over integers."""
    scale = 10**digits
    return (
        f"(CAST(sum(CAST(round({column} * {scale}) AS BIGINT)) AS DOUBLE)"
        f" / nullif(count({column}) * {scale}, 0))"
    )


def n(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


relation(
    "trips_raw",
    """
    SELECT l_orderkey || '-' || l_linenumber AS ride_id,
           CASE WHEN l_linestatus = 'O' THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
           CASE WHEN l_linenumber = 6 AND l_partkey % 50 = 0 THEN 'n/a'
                WHEN l_orderkey % 2 = 1 THEN start_text || '.250' ELSE start_text END AS started_at,
           end_text AS ended_at,
           CASE WHEN l_suppkey % 3 = 0 THEN ' ' || upper(s_name) || ' ' ELSE s_name END AS start_station_name,
           CASE WHEN l_orderkey % 97 <> 0 THEN l_suppkey || '.01' END AS start_station_id,
           'Supplier#' || lpad(CAST(l_partkey % 100 AS VARCHAR), 9, '0') AS end_station_name,
           CASE WHEN l_orderkey % 89 <> 0 THEN (l_partkey % 100) || '.01' END AS end_station_id,
           CAST(40.5 AS DOUBLE) + (l_suppkey % 32) / CAST(64 AS DOUBLE) AS start_lat,
           CAST(-74 AS DOUBLE) + (l_suppkey % 32) / CAST(64 AS DOUBLE) AS start_lng,
           CAST(40.5 AS DOUBLE) + (l_partkey % 32) / CAST(64 AS DOUBLE) AS end_lat,
           CAST(-74 AS DOUBLE) + (l_partkey % 32) / CAST(64 AS DOUBLE) AS end_lng,
           CASE WHEN l_returnflag = 'A' THEN 'casual' ELSE 'member' END AS member_casual
    FROM (
        SELECT *, strftime(l_shipdate + to_seconds(CAST(off AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS start_text,
               strftime(l_shipdate + to_seconds(CAST(off + dur AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS end_text
        FROM (
            SELECT l.*, s.s_name, l_orderkey * 37 % 86400 AS off,
                   CASE WHEN l_linenumber = 7 THEN floor(l_extendedprice) - 1500
                        ELSE floor(l_extendedprice / 20) END AS dur
            FROM lineitem l JOIN supplier s ON l_suppkey = s_suppkey))
    """,
)
relation(
    "parsed",
    """
    SELECT *, try_strptime(started_at, ['%Y-%m-%d %H:%M:%S.%g', '%Y-%m-%d %H:%M:%S']) AS started_at_ts,
           try_strptime(ended_at, ['%Y-%m-%d %H:%M:%S.%g', '%Y-%m-%d %H:%M:%S']) AS ended_at_ts
    FROM trips_raw
    """,
    "trips_raw",
)
relation(
    "valid",
    """
    SELECT *, CAST(epoch(date_trunc('second', ended_at_ts)) - epoch(date_trunc('second', started_at_ts)) AS BIGINT) AS secs
    FROM parsed
    WHERE start_station_id IS NOT NULL AND end_station_id IS NOT NULL AND ended_at_ts > started_at_ts
      AND epoch(date_trunc('second', ended_at_ts)) - epoch(date_trunc('second', started_at_ts)) < 86400
    """,
    "parsed",
)
relation(
    "clean",
    f"""
    SELECT ride_id, rideable_type, started_at_ts, ended_at_ts, start_station_id, start_station_name,
           end_station_id, end_station_name, start_lat, start_lng, end_lat, end_lng, member_casual,
           {r('secs / 60', 2)} AS trip_duration_minutes,
           CAST(hour(started_at_ts) AS INTEGER) AS start_hour,
           CAST(dayofweek(started_at_ts) + 1 AS INTEGER) AS start_day_of_week,
           dayname(started_at_ts) AS start_day_name, CAST(started_at_ts AS DATE) AS trip_date,
           CAST(year(started_at_ts) AS INTEGER) AS year, CAST(month(started_at_ts) AS INTEGER) AS month
    FROM valid
    """,
    "valid",
)
relation(
    "stg_trips",
    """
    SELECT * RENAME (started_at_ts AS started_at, ended_at_ts AS ended_at) FROM clean
    WHERE ride_id IS NOT NULL AND start_station_id IS NOT NULL AND started_at_ts IS NOT NULL
      AND trip_duration_minutes BETWEEN 1 AND 720
    """,
    "clean",
)
relation(
    "snapshots",
    """
    SELECT 'feed-' || user_id AS station_id, k % 15 AS num_bikes_available, k % 5 AS num_ebikes_available,
           15 - k % 15 AS num_docks_available, k % 3 AS num_bikes_disabled,
           CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS is_installed, 1 AS is_renting,
           CASE WHEN event_type = 'view' THEN 0 ELSE 1 END AS is_returning,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS snapshot_at,
           CAST(floor(epoch(ts)) AS BIGINT) AS snapshot_epoch, ts, event_type, user_id
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
    """,
)
relation(
    "stations",
    """
    SELECT 'feed-' || s_suppkey AS station_id, s_name AS name, right(s_name, 4) AS short_name,
           CAST(40.5 AS DOUBLE) + (s_suppkey % 32) / CAST(64 AS DOUBLE) AS lat,
           CAST(-74 AS DOUBLE) + (s_suppkey % 32) / CAST(64 AS DOUBLE) AS lon,
           CAST(floor(s_acctbal / 250) AS BIGINT) AS capacity, CAST(s_nationkey AS VARCHAR) AS region_id,
           s_suppkey AS number
    FROM supplier
    """,
)
relation(
    "stg_snapshots",
    """
    SELECT ts AS snapshot_at, CAST(hour(ts) AS INTEGER) AS snapshot_hour, CAST(ts AS DATE) AS snapshot_date,
           station_id, num_bikes_available, num_ebikes_available, num_docks_available, num_bikes_disabled,
           CAST(is_installed AS BIGINT) AS is_installed, CAST(is_renting AS BIGINT) AS is_renting,
           CAST(is_returning AS BIGINT) AS is_returning
    FROM snapshots WHERE station_id IS NOT NULL AND ts IS NOT NULL AND is_installed = 1
    """,
    "snapshots",
)
relation(
    "stg_stations",
    """
    SELECT station_id, name AS station_name, short_name AS station_short_name, lat AS latitude,
           lon AS longitude, capacity AS total_capacity, region_id
    FROM stations WHERE station_id IS NOT NULL AND name IS NOT NULL AND capacity > 0
    """,
    "stations",
)
relation(
    "departures",
    f"""
    SELECT start_station_id AS station_id, start_station_name AS station_name, start_hour AS hour_of_day,
           start_day_of_week, start_day_name, count(*) AS total_departures,
           {mean('trip_duration_minutes', 2)} AS avg_trip_duration_minutes,
           {n("count_if(member_casual = 'member')")} AS member_departures,
           {n("count_if(member_casual = 'casual')")} AS casual_departures,
           {n("count_if(rideable_type = 'electric_bike')")} AS ebike_departures
    FROM stg_trips GROUP BY ALL
    """,
    "stg_trips",
)
relation(
    "arrivals",
    """
    SELECT end_station_id AS station_id, start_hour AS hour_of_day, start_day_of_week,
           count(*) AS total_arrivals
    FROM stg_trips GROUP BY ALL
    """,
    "stg_trips",
)
relation(
    "arrivals_by_end",
    """
    SELECT end_station_id AS station_id, CAST(hour(ended_at) AS INTEGER) AS hour_of_day,
           CAST(dayofweek(ended_at) + 1 AS INTEGER) AS start_day_of_week, count(*) AS total_arrivals
    FROM stg_trips GROUP BY ALL
    """,
    "stg_trips",
)


def _demand(arrivals: str) -> str:
    return f"""
    SELECT d.station_id, d.station_name, d.hour_of_day, d.start_day_of_week, d.start_day_name,
           d.total_departures, coalesce(a.total_arrivals, 0) AS total_arrivals,
           d.total_departures - coalesce(a.total_arrivals, 0) AS net_demand,
           CAST(d.total_departures AS DOUBLE) / nullif(a.total_arrivals, 0) AS demand_to_arrival_ratio,
           d.avg_trip_duration_minutes, d.member_departures, d.casual_departures, d.ebike_departures
    FROM departures d LEFT JOIN {arrivals} a
      ON d.station_id = a.station_id AND d.hour_of_day = a.hour_of_day
     AND d.start_day_of_week = a.start_day_of_week
    """


relation("demand", _demand("arrivals"), "departures", "arrivals")
relation("demand_by_end", _demand("arrivals_by_end"), "departures", "arrivals_by_end")

_CAPACITY = """
    SELECT s.station_id, {taken}, s.num_bikes_available, s.num_ebikes_available, s.num_docks_available,
           s.is_renting, i.total_capacity, i.station_name, i.latitude, i.longitude,
           CAST(s.num_bikes_available AS DOUBLE) / i.total_capacity AS availability_ratio
    FROM stg_snapshots s JOIN stg_stations i ON s.station_id = i.station_id
"""
relation(
    "with_capacity",
    _CAPACITY.format(taken="s.snapshot_at, s.snapshot_hour, s.snapshot_date"),
    "stg_snapshots",
    "stg_stations",
)
# The test month is January, when New York is five hours behind UTC.
relation(
    "with_capacity_local",
    _CAPACITY.format(
        taken="CAST(hour(s.snapshot_at - INTERVAL 5 HOUR) AS INTEGER) AS snapshot_hour"
    ),
    "stg_snapshots",
    "stg_stations",
)

_MEASURES = f"""
           {r('avg(num_bikes_available)', 2)} AS avg_bikes_available,
           {r('avg(num_ebikes_available)', 2)} AS avg_ebikes_available,
           {r('avg(num_docks_available)', 2)} AS avg_docks_available,
           {r('avg(availability_ratio)', 4)} AS avg_availability_ratio,
           {r('CAST(count_if(availability_ratio < 0.1) AS DOUBLE) / count(*)', 4)} AS pct_time_near_empty,
           {r('CAST(count_if(availability_ratio > 0.9) AS DOUBLE) / count(*)', 4)} AS pct_time_near_full,
           count(*) AS snapshot_count
"""


def _hourly(source: str) -> str:
    return f"""
    SELECT station_id, station_name, latitude, longitude, total_capacity, snapshot_hour AS hour_of_day,
           {_MEASURES}
    FROM {source} GROUP BY ALL
    """


relation("hourly", _hourly("with_capacity"), "with_capacity")
relation("hourly_local", _hourly("with_capacity_local"), "with_capacity_local")


def _supply(source: str, keys: str, name: str = "station_name") -> str:
    return f"""
    SELECT {name} AS station_name, {keys}max(station_id) AS supply_station_id, max(latitude) AS latitude,
           max(longitude) AS longitude, max(total_capacity) AS total_capacity,
           {r(mean('avg_bikes_available', 2), 2)} AS avg_bikes_available,
           {r(mean('avg_ebikes_available', 2), 2)} AS avg_ebikes_available,
           {r(mean('avg_availability_ratio', 4), 4)} AS avg_availability_ratio,
           {r(mean('pct_time_near_empty', 4), 4)} AS pct_time_near_empty,
           {n('sum(snapshot_count)')} AS snapshot_count
    FROM {source} GROUP BY {'hour_of_day, ' if keys else ''}{'station_name' if name == 'station_name' else 'lower(trim(station_name))'}
    """


relation("supply", _supply("hourly", ""), "hourly")
relation("supply_by_hour", _supply("hourly_local", "hour_of_day, "), "hourly_local")
relation("supply_on_key", _supply("hourly", "", "min(station_name)"), "hourly")

_SCORED_COLUMNS = """
           d.station_id, d.station_name, a.supply_station_id, d.hour_of_day, d.start_day_of_week,
           d.start_day_name, a.latitude, a.longitude, a.total_capacity, d.total_departures,
           d.total_arrivals, d.net_demand, d.demand_to_arrival_ratio, d.avg_trip_duration_minutes,
           d.member_departures, d.casual_departures, d.ebike_departures, a.avg_bikes_available,
           a.avg_ebikes_available, a.avg_availability_ratio, a.pct_time_near_empty, a.snapshot_count
"""


def _scored(supply: str, more: str = "", missing: str = "{m}") -> str:
    gap = missing.format(m="(1 - CAST(coalesce(a.avg_availability_ratio, 0) AS DECIMAL(12,4)))")
    return f"""
    SELECT {_SCORED_COLUMNS},
           CAST(round(CAST(d.total_departures AS DECIMAL(12,0)) * {gap}, 2) AS DOUBLE) AS supply_gap_score
    FROM demand d JOIN {supply} a ON lower(trim(d.station_name)) = lower(trim(a.station_name)){more}
    """


relation("scored", _scored("supply"), "demand", "supply")
relation(
    "scored_by_hour",
    _scored("supply_by_hour", " AND d.hour_of_day = a.hour_of_day"),
    "demand",
    "supply_by_hour",
)
relation(
    "scored_clamped",
    _scored("supply_on_key", missing="greatest(CAST(0 AS DECIMAL(12,4)), {m})"),
    "demand",
    "supply_on_key",
)

TIES = "station_id, hour_of_day, start_day_of_week, station_name, supply_station_id"
ORDER = f"supply_gap_score DESC, {TIES}"
SEVERITY = """CASE WHEN supply_gap_score >= 5 THEN 'CRITICAL' WHEN supply_gap_score >= 2 THEN 'HIGH'
                WHEN supply_gap_score >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END"""


def _ranked(source: str) -> str:
    return f"""
    SELECT *, row_number() OVER (ORDER BY {ORDER}) AS overall_gap_rank,
           row_number() OVER (PARTITION BY hour_of_day ORDER BY {ORDER}) AS gap_rank_within_hour,
           row_number() OVER (PARTITION BY station_id ORDER BY {ORDER}) AS worst_hour_rank_for_station,
           row_number() OVER (PARTITION BY station_id ORDER BY {ORDER}) = 1 AS is_peak_gap_hour,
           {SEVERITY} AS gap_severity
    FROM {source}
    """


relation("mart", _ranked("scored"), "scored")
relation("mart_by_hour", _ranked("scored_by_hour"), "scored_by_hour")
relation("mart_clamped", _ranked("scored_clamped"), "scored_clamped")
relation(
    "files",
    """
    SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'JC-' ELSE '' END || strftime(o_orderdate, '%Y%m')
           || CASE WHEN o_orderkey % 5 = 0 THEN '-trip_data' ELSE '-trip-data' END
           || CASE o_orderkey % 4 WHEN 0 THEN '.zip' WHEN 1 THEN '.csv' WHEN 2 THEN '.csv.zip'
                                  ELSE '.html' END AS key,
           o_orderkey AS size_bytes
    FROM orders
    """,
)

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str, *needs: str) -> None:
    ORACLE[name] = with_relations(sql, *needs)


_SNAPSHOT_ROW = """station_id, num_bikes_available, num_ebikes_available, num_docks_available,
       num_bikes_disabled, is_installed, is_renting, is_returning, snapshot_at, snapshot_epoch"""

# Sources and sinks
oracle("trips_csv_scan", "SELECT * FROM trips_raw", "trips_raw")
oracle(
    "trips_csv_corrupt",
    """SELECT CASE WHEN ended_at LIKE '%7' THEN 'corrupt' ELSE 'good' END AS kind, ride_id,
              CASE WHEN ended_at LIKE '%7' THEN
                  ride_id || ',' || rideable_type || ',' || started_at || ',' || ended_at || ','
                  || start_station_name || ',' || coalesce(start_station_id, '') || ',' || end_station_name
                  || ',' || coalesce(end_station_id, '') || ',north,' || start_lng || ',' || end_lat || ','
                  || end_lng || ',' || member_casual END AS line
       FROM trips_raw""",
    "trips_raw",
)
oracle(
    "trips_csv_layouts",
    """SELECT * FROM trips_raw WHERE rideable_type = 'electric_bike'
       UNION ALL
       SELECT ride_id, NULL, started_at, ended_at, start_station_name, start_station_id,
              end_station_name, end_station_id, NULL, NULL, NULL, NULL, NULL
       FROM trips_raw WHERE rideable_type <> 'electric_bike'""",
    "trips_raw",
)
oracle(
    "trips_csv_by_header",
    """SELECT * FROM trips_raw WHERE CAST(split_part(ride_id, '-', 1) AS BIGINT) % 4 IN (0, 2)
       UNION ALL
       SELECT ride_id, NULL, started_at, ended_at, start_station_name, start_station_id,
              end_station_name, end_station_id, NULL, NULL, NULL, NULL, NULL
       FROM trips_raw WHERE CAST(split_part(ride_id, '-', 1) AS BIGINT) % 4 = 1""",
    "trips_raw",
)
oracle("trips_archive_scan", "SELECT * FROM trips_raw", "trips_raw")
oracle(
    "trips_archive_multiline",
    """SELECT * REPLACE (start_station_name || chr(10) || '"A", ' || end_station_name || chr(10) || chr(10) || 'B'
              AS start_station_name) FROM trips_raw""",
    "trips_raw",
)
oracle(
    "trips_archive_failed_member",
    "SELECT * FROM trips_raw WHERE CAST(split_part(ride_id, '-', 1) AS BIGINT) % 3 <> 0",
    "trips_raw",
)
oracle(
    "files_ingest_report",
    """SELECT CASE WHEN CAST(split_part(ride_id, '-', 1) AS BIGINT) % 3 = 0 THEN 'error' ELSE 'success' END AS status,
              count(DISTINCT CAST(split_part(ride_id, '-', 1) AS BIGINT) % 3) AS files
       FROM trips_raw GROUP BY ALL""",
    "trips_raw",
)
oracle(
    "trips_archives_incremental",
    """SELECT ride_id, CAST(CAST(split_part(ride_id, '-', 1) AS BIGINT) % 3 - 1 AS BIGINT) AS load
       FROM trips_raw WHERE CAST(split_part(ride_id, '-', 1) AS BIGINT) % 3 <> 0""",
    "trips_raw",
)
oracle(
    "layer_views",
    """SELECT 'trips' AS table_name, 'VIEW' AS table_type, count(*) AS rows FROM stg_trips
       UNION ALL SELECT 'snapshots', 'VIEW', count(*) FROM stg_snapshots
       UNION ALL SELECT 'stations', 'VIEW', count(*) FROM stg_stations""",
    "stg_trips",
    "stg_snapshots",
    "stg_stations",
)
oracle("demand_incremental", "SELECT * FROM demand", "demand")
oracle(
    "distinct_rolling",
    """SELECT e.year, e.month, count(*) AS rows, count(DISTINCT c.start_station_id) AS stations,
              count(DISTINCT c.ride_id) AS rides, true AS stations_near, true AS rides_near
       FROM (SELECT DISTINCT year, month FROM clean) e
       JOIN clean c ON e.year * 12 + e.month - c.year * 12 - c.month BETWEEN 0 AND 2
       GROUP BY e.year, e.month""",
    "clean",
)
oracle(
    "trips_archive_results",
    """SELECT count(*) AS rows, CAST(0 AS BIGINT) AS corrupt_rows, CAST(0 AS BIGINT) AS errors
       FROM trips_raw""",
    "trips_raw",
)
oracle(
    "snapshots_range",
    f"""SELECT {_SNAPSHOT_ROW}, fmt FROM snapshots, (VALUES ('json'), ('parquet')) t(fmt)
        WHERE CAST(ts AS DATE) IN (DATE '2024-01-14', DATE '2024-01-15', DATE '2024-01-17')""",
    "snapshots",
)
oracle(
    "table_stations_replaced",
    """SELECT station_id, name, short_name, lat, lon, capacity, region_id FROM stations WHERE capacity > 0""",
    "stations",
)
for _name in ("mart_published", "mart_interleaved"):
    oracle(_name, "SELECT * FROM mart", "mart")
oracle(
    "layer_tables",
    "SELECT * FROM (VALUES ('stations', 'MANAGED'), ('files', 'MANAGED')) t(table_name, table_type)",
)
oracle(
    "trips_months_replaced",
    """SELECT year, month, count(*) AS trips FROM clean
       WHERE NOT (year = 1995 AND month = 6 AND member_casual <> 'member') GROUP BY year, month""",
    "clean",
)
oracle(
    "storage_inventory",
    """SELECT DISTINCT 'year=' || year || '/month=' || month || '/' AS folder, true AS has_data FROM clean""",
    "clean",
)
oracle("trips_parquet_scan", "SELECT * FROM clean", "clean")
oracle(
    "trips_external_table",
    "SELECT year, month, count(*) AS trips FROM clean GROUP BY ALL",
    "clean",
)
oracle("snapshots_json_scan", f"SELECT {_SNAPSHOT_ROW} FROM snapshots", "snapshots")
oracle(
    "snapshots_json_day",
    f"SELECT {_SNAPSHOT_ROW} FROM snapshots WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
    "snapshots",
)
oracle(
    "snapshots_flattened",
    f"""SELECT {_SNAPSHOT_ROW} FROM snapshots WHERE event_type NOT IN ('error', 'purchase')
        UNION ALL
        SELECT * REPLACE ('other-' || split_part(station_id, '-', 2) AS station_id)
        FROM (SELECT {_SNAPSHOT_ROW} FROM snapshots WHERE event_type = 'click')""",
    "snapshots",
)
_NEW_FIELD = """SELECT station_id, num_bikes_available, num_bikes_available + 1 AS num_scooters, snapshot_at
       FROM (SELECT * FROM snapshots WHERE event_type NOT IN ('error', 'purchase')
             UNION ALL
             SELECT * REPLACE ('other-' || split_part(station_id, '-', 2) AS station_id)
             FROM snapshots WHERE event_type = 'click')"""
for _name in ("snapshots_flattened_new_field", "snapshots_variant"):
    oracle(_name, _NEW_FIELD, "snapshots")
oracle(
    "snapshots_field_kinds",
    f"""SELECT 'num_scooters' AS field, 'BIGINT' AS kind, count(*) AS readings
        FROM ({_NEW_FIELD}) WHERE num_scooters IS NOT NULL HAVING count(*) > 0""",
    "snapshots",
)
oracle(
    "snapshots_compacted",
    """SELECT CAST(ts AS DATE) AS snapshot_date, count(*) AS readings, CAST(1 AS BIGINT) AS files,
              CAST(sum(num_bikes_available) AS BIGINT) AS bikes
       FROM snapshots GROUP BY CAST(ts AS DATE)""",
    "snapshots",
)
_STAGED = """ts AS snapshot_at, CAST(hour(ts) AS INTEGER) AS snapshot_hour,
       CAST(ts AS DATE) AS snapshot_date, {station} AS station_id, num_bikes_available,
       num_ebikes_available, num_docks_available, num_bikes_disabled,
       CAST(is_installed AS BIGINT) AS is_installed, CAST(is_renting AS BIGINT) AS is_renting,
       CAST(is_returning AS BIGINT) AS is_returning"""
oracle(
    "snapshots_ingest_batch",
    f"""SELECT {_STAGED.format(station='station_id')} FROM snapshots
        WHERE event_type NOT IN ('error', 'purchase')
        UNION ALL
        SELECT {_STAGED.format(station="'other-' || user_id")} FROM snapshots
        WHERE event_type = 'click'""",
    "snapshots",
)
oracle(
    "stations_flattened",
    """SELECT CASE WHEN number % 11 <> 0 THEN station_id ELSE '' END AS station_id,
              CASE WHEN number % 7 <> 0 THEN name ELSE '' END AS name, short_name, lat,
              CASE WHEN number % 5 <> 0 THEN lon ELSE 0 END AS lon,
              CASE WHEN capacity > 0 THEN capacity ELSE 0 END AS capacity, region_id,
              TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at
       FROM stations""",
    "stations",
)
oracle(
    "trips_sample",
    """SELECT ride_id, started_at_ts, start_station_name, end_station_name, member_casual,
              trip_duration_minutes
       FROM clean ORDER BY ALL LIMIT 3""",
    "clean",
)
oracle(
    "row_counts",
    """SELECT 'trips' AS relation, count(*) AS row_count FROM clean
       UNION ALL SELECT 'snapshots', count(*) FROM snapshots
       UNION ALL SELECT 'stations', count(*) FROM stations
       UNION ALL SELECT 'stg_trips', count(*) FROM stg_trips
       UNION ALL SELECT 'stg_snapshots', count(*) FROM stg_snapshots
       UNION ALL SELECT 'stg_stations', count(*) FROM stg_stations
       UNION ALL SELECT 'demand_hourly', count(*) FROM demand
       UNION ALL SELECT 'availability_hourly', count(*) FROM hourly
       UNION ALL SELECT 'mart', count(*) FROM mart""",
    "mart",
)

# File listing
_EXTENSION = "(key LIKE '%.zip' OR key LIKE '%.csv')"
oracle(
    "files_selected",
    f"""SELECT * FROM files WHERE (contains(key, '-trip-data') OR contains(key, '-trip_data'))
        AND NOT starts_with(key, 'JC-') AND key <> 'index.html' AND {_EXTENSION}""",
    "files",
)
oracle(
    "files_selected_loose",
    f"""SELECT * FROM files WHERE contains(key, '-trip-data') OR (contains(key, '-trip_data')
        AND NOT starts_with(key, 'JC-') AND key <> 'index.html' AND {_EXTENSION})""",
    "files",
)
_MONTH = "try_strptime(left(key, 6), '%Y%m')"
oracle(
    "files_recent", f"SELECT * FROM files WHERE {_MONTH} >= TIMESTAMP '2000-08-01'", "files"
)
oracle(
    "files_recent_exclusive",
    f"SELECT * FROM files WHERE {_MONTH} >= TIMESTAMP '2000-08-01 09:00:00'",
    "files",
)
oracle(
    "files_pending",
    """SELECT key, size_bytes FROM files f
       WHERE NOT EXISTS (SELECT 1 FROM files m WHERE m.size_bytes % 3 = 0 AND m.key = f.key)""",
    "files",
)
oracle(
    "files_inventory",
    """SELECT CASE WHEN starts_with(key, 'JC-') THEN 'other/' || key ELSE 'raw/' || left(key, 6) END
              AS folder, count(*) AS files, CAST(sum(size_bytes) AS BIGINT) AS bytes
       FROM files GROUP BY 1""",
    "files",
)

# Trips and staging
oracle(
    "trips_parsed",
    "SELECT ride_id, started_at, ended_at, started_at_ts, ended_at_ts FROM parsed",
    "parsed",
)
oracle("trips_clean", "SELECT * EXCLUDE (started_at, ended_at, secs) FROM valid", "valid")
oracle("trips_enriched", "SELECT * FROM clean", "clean")
for _name in ("stg_trips", "stg_snapshots", "stg_stations"):
    oracle(_name, f"SELECT * FROM {_name}", _name)

# Demand and availability
oracle("demand_departures", "SELECT * FROM departures", "departures")
oracle("demand_arrivals", "SELECT * FROM arrivals", "arrivals")
oracle("demand_net", "SELECT * FROM demand", "demand")
oracle("demand_net_joined", "SELECT * FROM demand", "demand")
oracle("demand_net_one_pass", "SELECT * FROM demand", "demand")
oracle("demand_net_by_end_one_pass", "SELECT * FROM demand_by_end", "demand_by_end")
oracle("demand_net_by_end", "SELECT * FROM demand_by_end", "demand_by_end")
oracle(
    "demand_ranked",
    """SELECT *, row_number() OVER (PARTITION BY hour_of_day ORDER BY total_departures DESC,
              station_id, hour_of_day, start_day_of_week, station_name) AS rank_by_departures_in_hour
       FROM demand""",
    "demand",
)
oracle("snapshots_with_capacity", "SELECT * FROM with_capacity", "with_capacity")
oracle("availability_hourly", "SELECT * FROM hourly", "hourly")
oracle("availability_station", "SELECT * FROM supply", "supply")


oracle("availability_station_on_key", "SELECT * FROM supply_on_key", "supply_on_key")
oracle("availability_station_by_hour", "SELECT * FROM supply_by_hour", "supply_by_hour")


def _weighted(column: str, digits: int) -> str:
    scale = 10**digits
    total = f"sum(CAST(round({column} * {scale}) AS BIGINT) * snapshot_count)"
    value = f"CAST({total} AS DOUBLE) / CAST(sum(snapshot_count) * {scale} AS DOUBLE)"
    return f"{r(value, digits)} AS {column}"


oracle(
    "availability_station_weighted",
    f"""SELECT station_name, max(station_id) AS supply_station_id, max(latitude) AS latitude,
               max(longitude) AS longitude, max(total_capacity) AS total_capacity,
               {_weighted('avg_bikes_available', 2)}, {_weighted('avg_ebikes_available', 2)},
               {_weighted('avg_availability_ratio', 4)}, {_weighted('pct_time_near_empty', 4)},
               {n('sum(hourly.snapshot_count)')} AS snapshot_count
        FROM hourly GROUP BY station_name""",
    "hourly",
)

# Gap
_KEYED = f"{TIES}, supply_gap_score"
oracle("mart_joined", "SELECT * FROM scored", "scored")
oracle(
    "stations_unmatched",
    """SELECT DISTINCT 'demand_only' AS side, station_id, station_name FROM demand
       WHERE lower(trim(station_name)) NOT IN (SELECT lower(trim(station_name)) FROM supply)
       UNION ALL
       SELECT DISTINCT 'supply_only', supply_station_id, station_name FROM supply
       WHERE lower(trim(station_name)) NOT IN (SELECT lower(trim(station_name)) FROM demand)""",
    "demand",
    "supply",
)
oracle("gap_rank_overall", f"SELECT {_KEYED}, overall_gap_rank FROM mart", "mart")
oracle("gap_rank_in_hour", f"SELECT {_KEYED}, gap_rank_within_hour FROM mart", "mart")
oracle("gap_rank_in_station", f"SELECT {_KEYED}, worst_hour_rank_for_station FROM mart", "mart")
oracle(
    "gap_peak_flag",
    f"SELECT {_KEYED}, worst_hour_rank_for_station, is_peak_gap_hour FROM mart",
    "mart",
)
oracle("gap_severities", f"SELECT {_KEYED}, gap_severity FROM mart", "mart")
for _name in ("mart", "mart_by_hour", "mart_clamped"):
    oracle(_name, f"SELECT * FROM {_name}", _name)
oracle(
    "worst_station_hours",
    f"""SELECT {_KEYED}, total_departures, avg_availability_ratio FROM scored
        ORDER BY {ORDER} LIMIT 10""",
    "scored",
)

# Reports
_LEVEL = "list_position(['CRITICAL', 'HIGH', 'MEDIUM', 'LOW'], gap_severity)"
oracle(
    "report_worst_stations",
    f"""SELECT station_name, station_id,
               {r('sum(CAST(supply_gap_score AS DECIMAL(18,2)))', 0)} AS total_gap_score,
               {n('sum(total_departures)')} AS total_historical_trips,
               {r(mean('avg_availability_ratio', 4), 3)} AS avg_availability_all_hours,
               {r(mean('pct_time_near_empty', 4), 3)} AS avg_pct_time_near_empty,
               max(gap_severity) AS max_severity_label,
               arg_min(gap_severity, {_LEVEL}) AS worst_severity
        FROM mart GROUP BY station_name, station_id
        ORDER BY total_gap_score DESC, station_id, station_name LIMIT 10""",
    "mart",
)
oracle(
    "report_by_hour",
    f"""SELECT hour_of_day,
               CASE WHEN hour_of_day BETWEEN 6 AND 9 THEN 'Morning Commute'
                    WHEN hour_of_day BETWEEN 10 AND 15 THEN 'Midday'
                    WHEN hour_of_day BETWEEN 16 AND 20 THEN 'Evening Commute'
                    ELSE 'Off-Peak' END AS time_period,
               {r(mean('supply_gap_score', 2), 2)} AS avg_supply_gap,
               {n('sum(total_departures)')} AS total_departures_system_wide,
               {r(mean('avg_availability_ratio', 4), 3)} AS avg_availability,
               count(DISTINCT station_id) AS stations_observed
        FROM mart GROUP BY hour_of_day""",
    "mart",
)
oracle(
    "report_quality",
    f"""SELECT count(DISTINCT station_id) AS total_stations, count(DISTINCT hour_of_day) AS hours_covered,
               {n('sum(total_departures)')} AS total_trips_analyzed,
               {n('sum(snapshot_count)')} AS total_availability_snapshots,
               min(avg_availability_ratio) AS min_avg_availability,
               max(avg_availability_ratio) AS max_avg_availability,
               {n("count_if(gap_severity = 'CRITICAL')")} AS critical_station_hours,
               {n("count_if(gap_severity = 'HIGH')")} AS high_station_hours
        FROM mart""",
    "mart",
)
oracle(
    "report_hour_coverage",
    "SELECT hour_of_day, count(*) AS row_count FROM mart GROUP BY hour_of_day",
    "mart",
)
oracle(
    "report_severity_counts",
    "SELECT gap_severity, count(*) AS row_count FROM mart GROUP BY gap_severity",
    "mart",
)
oracle(
    "report_coverage",
    """SELECT count(*) AS total_rows, count(DISTINCT station_name) AS unique_stations,
              count(DISTINCT hour_of_day) AS hours_covered,
              CAST(sum(CASE WHEN avg_bikes_available IS NOT NULL THEN 1 END) AS BIGINT)
              AS rows_with_availability
       FROM mart""",
    "mart",
)
_COUNT_IF = ", ".join(
    f"CAST(count_if(gap_severity = '{s}') AS BIGINT) AS {s.lower()}"
    for s in ("CRITICAL", "HIGH", "MEDIUM", "LOW")
)
oracle(
    "report_severity_pivot",
    f"""SELECT count(*) AS total_rows, count(DISTINCT station_name) AS stations,
               count(DISTINCT hour_of_day) AS hours, {_COUNT_IF}
        FROM mart""",
    "mart",
)


def _pct(ratio: str) -> str:
    return f"CAST(round(CAST({ratio} AS DECIMAL(20,10)) * 100, 1) AS DOUBLE)"


oracle(
    "report_crisis_moments",
    f"""SELECT overall_gap_rank AS rank, station_name, hour_of_day, start_day_name AS day_of_week,
               total_departures, {r('avg_bikes_available', 1)} AS avg_bikes_available, total_capacity,
               {_pct('avg_availability_ratio')} AS availability_pct,
               {_pct('mart.pct_time_near_empty')} AS pct_time_near_empty,
               {r('mart.supply_gap_score', 0)} AS supply_gap_score, gap_severity
        FROM mart WHERE gap_severity IN ('CRITICAL', 'HIGH')
        ORDER BY mart.overall_gap_rank LIMIT 25""",
    "mart",
)
oracle(
    "report_rider_split",
    f"""SELECT station_name, hour_of_day, total_departures, member_departures, casual_departures,
               {_pct('CAST(member_departures AS DOUBLE) / total_departures')} AS member_pct,
               {_pct('CAST(casual_departures AS DOUBLE) / total_departures')} AS casual_pct,
               supply_gap_score
        FROM mart WHERE overall_gap_rank <= 20""",
    "mart",
)
for _k in (10, 5):
    oracle(
        f"report_peak_top{_k}",
        f"""SELECT station_name, hour_of_day, total_departures,
                   {_pct('avg_availability_ratio')} AS pct_bikes_available,
                   supply_gap_score, gap_severity
            FROM mart WHERE is_peak_gap_hour ORDER BY overall_gap_rank LIMIT {_k}""",
        "mart",
    )
oracle(
    "report_top_rows",
    f"""SELECT station_name, hour_of_day, total_departures, {r('avg_bikes_available', 1)} AS avg_bikes,
               {r('avg_availability_ratio', 3)} AS avail_ratio, supply_gap_score, gap_severity
        FROM mart ORDER BY overall_gap_rank LIMIT 10""",
    "mart",
)


# Quality
def _check(check: str, column: str, failing: str, source: str) -> str:
    return f"""SELECT '{check}' AS "check", '{column}' AS "column", failing_rows, failing_rows = 0 AS passed
               FROM (SELECT CAST({failing} AS BIGINT) AS failing_rows FROM {source})"""


def _repeats(column: str, source: str) -> str:
    repeated = f"(SELECT {column} FROM {source} GROUP BY {column} HAVING count({column}) > 1)"
    return _check("unique", column, "count(*)", repeated)


oracle(
    "dq_not_null",
    "\nUNION ALL ".join(
        _check("not_null", c, f"count_if({c} IS NULL)", "trips_raw")
        for c in ("ride_id", "start_station_id", "end_station_id", "started_at")
    ),
    "trips_raw",
)
oracle("dq_unique", _repeats("ride_id", "clean"), "clean")
oracle(
    "dq_accepted_values",
    _check(
        "accepted_values", "member_casual", "count_if(member_casual NOT IN ('member', 'casual'))", "clean"
    )
    + "\nUNION ALL "
    + _check("accepted_values", "rideable_type", "count_if(rideable_type <> 'classic_bike')", "clean"),
    "clean",
)
oracle(
    "dq_freshness",
    """SELECT 'freshness' AS "check", 'snapshot_at' AS "column", latest,
              (epoch(as_of) - floor(epoch(latest))) / 3600 AS age_hours,
              CASE WHEN (epoch(as_of) - floor(epoch(latest))) / 3600 > 49 THEN 'error'
                   WHEN (epoch(as_of) - floor(epoch(latest))) / 3600 > 25 THEN 'warn'
                   ELSE 'pass' END AS status
       FROM (SELECT max(ts) AS latest FROM events),
            (VALUES (TIMESTAMP '2024-01-31 06:00:00'), (TIMESTAMP '2024-02-01 06:00:00'),
                    (TIMESTAMP '2024-02-03 00:00:00')) t(as_of)""",
)
oracle(
    "dq_mart",
    "\nUNION ALL ".join(
        [
            _check("not_null", c, f"count_if({c} IS NULL)", "mart")
            for c in (
                "station_id",
                "station_name",
                "hour_of_day",
                "supply_gap_score",
                "overall_gap_rank",
            )
        ]
        + [
            _check(
                "accepted_values", "hour_of_day", "count_if(hour_of_day NOT BETWEEN 0 AND 23)", "mart"
            ),
            _check(
                "accepted_values",
                "gap_severity",
                "count_if(gap_severity NOT IN ('CRITICAL', 'HIGH', 'MEDIUM', 'LOW'))",
                "mart",
            ),
            _repeats("overall_gap_rank", "mart"),
        ]
    ),
    "mart",
)

# Streams
_SOURCE_CHECKS = [
    ("trips", "not_null", "ride_id", "count_if(ride_id IS NULL)", "clean"),
    ("trips", "not_null", "started_at_ts", "count_if(started_at_ts IS NULL)", "clean"),
    ("trips", "accepted_values", "member_casual", "count_if(member_casual NOT IN ('member', 'casual'))", "clean"),
    ("snapshots", "not_null", "station_id", "count_if(station_id IS NULL)", "snapshots"),
    ("snapshots", "not_null", "snapshot_at", "count_if(snapshot_at IS NULL)", "snapshots"),
    ("stations", "not_null", "station_id", "count_if(station_id IS NULL)", "stations"),
    ("stations", "not_null", "name", "count_if(name IS NULL)", "stations"),
]
oracle(
    "dq_sources",
    "\nUNION ALL ".join(
        [f"SELECT *, '{source}' AS source FROM ({_check(*check)})" for source, *check in _SOURCE_CHECKS]
        + [f"SELECT *, 'stations' AS source FROM ({_repeats('station_id', 'stations')})"]
    ),
    "clean",
    "snapshots",
    "stations",
)
oracle("stream_ingested", f"SELECT {_SNAPSHOT_ROW} FROM snapshots", "snapshots")
oracle(
    "stream_deduped", "SELECT DISTINCT station_id, snapshot_at FROM stg_snapshots", "stg_snapshots"
)
oracle(
    "stream_windowed_availability",
    f"""SELECT * FROM (
            SELECT date_trunc('hour', snapshot_at) AS window_start,
                   date_trunc('hour', snapshot_at) + INTERVAL 1 HOUR AS window_end,
                   station_id, station_name, latitude, longitude, total_capacity, {_MEASURES}
            FROM with_capacity GROUP BY ALL)
        WHERE window_end <= (SELECT max(snapshot_at) - INTERVAL 30 MINUTE FROM stg_snapshots)""",
    "with_capacity",
)
relation(
    "first_readings",
    """
    SELECT * FROM stg_snapshots QUALIFY row_number() OVER (
        PARTITION BY station_id, snapshot_at
        ORDER BY num_bikes_available, num_ebikes_available, num_docks_available, num_bikes_disabled,
                 is_installed, is_renting, is_returning) = 1
    """,
    "stg_snapshots",
)
relation(
    "with_capacity_once",
    _CAPACITY.format(taken="s.snapshot_at, s.snapshot_hour, s.snapshot_date").replace("stg_snapshots", "first_readings"),
    "first_readings",
    "stg_stations",
)
oracle(
    "stream_corrected_availability",
    f"""SELECT date_trunc('hour', snapshot_at) AS window_start,
               date_trunc('hour', snapshot_at) + INTERVAL 1 HOUR AS window_end,
               station_id, station_name, latitude, longitude, total_capacity, {_MEASURES}
        FROM with_capacity_once GROUP BY ALL""",
    "with_capacity_once",
)
