"""The registered queries in DuckDB's SQL, for comparison."""

from __future__ import annotations

LON = "CAST(CAST(-74.1 AS DOUBLE) + (((event_id % 4501) * {step}) % 4501) / CAST(10000 AS DOUBLE) AS FLOAT)"
LAT = "CAST(CAST(40.45 AS DOUBLE) + (((event_id % 6001) * {step}) % 6001) / CAST(10000 AS DOUBLE) AS FLOAT)"

EVENT_RIDES = f"""
  SELECT *, ts AS start_ts, ts + to_minutes(CAST(floor(value) AS BIGINT)) AS end_ts,
         {LON.format(step=2749)} AS start_lon, {LAT.format(step=3571)} AS start_lat,
         {LON.format(step=1013)} AS end_lon, {LAT.format(step=5737)} AS end_lat
  FROM events
"""

RIDES = f"""
rides AS (
  SELECT event_id AS ride_id, is_start, ts AS start_time,
         CASE WHEN is_start THEN TIMESTAMP '1970-01-01 00:00:00' ELSE end_ts END AS end_time,
         start_lon, start_lat, end_lon, end_lat,
         CAST(event_id % 4 + 1 AS SMALLINT) AS passenger_cnt,
         user_id + 2013000000 AS taxi_id, user_id AS driver_id,
         CASE WHEN is_start THEN ts ELSE end_ts END AS event_time
  FROM ({EVENT_RIDES}) e, (VALUES (true), (false)) kinds(is_start)
  WHERE is_start OR event_type <> 'error'
)"""

RIDE_COLUMNS = """ride_id, is_start, start_time, end_time, start_lon, start_lat, end_lon, end_lat,
  passenger_cnt, taxi_id, driver_id"""

CLICKS = """
clicks AS (
  SELECT event_id, date_trunc('millisecond', ts) AS event_time,
         strftime(ts, '%d-%m-%Y %H:%M:%S:%g') AS "timestamp",
         '/' || event_type AS page, user_id AS "userId",
         CAST(floor(value) AS BIGINT) AS duration
  FROM events
)"""

IN_CITY = """CAST({lon} AS DOUBLE) BETWEEN CAST(-74.05 AS DOUBLE) AND CAST(-73.7 AS DOUBLE)
  AND CAST({lat} AS DOUBLE) BETWEEN CAST(40.5 AS DOUBLE) AND CAST(41.0 AS DOUBLE)"""
START_IN_CITY = IN_CITY.format(lon="start_lon", lat="start_lat")
END_IN_CITY = IN_CITY.format(lon="end_lon", lat="end_lat")

GRID_X = """CAST(floor((CAST(74.05 AS DOUBLE) - abs(CAST({lon} AS DOUBLE)))
  / CAST(0.0014 AS DOUBLE)) AS INT)"""
GRID_Y = """CAST(floor((CAST(41.0 AS DOUBLE) - CAST({lat} AS DOUBLE))
  / CAST(0.00125 AS DOUBLE)) AS INT)"""
START_CELL = f"({GRID_X.format(lon='start_lon')} + 250 * {GRID_Y.format(lat='start_lat')})"


def instant(column: str) -> str:
    """ISO text with no, three or six fraction digits."""
    seconds = f"strftime({column}, '%Y-%m-%dT%H:%M:%S')"
    micros = f"(epoch_us({column}) % 1000000)"
    return f"""({seconds} || CASE WHEN {micros} = 0 THEN ''
      WHEN {micros} % 1000 = 0 THEN '.' || lpad(CAST({micros} // 1000 AS VARCHAR), 3, '0')
      ELSE '.' || lpad(CAST({micros} AS VARCHAR), 6, '0') END || 'Z')"""


HOURS = """
SELECT strftime(ts, '%H') AS hour, count(*) AS trips FROM events GROUP BY 1
"""

DISTANCE_BY_SEGMENT = """
SELECT c_mktsegment, count(*) AS total_trips, min(o_totalprice) AS min_distance,
       round(avg(o_totalprice), 2) AS mean_distance, max(o_totalprice) AS max_distance
FROM orders {kind} JOIN customer ON o_custkey = c_custkey
GROUP BY c_mktsegment
"""

LONG_NAMES = """
SELECT p_type, p_name, length(p_name) AS name_length FROM part
WHERE p_type = 'LARGE' AND p_type IS NOT NULL AND length(p_name) > 9
"""

RANKED = """
SELECT c_custkey AS employee, c_mktsegment AS department,
       CAST(floor(c_acctbal / 1000) AS BIGINT) AS salary,
       CAST({kind}() OVER (PARTITION BY c_mktsegment
            ORDER BY CAST(floor(c_acctbal / 1000) AS BIGINT) DESC) AS BIGINT) AS rank
FROM customer
"""

ZONE_COUNTS = """
SELECT {segment} AS "Borough", count(*) AS count FROM customer
WHERE c_acctbal >= 0 GROUP BY c_mktsegment
"""

CLICK_TIMES = """
SELECT strftime(ts, '%H:%M:%S:%g') AS time, '/' || event_type AS page FROM events
"""

AVERAGES = f"""
WITH {CLICKS}
SELECT page, sum(duration) / count(*) AS average_duration FROM clicks GROUP BY page
"""

PAGE_COUNTS = f"""
WITH {CLICKS}
SELECT time_bucket(INTERVAL '15 seconds', event_time) AS "windowStart",
       time_bucket(INTERVAL '15 seconds', event_time) + INTERVAL '15 seconds' AS "windowEnd",
       page, count(*) AS count
FROM clicks GROUP BY ALL
"""

LATEST = f"""
WITH {CLICKS}
SELECT {{columns}} FROM clicks
QUALIFY row_number() OVER (PARTITION BY "userId" ORDER BY event_time DESC, event_id DESC) = 1
"""

PAGE_CHANGES = f"""
WITH {CLICKS}
SELECT event_id, "userId", page, event_time FROM clicks
WINDOW w AS (PARTITION BY "userId" ORDER BY event_time, event_id)
QUALIFY row_number() OVER w = 1 OR page IS DISTINCT FROM lag(page) OVER w
"""

RIDES_IN_CITY = f"""
WITH {RIDES}
SELECT {RIDE_COLUMNS} FROM rides WHERE {START_IN_CITY} AND {END_IN_CITY}
"""

HOURLY_FARES = """
SELECT time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
       user_id AS driver_id,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total_fare
FROM events GROUP BY ALL
"""

PAIRS = f"""
WITH {RIDES},
paired AS (
  SELECT rides.*, value, event_type,
         CAST(time_bucket(INTERVAL '2 milliseconds', ts) AS TIMESTAMP)
           + INTERVAL '2 milliseconds' AS window_end
  FROM rides JOIN events ON ride_id = event_id
  WHERE is_start
)
SELECT ride_id, window_end,
       concat_ws(',', ride_id, 'START', {instant('start_time')}, {instant('end_time')},
         start_lon, start_lat, end_lon, end_lat, passenger_cnt, taxi_id, driver_id,
         ride_id, taxi_id, driver_id, {instant('start_time')},
         CASE WHEN ride_id % 2 = 0 THEN 'CARD' ELSE 'CASH' END,
         CAST(floor(value / 10) AS FLOAT),
         CAST(CASE WHEN ride_id % 10 = 0 THEN 2.5 ELSE 0 END AS FLOAT),
         CAST(value AS FLOAT)) AS pair
FROM paired
"""

LONG_RIDES = f"""
WITH {RIDES}
SELECT {RIDE_COLUMNS} FROM rides s
WHERE is_start
  AND start_time + INTERVAL '2 hours' <= (SELECT max(event_time) FROM rides)
  AND NOT EXISTS (
    SELECT 1 FROM rides e
    WHERE e.ride_id = s.ride_id AND NOT e.is_start
      AND e.end_time <= s.start_time + INTERVAL '2 hours')
"""

EVENT_LOG = f"""
WITH {RIDES}
SELECT row_number() OVER (ORDER BY event_time, CASE WHEN is_start THEN 0 ELSE 1 END, ride_id)
         AS position, event_time, is_start, ride_id
FROM rides
"""

HEATMAP = f"""
SELECT {START_CELL} AS cell, count(*) AS pickups
FROM ({EVENT_RIDES}) e WHERE {START_IN_CITY} GROUP BY 1
"""

CELL_CENTRES = f"""
SELECT cell,
  round(-CAST(CAST(CAST(74.05 AS DOUBLE) - (cell % 250) * CAST(0.0014 AS DOUBLE)
    - CAST(0.0007 AS DOUBLE) AS FLOAT) AS DOUBLE), 4) AS centre_lon,
  round(CAST(CAST(CAST(41.0 AS DOUBLE) - (cell // 250) * CAST(0.00125 AS DOUBLE)
    - CAST(0.000625 AS DOUBLE) AS FLOAT) AS DOUBLE), 4) AS centre_lat
FROM (SELECT DISTINCT {START_CELL} AS cell FROM ({EVENT_RIDES}) e WHERE {START_IN_CITY})
"""

# The line runs over columns i from west to east; in each it covers the rows
# between where it enters and where it leaves, corners within 0.05 cells.
ROUTE_CELLS = f"""
WITH ends AS (
  SELECT {GRID_X.format(lon='start_lon')} AS xa, {GRID_Y.format(lat='start_lat')} AS ya,
         {GRID_X.format(lon='end_lon')} AS xb, {GRID_Y.format(lat='end_lat')} AS yb
  FROM ({EVENT_RIDES}) e WHERE {START_IN_CITY} AND {END_IN_CITY}
),
lines AS (
  SELECT least(xa, xb) AS x, CASE WHEN xa <= xb THEN ya ELSE yb END AS y,
         abs(xb - xa) AS run, abs(yb - ya) AS rise,
         CASE WHEN (CASE WHEN xa <= xb THEN yb - ya ELSE ya - yb END) < 0 THEN -1 ELSE 1 END
           AS turn
  FROM ends
),
columns_ AS (SELECT *, unnest(generate_series(0, run)) AS i FROM lines),
heights AS (
  SELECT *,
    (i + CAST(0.5 AS DOUBLE)) * (rise / (run + CAST(1e-8 AS DOUBLE))) - CAST(0.5 AS DOUBLE)
      AS here,
    (i - 1 + CAST(0.5 AS DOUBLE)) * (rise / (run + CAST(1e-8 AS DOUBLE))) - CAST(0.5 AS DOUBLE)
      AS before
  FROM columns_
),
spans AS (
  SELECT *, CASE WHEN i > 0
      THEN greatest(0, CAST(ceil(before + CAST(0.05 AS DOUBLE)) AS INT)) ELSE 0 END AS lowest,
    CASE WHEN i < run
      THEN CAST(floor(here - CAST(0.05 AS DOUBLE)) AS INT) + 1 ELSE rise END AS highest
  FROM heights
),
steps AS (SELECT *, unnest(generate_series(lowest, greatest(lowest, highest))) AS k FROM spans)
SELECT CAST(x + i + (y + turn * k) * 250 AS INT) AS cell, count(*) AS rides
FROM steps GROUP BY 1
"""

LENGTHS = f"""
SELECT count(*) AS count, round(avg(d), 4) AS mean, round(stddev_samp(d), 4) AS stddev,
       round(min(d), 4) AS min, round(max(d), 4) AS max
FROM (
  SELECT CAST(110.25 AS DOUBLE) * sqrt(
      power(CAST(start_lat - end_lat AS DOUBLE), 2)
      + power(CAST(start_lon - end_lon AS DOUBLE) * cos({{angle}}), 2)) AS d
  FROM ({EVENT_RIDES}) e)
"""

DIRECTIONS = f"""
SELECT CAST(floor(degree / CAST(30 AS DOUBLE)) * 30 AS INT) AS direction, count(*) AS rides
FROM (
  SELECT CAST(trunc(degrees(atan2(
      CAST(end_lat - start_lat AS DOUBLE),
      CAST(end_lon - start_lon AS DOUBLE) * cos({{angle}})))) AS INT)
    + 179 AS degree
  FROM ({EVENT_RIDES}) e)
GROUP BY 1
"""

NEAREST = f"""
WITH {RIDES},
places AS (
  SELECT ride_id, is_start, CASE WHEN is_start THEN start_lon ELSE end_lon END AS lon,
         CASE WHEN is_start THEN start_lat ELSE end_lat END AS lat
  FROM rides
)
SELECT ride_id, is_start, round(CAST(110.25 AS DOUBLE) * sqrt(
    power(CAST(CAST(40.7484 AS FLOAT) - lat AS DOUBLE), 2)
    + power(CAST(CAST(-73.9857 AS FLOAT) - lon AS DOUBLE)
            * cos(radians(CAST(lat AS DOUBLE))), 2)), 6) AS distance
FROM places ORDER BY distance, ride_id, is_start LIMIT 10
"""

NEAREST_HOMES = f"""
WITH {RIDES},
homes AS (
  SELECT c_custkey, CAST(-74.1 + (c_custkey * 1777 % 4501) / CAST(10000 AS DOUBLE) AS FLOAT) AS home_lon,
         CAST(40.45 + (c_custkey * 2311 % 6001) / CAST(10000 AS DOUBLE) AS FLOAT) AS home_lat
  FROM customer
),
met AS (
  SELECT c_custkey, ride_id, round(CAST(110.25 AS DOUBLE) * sqrt(
      power(CAST(home_lat - start_lat AS DOUBLE), 2)
      + power(CAST(home_lon - start_lon AS DOUBLE) * cos(radians(CAST(start_lat AS DOUBLE))), 2)), 6) AS distance
  FROM homes, rides WHERE is_start
),
ranked AS (
  SELECT c_custkey, ride_id, distance,
         CAST(row_number() OVER (PARTITION BY c_custkey ORDER BY distance, ride_id) AS INT) AS rank
  FROM met
)
SELECT * FROM ranked WHERE rank <= 3
"""

SPEND = """
SELECT CAST(o_custkey AS VARCHAR) AS metric,
       CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS value
FROM orders GROUP BY o_custkey
"""

POPULARITY = """
SELECT c_mktsegment, count(*) AS total_trips
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
"""

SECOND = f"""
SELECT employee, department, salary FROM ({RANKED.format(kind="dense_rank")}) WHERE rank = 2
"""

ORACLE: dict[str, str] = {
    "borough_popularity": POPULARITY,
    "borough_popularity_large_zones": POPULARITY,
    "distance_by_borough_large_zones": DISTANCE_BY_SEGMENT.format(kind="LEFT"),
    "distance_by_borough": DISTANCE_BY_SEGMENT.format(kind="INNER"),
    "distance_by_borough_left": """
        SELECT quality, count(*) AS total_trips, min(n_chars) AS min_distance,
               round(avg(n_chars), 2) AS mean_distance, max(n_chars) AS max_distance
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        WHERE d.doc_id <> 0 GROUP BY quality
    """,
    "distance_by_borough_sql": DISTANCE_BY_SEGMENT.format(kind="LEFT").replace(
        "SELECT c_mktsegment,", 'SELECT c_mktsegment AS "Borough",'
    ),
    "distance_global": """
        SELECT count(*) AS count, round(avg(o_totalprice), 4) AS mean,
               round(stddev_samp(o_totalprice), 4) AS stddev,
               min(o_totalprice) AS min, max(o_totalprice) AS max
        FROM orders
    """,
    "trips_per_hour": HOURS,
    "trips_per_hour_from_text": HOURS,
    "trips_per_hour_text": f"SELECT hour || ' ' || trips AS value FROM ({HOURS})",
    "trips_per_hour_text_file": f"SELECT hour || ' ' || trips AS value FROM ({HOURS})",
    "borough_popularity_file": POPULARITY,
    "busiest_hour_top1": f"SELECT * FROM ({HOURS}) ORDER BY trips DESC, hour LIMIT 1",
    "top_n": """
        SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 3
    """,
    "zones_uppercase_only": """
        SELECT p_brand, count(*) AS count
        FROM (SELECT p_brand, CASE WHEN p_size < 8 THEN lower(p_type) ELSE p_type END AS service
              FROM part)
        WHERE upper(service) = service GROUP BY p_brand
    """,
    "amount_over_threshold": """
        SELECT o_custkey, o_totalprice FROM orders WHERE o_totalprice > 100000
    """,
    "cache_reuse": """
        SELECT o_orderpriority, count(*) AS orders,
               CAST(sum(count(*)) OVER () AS BIGINT) AS all_orders
        FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderpriority
    """,
    "strlen_filter": LONG_NAMES,
    "strlen_filter_udf": LONG_NAMES,
    "dense_rank_salary": RANKED.format(kind="dense_rank"),
    "dense_rank_salary_sql": RANKED.format(kind="dense_rank").replace(
        "AS employee,", "AS employee_name,"
    ),
    "dense_rank_salary_sliced": """
        SELECT c_custkey, c_mktsegment, c_acctbal,
               dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS rank
        FROM customer
    """,
    "rank_salary": RANKED.format(kind="rank"),
    "rank_salary_sliced": RANKED.format(kind="rank"),
    "second_highest": SECOND,
    "second_highest_sliced": SECOND,
    "join_using": """
        SELECT l_orderkey AS order_key, l_linenumber, l_extendedprice, o_custkey, o_totalprice
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
    "employee_titles": """
        SELECT s_name AS last_name, n_name AS title
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
    """,
    "zone_counts_text_scan": ZONE_COUNTS.format(segment="""'"' || c_mktsegment || '"'"""),
    "csv_string_schema": ZONE_COUNTS.format(segment="c_mktsegment"),
    "csv_inferred_schema": """
        SELECT CAST(c_custkey AS INT) AS "LocationID", c_mktsegment AS "Borough",
               c_name AS "Zone",
               CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment) ELSE c_mktsegment END
                 AS service_zone
        FROM customer
    """,
    "csv_typed_schema": """
        SELECT CAST(c_custkey AS INT) AS "LocationID", c_mktsegment AS "Borough",
               c_name AS "Zone",
               CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment) ELSE c_mktsegment END
                 AS service_zone
        FROM customer
    """,
    "clicks_decoded": CLICK_TIMES,
    "clicks_decoded_stream": CLICK_TIMES,
    "clicks_decoded_strict": f"""
        WITH {CLICKS}
        SELECT event_id, "timestamp", page, "userId", duration, event_time FROM clicks
    """,
    "clicks_readable": f"""
        WITH {CLICKS}
        SELECT "timestamp", page, "userId", duration FROM clicks WHERE page <> '/error'
    """,
    "clicks_dead_letters": f"""
        WITH {CLICKS}
        SELECT '{{"timestamp":"' || "timestamp" || '","page":"' || page || '","userId":'
               || "userId" || ',"duration":' || duration AS value
        FROM clicks WHERE page = '/error'
    """,
    "clicks_nested_json": """
        SELECT CAST(user_id AS VARCHAR) AS name,
               CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS INT) END
                 AS device_id,
               CASE WHEN event_type <> 'error' THEN event_type END AS model
        FROM events
    """,
    "clicks_json_out": f"""
        WITH {CLICKS}
        SELECT '{{"timestamp":"' || strftime(event_time, '%d-%m-%Y %I:%M:%S:%g')
               || '","page":"' || page || '","userId":' || "userId"
               || ',"duration":' || duration || '}}' AS value
        FROM clicks
    """,
    "stats_json_out": f"""
        SELECT '{{"windowStart":"' || strftime("windowStart", '%d-%m-%Y %I:%M:%S:%g')
               || '","windowEnd":"' || strftime("windowEnd", '%d-%m-%Y %I:%M:%S:%g')
               || '","page":"' || page || '","count":' || count || '}}' AS value
        FROM ({PAGE_COUNTS})
    """,
    "avg_duration_per_page": AVERAGES,
    "avg_duration_per_page_stream": AVERAGES,
    "avg_duration_per_page_stateful": AVERAGES,
    "page_count_15s": PAGE_COUNTS,
    "page_count_15s_stream": PAGE_COUNTS,
    "latest_click_per_user": LATEST.format(
        columns='event_id, "timestamp", page, "userId", duration, event_time'
    ),
    "latest_click_upsert": LATEST.format(columns='"userId", page, duration, "timestamp"'),
    "narrow_click_upsert": f"""
        WITH {CLICKS} SELECT DISTINCT event_time AS "timestamp", page FROM clicks
    """,
    "consecutive_dedup": PAGE_CHANGES,
    "consecutive_dedup_sliced": PAGE_CHANGES,
    "map_to_record": """
        SELECT c_custkey, c_name AS name,
               CASE WHEN c_acctbal >= 0 THEN c_mktsegment ELSE '' END AS surname
        FROM customer
    """,
    "rides_in_city": RIDES_IN_CITY,
    "rides_in_city_stream": RIDES_IN_CITY,
    "hourly_fare_per_driver": HOURLY_FARES,
    "hourly_fare_per_driver_stream": HOURLY_FARES,
    "rides_join_fares": PAIRS,
    "rides_join_fares_stream": PAIRS,
    "long_rides": LONG_RIDES,
    "long_rides_stream": LONG_RIDES,
    "long_rides_stateful": LONG_RIDES,
    "long_rides_repeated_stream": LONG_RIDES,
    "event_log_order": EVENT_LOG,
    "event_log_order_sliced": EVENT_LOG,
    "pickup_heatmap": HEATMAP,
    "busiest_pickup_cells": f"SELECT * FROM ({HEATMAP}) ORDER BY pickups DESC, cell LIMIT 10",
    "cell_centres": CELL_CENTRES,
    "route_cells": ROUTE_CELLS,
    "trip_length_km": LENGTHS.format(angle="radians(CAST(end_lat AS DOUBLE))"),
    "trip_length_km_compat": LENGTHS.format(angle="CAST(end_lat AS DOUBLE)"),
    "nearest_to_point": NEAREST,
    "nearest_per_customer": NEAREST_HOMES,
    "direction_histogram": DIRECTIONS.format(angle="radians(CAST(start_lat AS DOUBLE))"),
    "direction_histogram_compat": DIRECTIONS.format(angle="CAST(start_lon AS DOUBLE)"),
    "spend_by_account": SPEND,
    "spend_by_account_incremental": SPEND,
    "popularity_table": POPULARITY,
    "cached_priorities": """
        SELECT o_orderpriority AS kind, count(*) AS orders FROM orders
        WHERE o_totalprice > 100000 GROUP BY 1
        UNION ALL SELECT o_orderstatus, count(*) FROM orders WHERE o_totalprice > 100000 GROUP BY 1
    """,
    "typed_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey,
               CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS o_totalprice FROM orders
    """,
    "late_clicks_stream": f"""
        WITH {CLICKS},
        span AS (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events),
        placed AS (
          SELECT c.event_id, c.event_time,
                 least(2, (epoch_us(ts) - low) * 3 // (high - low + 1)
                   + CASE WHEN c.event_id % 10 = 0 THEN 1 ELSE 0 END) AS batch_id
          FROM clicks c JOIN events USING (event_id), span),
        marks AS (
          SELECT b.batch_id, max(a.event_time) AS mark
          FROM (SELECT DISTINCT batch_id FROM placed) b JOIN placed a ON a.batch_id < b.batch_id
          GROUP BY b.batch_id)
        SELECT event_id, CAST(batch_id AS BIGINT) AS batch_id,
               coalesce(event_time <= mark - INTERVAL '200 milliseconds', false) AS late
        FROM placed LEFT JOIN marks USING (batch_id)
    """,
    "mean_spend": f"SELECT avg(value) AS mean_value FROM ({SPEND})",
    "spend_report_upsert": """
        SELECT o_custkey AS account_id, o_orderdate AS log_ts,
               CAST(floor(o_totalprice) AS BIGINT) AS amount
        FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate
                                   ORDER BY o_orderkey DESC) = 1
    """,
}
