"""The same results stated in plain SQL on the given tables."""

from __future__ import annotations

from itertools import combinations

TRIPS = """
trips AS (
  SELECT printf('T%07d', event_id) AS trip_id,
         'N' || CAST(user_id % 30 + 1 AS VARCHAR) AS service_code,
         'OP' || CAST(event_id % 5 AS VARCHAR) AS operator,
         printf('STOP_%04d', user_id % 200 + 1) AS origin_stop,
         printf('STOP_%04d', event_id % 200 + 1) AS destination_stop,
         CAST(date_trunc('minute', ts) AS TIMESTAMP) AS scheduled_depart,
         CAST(date_trunc('minute', ts) AS TIMESTAMP)
           + to_microseconds(CAST(round((value - 40) * 6e7) AS BIGINT)) AS actual_depart,
         CAST(20 + event_id % 70 AS INTEGER) AS scheduled_duration_min,
         CAST(18 + (event_id * 7) % 92 AS INTEGER) AS actual_duration_min,
         CASE event_type WHEN 'view' THEN 'Clear' WHEN 'click' THEN 'Rain' WHEN 'purchase' THEN 'Fog'
                         WHEN 'signup' THEN 'Snow' WHEN 'error' THEN 'Windy' END AS weather,
         dayname(ts) AS day_of_week,
         CAST(hour(ts) AS INTEGER) AS hour_of_night,
         CAST(1 + user_id % 14 AS INTEGER) AS vehicle_age_years,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS passenger_count,
         75 AS capacity,
         CAST(1 + event_id % 29 AS INTEGER) AS driver_experience_yrs,
         value - 40 AS delay_minutes,
         CASE WHEN abs(value - 40) > {tolerance} THEN 1 ELSE 0 END AS is_delayed,
         CASE WHEN abs(value - 40) > {tolerance} THEN 0 ELSE 1 END AS service_reliability_flag,
         greatest(0.0::DOUBLE, least(1.0::DOUBLE,
           CAST(json_extract_string(props, '$.k') AS INTEGER) / 75.0::DOUBLE)) AS load_factor
  FROM events
)"""

NARROW = TRIPS.format(tolerance=2)
WIDE = TRIPS.format(tolerance=15)

DISRUPTIONS = """
disruptions AS (
  SELECT printf('D%06d', o_orderkey) AS disruption_id,
         'N' || CAST(o_custkey % 24 + 1 AS VARCHAR) AS service_code,
         'OP' || CAST(o_orderkey % 5 AS VARCHAR) AS operator,
         o_orderpriority AS disruption_type,
         o_orderdate AS start_time,
         CAST(5 + o_orderkey % 175 AS INTEGER) AS duration_min,
         CASE o_orderstatus WHEN 'F' THEN 'Low' WHEN 'O' THEN 'Medium' WHEN 'P' THEN 'High' END
           AS severity,
         CAST(1 + o_custkey % 19 AS INTEGER) AS affected_stops,
         o_orderkey % 20 < 17 AS resolved
  FROM orders
)"""

PINGS = """
pings AS (
  SELECT printf('L%d-%d', l_orderkey, l_linenumber) AS location_id,
         printf('T%07d', l_orderkey) AS trip_id,
         l_shipdate AS "timestamp",
         51.3::DOUBLE + l_discount * 4 AS latitude,
         -0.5::DOUBLE + l_tax * 8 AS longitude,
         l_quantity * 1.2::DOUBLE AS speed_kmh,
         CAST((l_partkey * 7) % 360 AS DOUBLE) AS heading_deg,
         CASE l_returnflag WHEN 'A' THEN 'Good' WHEN 'N' THEN 'Fair' WHEN 'R' THEN 'Poor' END
           AS signal_quality
  FROM lineitem
)"""

ROUTES = """
durations AS (
  SELECT service_code, avg(actual_duration_min) AS mean_dur,
         stddev_samp(actual_duration_min) AS std_dur, count(*) AS trip_count,
         sum(service_reliability_flag) / count(*) AS pct_on_time,
         stddev_samp(actual_duration_min) / avg(actual_duration_min) AS cv_travel_time
  FROM trips GROUP BY service_code
), counts AS (
  SELECT service_code, count(*) AS disruption_count,
         count(*) FILTER (WHERE severity = 'High') AS high_severity_count
  FROM disruptions GROUP BY service_code
), routes AS (
  SELECT d.*, coalesce(c.disruption_count, 0) AS disruption_count,
         coalesce(c.high_severity_count, 0) AS high_severity_count
  FROM durations d LEFT JOIN counts c USING (service_code)
)"""

WEATHER_CODE = """CAST(CASE weather WHEN 'Clear' THEN 0 WHEN 'Rain' THEN 1 WHEN 'Fog' THEN 2
         WHEN 'Snow' THEN 3 WHEN 'Windy' THEN 4 END AS INTEGER)"""

HEADWAY = """date_diff('second', lag(scheduled_depart) OVER (
           PARTITION BY service_code ORDER BY scheduled_depart, trip_id), scheduled_depart) / 60.0"""

CLEAN = f"""
clean AS (
  SELECT t.*, least(greatest(delay_minutes, -30), 60) AS delay_minutes_clipped,
         {WEATHER_CODE} AS weather_code,
         r.disruption_count, r.high_severity_count, r.mean_dur, r.std_dur, r.cv_travel_time,
         r.pct_on_time, t.headway AS headway_min
  FROM (SELECT *, {HEADWAY} AS headway FROM trips) t LEFT JOIN routes r USING (service_code)
)"""

SCORED = """
scored AS (
  SELECT printf('T%07d', event_id) AS trip_id,
         CASE WHEN abs(value - 40) > 15 THEN 1 ELSE 0 END AS is_delayed,
         ((event_id * 37) % 1000) / 1000.0 AS score,
         CASE WHEN ((event_id * 37) % 1000) >= 500 THEN 1 ELSE 0 END AS prediction
  FROM events
), cells AS (
  SELECT count(*) FILTER (WHERE is_delayed = 0 AND prediction = 0) AS tn,
         count(*) FILTER (WHERE is_delayed = 0 AND prediction = 1) AS fp,
         count(*) FILTER (WHERE is_delayed = 1 AND prediction = 0) AS fn,
         count(*) FILTER (WHERE is_delayed = 1 AND prediction = 1) AS tp
  FROM scored
)"""

BINS = """
clamped AS (SELECT least(greatest(delay_minutes, -15), 30) AS x FROM {source}),
ends AS (SELECT min(x) AS low, max(x) AS high, (max(x) - min(x)) / {bins} AS width FROM clamped),
spine AS (SELECT CAST(i AS INTEGER) AS bin, low + i * width AS lower,
                 CASE WHEN i + 1 = {bins} THEN high ELSE low + (i + 1) * width END AS upper
          FROM range({bins}) r(i), ends)"""

BIN_COUNTS = """
SELECT bin, round(lower, 6) AS lower, round(upper, 6) AS upper,
       (SELECT count(*) FROM clamped
        WHERE x >= lower AND (x < upper OR (bin = {bins} - 1 AND x = upper))) AS n
FROM spine"""

CLEAN_COLUMNS = """trip_id, service_code, operator, scheduled_depart, actual_depart,
       round(delay_minutes, 6) AS delay_minutes,
       round(delay_minutes_clipped, 6) AS delay_minutes_clipped, is_delayed, weather, weather_code,
       scheduled_duration_min, actual_duration_min, passenger_count, capacity,
       round(load_factor, 6) AS load_factor, vehicle_age_years, driver_experience_yrs,
       hour_of_night, day_of_week, disruption_count, high_severity_count,
       round(mean_dur, 6) AS mean_dur, round(std_dur, 6) AS std_dur,
       round(cv_travel_time, 6) AS cv_travel_time, round(pct_on_time, 6) AS pct_on_time,
       round(headway_min, 6) AS headway_min"""

FEATURE_COLUMNS = """round({0}weather_code{1}, 6) AS weather_code,
       round({0}hour_of_night{1}, 6) AS hour_of_night, round({0}load_factor{1}, 6) AS load_factor,
       round({0}vehicle_age_years{1}, 6) AS vehicle_age_years,
       round({0}driver_experience_yrs{1}, 6) AS driver_experience_yrs,
       round({0}scheduled_duration_min{1}, 6) AS scheduled_duration_min,
       round({0}disruption_count{1}, 6) AS disruption_count,
       round({0}high_severity_count{1}, 6) AS high_severity_count,
       round({0}cv_travel_time{1}, 6) AS cv_travel_time, round({0}pct_on_time{1}, 6) AS pct_on_time,
       round({0}passenger_count{1}, 6) AS passenger_count, {0}is_delayed{1} AS is_delayed"""

REGULARITY = """
planned AS (
  SELECT service_code, avg(gap) AS scheduled_headway FROM (
    SELECT service_code, date_diff('second', lag(scheduled_depart) OVER (
      PARTITION BY service_code ORDER BY scheduled_depart, trip_id), scheduled_depart) / 60.0 AS gap
    FROM trips) GROUP BY service_code
), observed AS (
  SELECT service_code, stddev_samp(gap) AS headway_sd FROM (
    SELECT service_code, date_diff('second', lag(actual_depart) OVER (
      PARTITION BY service_code ORDER BY actual_depart, trip_id), actual_depart) / 60.0 AS gap
    FROM trips) GROUP BY service_code
), regularity AS (
  SELECT service_code, scheduled_headway, headway_sd,
         headway_sd / scheduled_headway AS headway_ratio
  FROM planned LEFT JOIN observed USING (service_code)
)"""

CORRELATED = [
    "delay_minutes", "load_factor", "vehicle_age_years", "driver_experience_yrs",
    "disruption_count", "weather_code", "hour_of_night", "scheduled_duration_min",
    "passenger_count",
]


def _with(*parts: str) -> str:
    """Common table expressions, then the query."""
    return "WITH " + ",".join(parts[:-1]) + "\n" + parts[-1].strip()


def _correlations() -> str:
    pairs = [(a, b) for i, a in enumerate(CORRELATED) for b in CORRELATED[i + 1:]]
    return "\nUNION ALL ".join(
        f"SELECT '{b}' AS row_name, '{a}' AS column_name, round(corr({a}, {b}), 6) AS correlation"
        " FROM clean" for a, b in pairs
    )


def _histogram(source: str, bins: int) -> tuple[str, str]:
    return BINS.format(source=source, bins=bins), BIN_COUNTS.format(bins=bins)


def _pivot(condition: str) -> str:
    hours = ", ".join(
        f"round(avg(is_delayed) FILTER (WHERE hour_of_night = {h}), 6) AS h{h}" for h in range(24)
    )
    return f"SELECT service_code, {hours} FROM trips WHERE {condition} GROUP BY service_code"


def _rule(rule: str, table: str, violation: str) -> str:
    return (f"SELECT '{rule}' AS rule, count(*) AS checked, "
            f"count(*) FILTER (WHERE {violation}) AS violations FROM {table}")


def _unique(rule: str, table: str, key: str) -> str:
    return (f"SELECT '{rule}' AS rule, CAST(sum(n) AS BIGINT) AS checked, "
            "count(*) FILTER (WHERE n > 1) AS violations FROM "
            f"(SELECT {key}, count(*) AS n FROM {table} GROUP BY {key})")


def _f1(threshold: int) -> str:
    return f"""SELECT 'from {threshold / 1000}' AS model,
  2.0 * tp / (2.0 * tp + fp + fn) AS f1 FROM (
  SELECT count(*) FILTER (WHERE is_delayed = 1 AND score * 1000 >= {threshold}) AS tp,
         count(*) FILTER (WHERE is_delayed = 0 AND score * 1000 >= {threshold}) AS fp,
         count(*) FILTER (WHERE is_delayed = 1 AND score * 1000 < {threshold}) AS fn FROM scored)"""


def _profile(condition: str) -> str:
    return f"""SELECT operator, round((1 - avg(is_delayed)) * 100, 6) AS pct_on_time,
       round(avg(delay_minutes), 6) AS avg_delay, count(trip_id) AS trips,
       CASE WHEN (1 - avg(is_delayed)) * 100 < 85 THEN 'breach' ELSE 'ok' END AS state
FROM trips WHERE {condition} GROUP BY operator"""


FIRST_ROUTES = """service_code IN (SELECT DISTINCT service_code FROM trips
                        ORDER BY service_code LIMIT 5)"""

STORED = (NARROW, DISRUPTIONS, ROUTES, CLEAN)

SQL: dict[str, str] = {
    "trips_cleaned": _with(NARROW, """
SELECT trip_id, service_code, round(delay_minutes, 6) AS delay_minutes,
       round(least(greatest(delay_minutes, -30), 60), 6) AS delay_minutes_clipped,
       is_delayed, round(load_factor, 6) AS load_factor
FROM trips WHERE weather <> 'Windy'"""),
    "delay_columns": _with(NARROW, """
SELECT trip_id, round(minutes, 6) AS delay_minutes,
       CASE WHEN abs(minutes) > 2 THEN 1 ELSE 0 END AS is_delayed,
       CASE WHEN abs(minutes) > 2 THEN 0 ELSE 1 END AS service_reliability_flag,
       round(load_factor, 6) AS load_factor
FROM (SELECT *, date_diff('microsecond', scheduled_depart, actual_depart) / 6e7 AS minutes FROM trips)
"""),
    "delay_clamped": _with(NARROW, """
SELECT trip_id, round(least(greatest(delay_minutes, -30), 60), 6) AS stored,
       round(least(greatest(delay_minutes, -15), 30), 6) AS plotted FROM trips"""),
    "weather_encoded": _with(NARROW, """
SELECT trip_id, CASE weather WHEN 'Fog' THEN 'Hail' ELSE weather END AS weather,
       CAST(CASE weather WHEN 'Clear' THEN 0 WHEN 'Rain' THEN 1 WHEN 'Snow' THEN 3
                         WHEN 'Windy' THEN 4 END AS INTEGER) AS weather_code
FROM trips"""),
    "weather_decoded": _with(NARROW, """
SELECT trip_id, CAST(vehicle_age_years % 7 AS INTEGER) AS code,
       CASE vehicle_age_years % 7 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Rain' WHEN 2 THEN 'Fog'
            WHEN 3 THEN 'Snow' WHEN 4 THEN 'Windy' END AS weather FROM trips"""),
    "calendar_columns": _with(NARROW, """
SELECT trip_id, CAST(month(scheduled_depart) AS INTEGER) AS month,
       CAST(week(scheduled_depart) AS INTEGER) AS week,
       dayname(scheduled_depart) AS day_of_week,
       CAST(hour(scheduled_depart) AS INTEGER) AS hour_of_night FROM trips"""),
    "night_trips": _with(NARROW, """
SELECT trip_id, scheduled_depart FROM trips
WHERE hour(scheduled_depart) >= 22 OR hour(scheduled_depart) < 6"""),
    "hour_range_wrap": _with(NARROW, """
SELECT trip_id, hour_of_night FROM trips WHERE hour_of_night >= 22 OR hour_of_night <= 5"""),
    "hour_range_plain": _with(NARROW, """
SELECT trip_id, hour_of_night FROM trips WHERE hour_of_night BETWEEN 1 AND 4"""),
    "trips_by_membership": _with(NARROW, """
SELECT trip_id, operator, service_code FROM trips
WHERE operator IN ('OP1', 'OP3') AND service_code IN ('N1', 'N10', 'N11', 'N12', 'N13')"""),
    "lenient_timestamps": _with(NARROW, """
SELECT trip_id, CASE WHEN weather <> 'Windy' THEN scheduled_depart END AS parsed FROM trips"""),
    "target_states": _with(NARROW, """
SELECT trip_id, CASE WHEN load_factor * 100 < 85 THEN 'breach' ELSE 'ok' END AS state FROM trips"""),
    "complete_rows": _with(*STORED, """
SELECT weather_code, hour_of_night, round(load_factor, 6) AS load_factor, vehicle_age_years,
       driver_experience_yrs, scheduled_duration_min, disruption_count, high_severity_count,
       round(cv_travel_time, 6) AS cv_travel_time, round(pct_on_time, 6) AS pct_on_time,
       passenger_count, is_delayed
FROM clean WHERE weather_code IS NOT NULL AND load_factor IS NOT NULL
             AND cv_travel_time IS NOT NULL AND pct_on_time IS NOT NULL"""),
    "headway_minutes": _with(NARROW, f"""
SELECT trip_id, service_code, round({HEADWAY}, 6) AS headway_min FROM trips"""),
    "route_duration_stats": _with(NARROW, """
SELECT service_code, round(avg(actual_duration_min), 6) AS mean_dur,
       round(stddev_samp(actual_duration_min), 6) AS std_dur, count(*) AS trip_count,
       round(stddev_samp(actual_duration_min) / avg(actual_duration_min), 6) AS cv_travel_time
FROM trips GROUP BY service_code"""),
    "route_on_time": _with(NARROW, """
SELECT service_code, round(sum(service_reliability_flag) / count(*), 6) AS pct_on_time
FROM trips GROUP BY service_code"""),
    "route_disruption_counts": _with(DISRUPTIONS, """
SELECT service_code, count(*) AS disruption_count,
       count(*) FILTER (WHERE severity = 'High') AS high_severity_count
FROM disruptions GROUP BY service_code"""),
    "route_features": _with(NARROW, DISRUPTIONS, ROUTES, """
SELECT service_code, round(mean_dur, 6) AS mean_dur, round(std_dur, 6) AS std_dur, trip_count,
       round(pct_on_time, 6) AS pct_on_time, round(cv_travel_time, 6) AS cv_travel_time,
       disruption_count, high_severity_count FROM routes"""),
    "route_features_train_only": _with(WIDE, """
SELECT service_code,
       round(sum(service_reliability_flag) FILTER (WHERE train)
             / nullif(count(*) FILTER (WHERE train), 0), 6) AS pct_on_time
FROM (SELECT *, scheduled_depart < TIMESTAMP '2024-01-24' AS train FROM trips)
GROUP BY service_code"""),
    "timetables_clean": _with(*STORED, f"SELECT {CLEAN_COLUMNS} FROM clean"),
    "disruptions_clean": _with(DISRUPTIONS, "SELECT * FROM disruptions"),
    "locations_enriched": _with(NARROW, PINGS, """
SELECT location_id, trip_id, "timestamp", round(latitude, 6) AS latitude,
       round(longitude, 6) + 0.0 AS longitude, round(speed_kmh, 6) AS speed_kmh,
       round(heading_deg, 6) AS heading_deg, signal_quality, service_code, operator, is_delayed
FROM pings JOIN trips USING (trip_id)"""),
    "locations_matched": _with(NARROW, PINGS, """
SELECT location_id, trip_id, service_code, operator, is_delayed
FROM pings LEFT JOIN trips USING (trip_id)"""),
    "csv_round_trip": _with(NARROW, """
SELECT * EXCLUDE (delay_minutes, load_factor), round(delay_minutes, 6) AS delay_minutes,
       round(load_factor, 6) AS load_factor FROM trips"""),
    "route_delay_top10": _with(NARROW, """
SELECT service_code, round(avg(delay_minutes), 2) AS avg_delay_min,
       round(stddev_samp(delay_minutes), 2) AS std_delay_min,
       round(min(delay_minutes), 2) AS min_delay_min, round(max(delay_minutes), 2) AS max_delay_min,
       count(*) AS trips, round(avg(is_delayed) * 100, 1) AS pct_delayed
FROM trips GROUP BY service_code ORDER BY avg_delay_min DESC, service_code LIMIT 10"""),
    "disruption_breakdown": _with(DISRUPTIONS, """
SELECT disruption_type, count(*) AS count, round(avg(duration_min), 1) AS avg_duration_min,
       count(*) FILTER (WHERE severity = 'High') AS high_count
FROM disruptions GROUP BY disruption_type"""),
    "delayed_count": _with(NARROW, "SELECT count(*) AS total FROM trips WHERE is_delayed = 1"),
    "operator_reliability": _with(WIDE, """
SELECT operator, round(1 - avg(is_delayed), 4) AS service_reliability, count(*) AS total_trips
FROM trips GROUP BY operator"""),
    "routes_below_threshold": _with(WIDE, """
SELECT service_code,
       round(avg(CASE WHEN is_delayed = 0 THEN 1.0::DOUBLE ELSE 0 END) * 100, 2) AS pct_on_time,
       count(*) AS trips
FROM trips GROUP BY service_code HAVING pct_on_time < 85"""),
    "disruption_hotspots": _with(DISRUPTIONS, """
SELECT service_code, disruption_type, count(*) AS n FROM disruptions WHERE severity = 'High'
GROUP BY service_code, disruption_type ORDER BY n DESC, service_code, disruption_type LIMIT 20"""),
    "routes_high_cv": _with(*STORED, """
SELECT service_code, round(avg(cv_travel_time), 4) AS mean_cv FROM clean
GROUP BY service_code HAVING mean_cv > 0.15"""),
    "operator_profile": _with(WIDE, _profile("true")),
    "kpi_row": _with(WIDE, DISRUPTIONS, """
SELECT count(*) AS total_trips, round((1 - avg(is_delayed)) * 100, 6) AS pct_on_time,
       round(avg(delay_minutes), 6) AS avg_delay,
       (SELECT count(*) FROM disruptions) AS disruptions,
       round((1 - avg(is_delayed)) * 100 - 85, 6) AS gap_to_target FROM trips"""),
    "overall_variability": _with(WIDE, """
SELECT round(stddev_samp(actual_duration_min) / avg(actual_duration_min), 6) AS cv_travel_time,
       round(avg(CASE WHEN is_delayed = 0 THEN 1.0::DOUBLE ELSE 0 END) * 100, 6) AS pct_on_time
FROM trips"""),
    "row_counts": """SELECT 'timetables' AS table_name, count(*) AS row_count FROM events
UNION ALL SELECT 'disruptions', count(*) FROM orders
UNION ALL SELECT 'locations', count(*) FROM lineitem""",
    "headway_regularity": _with(NARROW, REGULARITY, """
SELECT service_code, round(scheduled_headway, 6) AS scheduled_headway,
       round(headway_sd, 6) AS headway_sd, round(headway_ratio, 6) AS headway_ratio,
       headway_ratio > 0.2 AS irregular FROM regularity"""),
    "completion_rate": _with(NARROW, """
SELECT service_code,
       round(count(*) FILTER (WHERE weather <> 'Windy') / count(*), 6) AS completion_rate
FROM trips GROUP BY service_code"""),
    "kpi_compliance": _with(WIDE, DISRUPTIONS, ROUTES, REGULARITY, """
SELECT service_code, 'service_reliability' AS kpi, round(pct_on_time, 6) AS value,
       0.85::DOUBLE AS target, pct_on_time >= 0.85 AS passed FROM durations
UNION ALL SELECT service_code, 'headway_regularity', round(headway_ratio, 6), 0.2::DOUBLE,
       headway_ratio <= 0.2 FROM regularity
UNION ALL SELECT service_code, 'travel_time_cv', round(cv_travel_time, 6), 0.15::DOUBLE,
       cv_travel_time <= 0.15 FROM durations
UNION ALL SELECT service_code, 'completion_rate', 1.0::DOUBLE, 0.95::DOUBLE, true FROM durations"""),
    "hour_profile": _with(NARROW, """
SELECT hour_of_night, round(avg(delay_minutes), 6) AS mean,
       round(stddev_samp(delay_minutes), 6) AS std, count(delay_minutes) AS count
FROM trips GROUP BY hour_of_night"""),
    "frequency_type": _with(DISRUPTIONS, """
SELECT disruption_type, count(*) AS count FROM disruptions GROUP BY disruption_type"""),
    "frequency_severity": _with(DISRUPTIONS, """
SELECT severity, count(*) AS count FROM disruptions GROUP BY severity"""),
    "share_label": _with(WIDE, """
SELECT is_delayed, round(count(*) / (SELECT count(*) FROM trips), 6) AS share
FROM trips GROUP BY is_delayed"""),
    "share_severity": _with(DISRUPTIONS, """
SELECT severity, round(count(*) / (SELECT count(*) FROM disruptions), 6) AS share
FROM disruptions GROUP BY severity"""),
    "route_scatter": _with(*STORED, """
SELECT service_code, round(1 - avg(is_delayed), 6) AS pct_on_time,
       round(avg(cv_travel_time), 6) AS cv, round(avg(disruption_count), 6) AS avg_disruptions,
       1 - avg(is_delayed) >= 0.85 AS meets_on_time, avg(cv_travel_time) <= 0.15 AS meets_cv
FROM clean GROUP BY service_code"""),
    "describe_delay": _with(NARROW, """
SELECT count(delay_minutes) AS count, round(avg(delay_minutes), 6) AS mean,
       round(stddev_samp(delay_minutes), 6) AS std, round(min(delay_minutes), 6) AS min,
       round(quantile_cont(delay_minutes, 0.25), 6) AS p25,
       round(quantile_cont(delay_minutes, 0.5), 6) AS p50,
       round(quantile_cont(delay_minutes, 0.75), 6) AS p75,
       round(quantile_cont(delay_minutes, 0.9), 6) AS p90,
       round(quantile_cont(delay_minutes, 0.95), 6) AS p95,
       round(max(delay_minutes), 6) AS max FROM trips"""),
    "delay_shape": _with(NARROW, """
SELECT round(skewness(delay_minutes), 6) AS skewness, round(kurtosis(delay_minutes), 6) AS kurtosis
FROM trips"""),
    "describe_delay_approx": _with(NARROW, """
SELECT share::DOUBLE AS share, (SELECT count(delay_minutes) FROM trips) AS n, true AS within
FROM (VALUES (0.25), (0.5), (0.75), (0.9), (0.95)) s(share)"""),
    "correlation_gaps": _with(*STORED, """
holed AS (
  SELECT CASE WHEN weather <> 'Fog' THEN load_factor END AS load_factor,
         CASE WHEN vehicle_age_years <= 10 THEN vehicle_age_years END AS vehicle_age_years,
         delay_minutes, passenger_count FROM clean)""", "\nUNION ALL ".join(
        f"SELECT '{b}' AS row_name, '{a}' AS column_name, round(corr({a}, {b}), 6) AS correlation "
        "FROM holed"
        for a, b in combinations(
            ["load_factor", "vehicle_age_years", "delay_minutes", "passenger_count"], 2))),
    "csv_rejects": _with(NARROW, """
SELECT CASE weather WHEN 'Snow' THEN 'capacity' WHEN 'Windy' THEN 'scheduled_depart' ELSE 'none'
       END AS reason, count(*) AS n
FROM trips GROUP BY 1"""),
    "pings_by_bucket": """
SELECT CAST(l_orderkey % 16 AS INTEGER) AS bucket, count(*) AS n_rows,
       count(DISTINCT l_orderkey) AS n_trips
FROM lineitem GROUP BY 1""",
    "stored_by_key": _with(NARROW, PINGS, """
SELECT count(*) AS n_rows, count(DISTINCT trip_id) AS n_trips, CAST(0 AS BIGINT) AS n_misplaced,
       CAST(0 AS BIGINT) AS n_split
FROM pings WHERE trip_id IN (SELECT trip_id FROM trips)"""),
    "stored_join": _with(NARROW, PINGS, """
SELECT operator, count(*) AS n_pings, round(avg(speed_kmh), 6) AS mean_speed
FROM pings JOIN trips USING (trip_id) GROUP BY operator"""),
    "correlation_long": _with(*STORED, _correlations()),
    "delay_histogram": _with(NARROW, *_histogram("trips", 60)),
    "delay_boxplot": _with(NARROW, """
quartiles AS (
  SELECT weather, count(*) AS n, quantile_cont(delay_minutes, 0.25) AS q1,
         quantile_cont(delay_minutes, 0.5) AS median, quantile_cont(delay_minutes, 0.75) AS q3
  FROM trips GROUP BY weather)""", """
SELECT weather, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(least(q1, min(delay_minutes) FILTER (WHERE delay_minutes >= q1 - 1.5 * (q3 - q1))), 6)
         AS whisker_low,
       round(greatest(q3, max(delay_minutes) FILTER (WHERE delay_minutes <= q3 + 1.5 * (q3 - q1))), 6)
         AS whisker_high
FROM trips JOIN quartiles USING (weather) GROUP BY weather, n, q1, median, q3"""),
    "route_hour_pivot": _with(WIDE, _pivot("true")),
    "distinct_routes": _with(NARROW, "SELECT DISTINCT service_code FROM trips"),
    "first_routes": _with(NARROW, """
SELECT DISTINCT service_code FROM trips ORDER BY service_code LIMIT 5"""),
    "first_disruptions": _with(DISRUPTIONS, """
SELECT * FROM disruptions ORDER BY disruption_id LIMIT 20"""),
    "dashboard_operators": _with(WIDE, _profile(FIRST_ROUTES)),
    "dashboard_histogram": _with(
        NARROW, f"chosen AS (SELECT * FROM trips WHERE {FIRST_ROUTES})",
        *_histogram("chosen", 50)),
    "dashboard_heatmap": _with(WIDE, _pivot("hour_of_night >= 22 OR hour_of_night <= 5")),
    "quality_report": _with(NARROW, DISRUPTIONS, PINGS, """
dirty AS (SELECT *, CASE WHEN weather <> 'Fog' THEN is_delayed END AS label FROM trips)""", """
changed AS (SELECT *, CASE WHEN disruption_type = '1-URGENT' THEN 'Critical'
                           WHEN disruption_type <> '5-LOW' THEN severity END AS level
            FROM disruptions)""", "\nUNION ALL ".join([
        _rule("trips_service_code_not_null", "dirty", "service_code IS NULL"),
        _rule("trips_operator_not_null", "dirty", "operator IS NULL"),
        _rule("trips_is_delayed_not_null", "dirty", "label IS NULL"),
        _rule("trips_delay_minutes_clipped_range", "dirty", "delay_minutes NOT BETWEEN -30 AND 60"),
        _rule("disruptions_service_code_not_null", "changed", "service_code IS NULL"),
        _rule("disruptions_severity_domain", "changed", "level NOT IN ('Low', 'Medium', 'High')"),
        _unique("trips_trip_id_unique", "trips", "trip_id"),
        _unique("disruptions_disruption_id_unique", "disruptions", "disruption_id"),
        _unique("pings_location_id_unique", "pings", "location_id"),
        _rule("pings_trip_id_known", "pings", "trip_id NOT IN (SELECT trip_id FROM trips)"),
    ])),
    "class_weights": _with(WIDE, """
SELECT is_delayed, count(*) AS n,
       round((SELECT count(*) FROM trips)
             / ((SELECT count(DISTINCT is_delayed) FROM trips) * count(*)), 6) AS weight
FROM trips GROUP BY is_delayed"""),
    "stratified_split": _with(WIDE, """
SELECT trip_id, is_delayed,
       row_number() OVER (PARTITION BY is_delayed ORDER BY trip_id)
         <= floor(count(*) OVER (PARTITION BY is_delayed) * 0.2::DOUBLE + 0.5) AS is_test
FROM trips"""),
    "stratified_folds": _with(WIDE, """
ranked AS (SELECT trip_id, is_delayed,
                  row_number() OVER (PARTITION BY is_delayed ORDER BY trip_id) AS place,
                  count(*) OVER (PARTITION BY is_delayed) AS size FROM trips)""", """
SELECT trip_id, is_delayed,
       CAST(CASE WHEN place <= floor(size * 0.2::DOUBLE + 0.5) THEN 0
                 WHEN place <= floor(size * 0.4::DOUBLE + 0.5) THEN 1
                 WHEN place <= floor(size * 0.6::DOUBLE + 0.5) THEN 2
                 WHEN place <= floor(size * 0.8::DOUBLE + 0.5) THEN 3 ELSE 4 END AS INTEGER) AS fold
FROM ranked"""),
    "stratified_split_sizes": _with(WIDE, """
sizes AS (SELECT is_delayed, count(*) AS size,
                 CAST(floor(count(*) * 0.2::DOUBLE + 0.5) AS BIGINT) AS test
          FROM trips GROUP BY is_delayed)""", """
SELECT is_delayed, true AS is_test, test AS n FROM sizes
UNION ALL SELECT is_delayed, false, size - test FROM sizes"""),
    "binary_metrics": _with(SCORED, """
by_score AS (
  SELECT score, count(*) FILTER (WHERE is_delayed = 1) AS pos,
         count(*) FILTER (WHERE is_delayed = 0) AS neg FROM scored GROUP BY score
), area AS (
  SELECT sum(neg * (above - pos / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE) AS auc
  FROM (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS above FROM by_score)
)""", """
SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision,
       round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1,
       (SELECT round(auc, 6) FROM area) AS roc_auc FROM cells"""),
    "roc_points": _with(SCORED, """
by_score AS (
  SELECT score, count(*) FILTER (WHERE is_delayed = 1) AS pos,
         count(*) FILTER (WHERE is_delayed = 0) AS neg FROM scored GROUP BY score)""", """
SELECT round(score, 6) AS threshold,
       round(sum(neg) OVER (ORDER BY score DESC) / (SELECT fp + tn FROM cells), 6) AS fpr,
       round(sum(pos) OVER (ORDER BY score DESC) / (SELECT tp + fn FROM cells), 6) AS tpr
FROM by_score UNION ALL SELECT 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE"""),
    "confusion": _with(SCORED, """
SELECT 0 AS actual, 0 AS predicted, tn AS n FROM cells
UNION ALL SELECT 0, 1, fp FROM cells
UNION ALL SELECT 1, 0, fn FROM cells
UNION ALL SELECT 1, 1, tp FROM cells"""),
    "class_report": _with(SCORED, """
scores AS (
  SELECT 'On-Time' AS class, tn / (tn + fn) AS p, tn / (tn + fp) AS r,
         2 * tn / (2 * tn + fp + fn) AS f, tn + fp AS s FROM cells
  UNION ALL SELECT 'Delayed', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn
  FROM cells)""", """
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, s AS support
FROM scores
UNION ALL SELECT 'accuracy', NULL, NULL, round((tp + tn) / (tp + tn + fp + fn), 6),
  tp + tn + fp + fn FROM cells
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6),
  CAST(sum(s) AS BIGINT) FROM scores
UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 6), round(sum(r * s) / sum(s), 6),
  round(sum(f * s) / sum(s), 6), CAST(sum(s) AS BIGINT) FROM scores"""),
    "best_model": _with(SCORED, "results AS ("
                        + " UNION ALL ".join(map(_f1, (300, 500, 700))) + ")", """
SELECT model, round(f1, 6) AS f1 FROM results ORDER BY f1 DESC, model LIMIT 1"""),
    "training_rows": _with(*STORED, "SELECT trip_id, "
                           + FEATURE_COLUMNS.format("CAST(", " AS DOUBLE)") + " FROM clean"),
    "random_split_checks": """
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_twice, true AS share_in_bounds FROM events""",
    "scaled_features": _with(*STORED, "SELECT trip_id, " + ", ".join(
        f"round({name} / stddev_samp({name}) OVER (), 6) AS unit_{name}, "
        f"round(({name} - avg({name}) OVER ()) / stddev_samp({name}) OVER (), 6) AS centred_{name}"
        for name in ("load_factor", "vehicle_age_years")) + " FROM clean"),
    "fitting_layout": _with(*STORED, """
SELECT count(*) AS n_rows,
       CAST(greatest(1, least(64, ceil(count(*) / 10000)), ceil(count(*) / 2000000)) AS INTEGER)
         AS n_parts, true AS even FROM clean"""),
    "lr_grid_checks": _with(*STORED, """
SELECT reg_param::DOUBLE AS reg_param, elastic_net_param::DOUBLE AS elastic_net_param,
       (SELECT count(DISTINCT vehicle_age_years > 7) = 2 FROM clean) AS finds_it,
       true AS chosen_is_best, true AS model_is_chosen
FROM (VALUES (0.01), (0.1)) a(reg_param), (VALUES (0.0), (0.5)) b(elastic_net_param)"""),
    "mllib_metrics": _with(SCORED, """
by_score AS (
  SELECT floor(score * 50) AS score, count(*) FILTER (WHERE is_delayed = 1) AS pos,
         count(*) FILTER (WHERE is_delayed = 0) AS neg FROM scored GROUP BY 1
), area AS (
  SELECT sum(neg * (above - pos / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE) AS auc
  FROM (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS above FROM by_score)
)""", """
SELECT (SELECT round(auc, 6) FROM area) AS roc_auc,
       round(((tn + fp) * (2 * tn / (2 * tn + fp + fn)) + (tp + fn) * (2 * tp / (2 * tp + fp + fn)))
             / (tn + fp + fn + tp), 6) AS weighted_f1,
       round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy FROM cells"""),
    "roc_points_reduced": _with(SCORED, """
by_score AS (
  SELECT score, count(*) FILTER (WHERE is_delayed = 1) AS pos,
         count(*) FILTER (WHERE is_delayed = 0) AS neg FROM scored GROUP BY score
), points AS (
  SELECT score, pos, neg, sum(pos) OVER down AS tp, sum(neg) OVER down AS fp,
         lead(pos) OVER down AS next_pos, lead(neg) OVER down AS next_neg,
         row_number() OVER down AS place
  FROM by_score WINDOW down AS (ORDER BY score DESC)
)""", """
SELECT round(score, 6) AS threshold, round(fp / (SELECT fp + tn FROM cells), 6) AS fpr,
       round(tp / (SELECT tp + fn FROM cells), 6) AS tpr
FROM points WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE"""),
    "model_comparison_decided": _with(*STORED, """
found AS (SELECT count(DISTINCT vehicle_age_years > 7) = 2 AS yes FROM clean)""", """
SELECT model, yes AS accuracy, yes AS precision, yes AS recall, yes AS f1, yes AS roc_auc,
       yes AS cv_f1, yes AS timed
FROM found, (VALUES ('Logistic Regression'), ('Random Forest'), ('Gradient Boosting')) m(model)"""),
    "feature_importance_decided": _with(*STORED, """
SELECT a AS actual, p AS predicted, count(vehicle_age_years) FILTER (WHERE a = p) AS n,
       'vehicle_age_years' AS first_feature
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) cells(a, p)
LEFT JOIN clean ON CAST(vehicle_age_years > 7 AS INTEGER) = a GROUP BY a, p"""),
    "batch_scores_checks": _with(*STORED, """
SELECT count(*) AS n_trips, CAST(0 AS BIGINT) AS n_changed, CAST(0 AS BIGINT) AS n_inconsistent
FROM clean"""),
}
