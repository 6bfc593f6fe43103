"""SQL (DuckDB dialect) for the named queries.

The SQL never goes through JSON: it derives ride / telemetry rows from ``events`` with
the arithmetic of ``velolake.sources.sample`` and states each rule set directly.
Totals and averages are those of the doubles as they come; where a result has any, both
sides round it to six decimals, as the last bits of a sum depend on the order of the rows.
Windows are hourly (``date_trunc``); ``day_of_week`` is shifted to 1 = Sunday.
"""

from __future__ import annotations

from velolake.sources.sample import CITIES, PAYMENT_CYCLE, STATUS_CYCLE


def _list(items) -> str:
    return "[" + ", ".join(f"'{x}'" for x in items) + "]"


def _in(items) -> str:
    return "(" + ", ".join("'" + x.replace("'", "''") + "'" for x in items) + ")"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- fixed values, stated here again so that a wrong constant of the engine shows ----
TM = ["scooter_id is null", "battery_level out of range [0-100]", "latitude out of range [-90,90]",
      "longitude out of range [-180,180]", "timestamp is null", "speed_kmh out of range [0,60]",
      "odometer_km must be >= 0", "temperature_c out of range [-20,70]", "signal_strength out of range [1,5]",
      "scooter_status invalid"]
RM = ["ride_id is null", "user_id is null", "user_id must be > 0", "scooter_id is null",
      "event_type must be 'start' or 'end'", "timestamp is null", "duration_mins out of range [0,180]",
      "distance_km out of range [0,100]", "fare_amount must be >= 0", "payment_method invalid", "ride_status invalid"]
EVENT_TYPES, PAYMENTS = ["start", "end"], ["card", "wallet", "cash"]
RIDE_STATUS, SCOOTER_STATUS = ["in_progress", "completed", "cancelled"], ["available", "in_use", "charging", "maintenance"]
LOW_BATTERY, TOLERANCE = 20, 5.0

RIDE_COLS = ("bronze_ingestion_time, city, distance_km, duration_mins, event_type, fare_amount, "
             "payment_method, ride_id, ride_status, scooter_id, \"timestamp\", user_id")
TEL_COLS = ("bronze_ingestion_time, battery_level, is_locked, latitude, longitude, odometer_km, scooter_id, "
            "scooter_status, signal_strength, speed_kmh, temperature_c, \"timestamp\"")
FACT_RIDE_COLS = ("ride_id, event_ts, bronze_ingestion_time, user_id, scooter_id, event_type, ride_status, city, "
                  "payment_method, distance_km, duration_mins, fare_amount")
FACT_TEL_COLS = ("event_ts, bronze_ingestion_time, scooter_id, latitude, longitude, battery_level, speed_kmh, "
                 "odometer_km, temperature_c, signal_strength, is_locked, scooter_status")


def _unless_broken(columns: str) -> str:
    """The columns of a message; a message that is no JSON has none."""
    return ", ".join(f'CASE WHEN event_id % 127 <> 9 THEN "{c}" END AS "{c}"' for c in columns.split(", "))


def _ctes(window_unit: str = "hour") -> str:
    step = f"INTERVAL 1 {window_unit.upper()}"
    return f"""
WITH rides_sent AS (
  SELECT event_id, ts AS bronze_ingestion_time,
         CASE WHEN event_id % 101 <> 7 THEN 'R-' || CAST(event_id AS VARCHAR) END AS ride_id,
         CASE WHEN event_id % 103 <> 5 THEN user_id END AS user_id,
         CASE WHEN event_id % 107 <> 3 THEN 'S-' || CAST(100 + event_id % 900 AS VARCHAR) END AS scooter_id,
         CASE WHEN event_type IN ('purchase', 'click') THEN 'end'
              WHEN event_type = 'view' THEN 'start'
              WHEN event_type = 'error' THEN 'error' END AS event_type,
         CASE WHEN event_id % 109 <> 2 THEN epoch_us(ts) // 1000 END AS "timestamp",
         CASE WHEN event_id % 131 <> 6 THEN event_id % 200 END AS duration_mins,
         value AS distance_km,
         value - CAST(1.0 AS DOUBLE) AS fare_amount,
         CASE WHEN event_id % 17 <> 0 THEN ({_list(CITIES)})[event_id % 10 + 1] END AS city,
         ({_list(PAYMENT_CYCLE)})[event_id % 4 + 1] AS payment_method,
         CASE WHEN event_id % 113 = 1 THEN 'paused'
              WHEN event_type = 'view' THEN 'in_progress'
              WHEN event_type = 'purchase' THEN 'completed'
              WHEN event_type = 'click' THEN 'cancelled' END AS ride_status
  FROM events
),
rides_raw AS (
  SELECT bronze_ingestion_time, {_unless_broken("ride_id, user_id, scooter_id, event_type, timestamp, duration_mins, distance_km, fare_amount, city, payment_method, ride_status")}
  FROM rides_sent
),
rides_checked AS (
  SELECT *,
    (ride_id IS NOT NULL) AND (user_id IS NOT NULL) AND (user_id > 0) AND (scooter_id IS NOT NULL)
    AND (event_type IN {_in(EVENT_TYPES)}) AND ("timestamp" IS NOT NULL)
    AND (duration_mins IS NULL OR (duration_mins >= 0 AND duration_mins <= 180))
    AND (distance_km IS NULL OR (distance_km >= 0 AND distance_km <= 100))
    AND (fare_amount IS NULL OR fare_amount >= 0)
    AND (payment_method IS NULL OR payment_method IN {_in(PAYMENTS)})
    AND (ride_status IS NULL OR ride_status IN {_in(RIDE_STATUS)}) AS is_valid,
    concat_ws('|',
      CASE WHEN ride_id IS NULL THEN {_q(RM[0])} END,
      CASE WHEN user_id IS NULL THEN {_q(RM[1])} END,
      CASE WHEN user_id <= 0 THEN {_q(RM[2])} END,
      CASE WHEN scooter_id IS NULL THEN {_q(RM[3])} END,
      CASE WHEN NOT (event_type IN {_in(EVENT_TYPES)}) THEN {_q(RM[4])} END,
      CASE WHEN "timestamp" IS NULL THEN {_q(RM[5])} END,
      CASE WHEN duration_mins IS NOT NULL AND (duration_mins < 0 OR duration_mins > 180) THEN {_q(RM[6])} END,
      CASE WHEN distance_km IS NOT NULL AND (distance_km < 0 OR distance_km > 100) THEN {_q(RM[7])} END,
      CASE WHEN fare_amount IS NOT NULL AND fare_amount < 0 THEN {_q(RM[8])} END,
      CASE WHEN payment_method IS NOT NULL AND NOT (payment_method IN {_in(PAYMENTS)}) THEN {_q(RM[9])} END,
      CASE WHEN ride_status IS NOT NULL AND NOT (ride_status IN {_in(RIDE_STATUS)}) THEN {_q(RM[10])} END
    ) AS all_messages,
    concat_ws('|',
      CASE WHEN event_type IS NULL THEN 'event_type is null' END
    ) AS undecided_messages
  FROM rides_raw
),
tel_sent AS (
  SELECT event_id, ts AS bronze_ingestion_time,
         CASE WHEN event_id % 101 <> 3 THEN 'S-' || CAST(100 + event_id % 900 AS VARCHAR) END AS scooter_id,
         CASE WHEN event_id % 13 <> 0 THEN event_id % 121 - 10 END AS battery_level,
         value - 90 AS latitude,
         180 - value AS longitude,
         CASE WHEN event_id % 103 <> 4 THEN epoch_us(ts) // 1000 END AS "timestamp",
         value / 8 AS speed_kmh,
         value * 10 - 5 AS odometer_km,
         value - 20 AS temperature_c,
         event_id % 7 AS signal_strength,
         event_id % 2 = 0 AS is_locked,
         ({_list(STATUS_CYCLE)})[event_id % 5 + 1] AS scooter_status
  FROM events
),
tel_raw AS (
  SELECT bronze_ingestion_time, {_unless_broken("scooter_id, battery_level, latitude, longitude, timestamp, speed_kmh, odometer_km, temperature_c, signal_strength, is_locked, scooter_status")}
  FROM tel_sent
),
tel_checked AS (
  SELECT *,
    (scooter_id IS NOT NULL)
    AND (battery_level >= 0 AND battery_level <= 100)
    AND (latitude >= -90 AND latitude <= 90)
    AND (longitude >= -180 AND longitude <= 180)
    AND ("timestamp" IS NOT NULL)
    AND (speed_kmh IS NULL OR (speed_kmh >= 0 AND speed_kmh <= 60))
    AND (odometer_km IS NULL OR odometer_km >= 0)
    AND (temperature_c IS NULL OR (temperature_c >= -20 AND temperature_c <= 70))
    AND (signal_strength IS NULL OR (signal_strength >= 1 AND signal_strength <= 5))
    AND (scooter_status IS NULL OR scooter_status IN {_in(SCOOTER_STATUS)}) AS is_valid,
    concat_ws('|',
      CASE WHEN scooter_id IS NULL THEN {_q(TM[0])} END,
      CASE WHEN battery_level < 0 OR battery_level > 100 THEN {_q(TM[1])} END,
      CASE WHEN latitude < -90 OR latitude > 90 THEN {_q(TM[2])} END,
      CASE WHEN longitude < -180 OR longitude > 180 THEN {_q(TM[3])} END,
      CASE WHEN "timestamp" IS NULL THEN {_q(TM[4])} END,
      CASE WHEN speed_kmh IS NOT NULL AND (speed_kmh < 0 OR speed_kmh > 60) THEN {_q(TM[5])} END,
      CASE WHEN odometer_km IS NOT NULL AND odometer_km < 0 THEN {_q(TM[6])} END,
      CASE WHEN temperature_c IS NOT NULL AND (temperature_c < -20 OR temperature_c > 70) THEN {_q(TM[7])} END,
      CASE WHEN signal_strength IS NOT NULL AND (signal_strength < 1 OR signal_strength > 5) THEN {_q(TM[8])} END,
      CASE WHEN scooter_status IS NOT NULL AND NOT (scooter_status IN {_in(SCOOTER_STATUS)}) THEN {_q(TM[9])} END
    ) AS all_messages,
    concat_ws('|',
      CASE WHEN battery_level IS NULL THEN 'battery_level is null' END,
      CASE WHEN latitude IS NULL THEN 'latitude is null' END,
      CASE WHEN longitude IS NULL THEN 'longitude is null' END
    ) AS undecided_messages
  FROM tel_raw
),
silver_rides AS (SELECT {RIDE_COLS} FROM rides_checked WHERE is_valid),
quarantine_rides AS (SELECT {RIDE_COLS}, all_messages AS error_message FROM rides_checked WHERE NOT is_valid),
silver_tel AS (SELECT {TEL_COLS} FROM tel_checked WHERE is_valid),
quarantine_tel AS (SELECT {TEL_COLS}, all_messages AS error_message FROM tel_checked WHERE NOT is_valid),
fact_rides AS (
  SELECT ride_id, make_timestamp(("timestamp" // 1000) * 1000000) AS event_ts, bronze_ingestion_time, user_id,
         scooter_id, event_type, ride_status, city, payment_method, distance_km, duration_mins, fare_amount
  FROM silver_rides WHERE "timestamp" IS NOT NULL
),
fact_tel AS (
  SELECT make_timestamp(("timestamp" // 1000) * 1000000) AS event_ts, bronze_ingestion_time, scooter_id,
         latitude, longitude, battery_level, speed_kmh, odometer_km, temperature_c, signal_strength,
         is_locked, scooter_status
  FROM silver_tel WHERE "timestamp" IS NOT NULL
),
mart_revenue AS (
  SELECT date_trunc('{window_unit}', event_ts) AS hour_start,
         date_trunc('{window_unit}', event_ts) + {step} AS hour_end,
         count(DISTINCT ride_id) AS completed_rides,
         sum(fare_amount) AS total_revenue,
         avg(fare_amount) AS avg_fare_amount,
         sum(distance_km) AS total_distance_km,
         avg(distance_km) AS avg_distance_km,
         CAST(sum(duration_mins) AS DOUBLE) / NULLIF(count(duration_mins), 0) AS avg_duration_mins
  FROM fact_rides WHERE event_type = 'end'
  GROUP BY 1, 2
),
mart_fleet AS (
  SELECT date_trunc('{window_unit}', event_ts) AS hour_start,
         date_trunc('{window_unit}', event_ts) + {step} AS hour_end,
         count(DISTINCT scooter_id) AS fleet_size_seen,
         CAST(sum(battery_level) AS DOUBLE) / NULLIF(count(battery_level), 0) AS avg_battery_level,
         count(DISTINCT CASE WHEN battery_level < {LOW_BATTERY} THEN scooter_id END) AS low_battery_scooters,
         count(DISTINCT CASE WHEN scooter_status = 'in_use' THEN scooter_id END) AS scooters_in_use,
         count(DISTINCT CASE WHEN scooter_status = 'maintenance' THEN scooter_id END) AS scooters_in_maintenance
  FROM fact_tel
  GROUP BY 1, 2
)
"""


BASE = _ctes("hour")
MINUTE = _ctes("minute")

# A mart's rows as compared.
REV = "* REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in (
    "total_revenue", "avg_fare_amount", "total_distance_km", "avg_distance_km", "avg_duration_mins")) + ")"
FLEET = "* REPLACE (round(avg_battery_level, 6) AS avg_battery_level)"
REV_DEFAULT = """SELECT hour_start, hour_end, completed_rides, true AS completed_rides_within_bound,
       round(total_revenue, 6) AS total_revenue, round(avg_fare_amount, 6) AS avg_fare_amount,
       round(total_distance_km, 6) AS total_distance_km, round(avg_distance_km, 6) AS avg_distance_km,
       round(avg_duration_mins, 6) AS avg_duration_mins FROM """
FLEET_DEFAULT = """SELECT *, true AS fleet_size_seen_within_bound, true AS low_battery_scooters_within_bound,
       true AS scooters_in_use_within_bound, true AS scooters_in_maintenance_within_bound
       FROM (SELECT * REPLACE (round(avg_battery_level, 6) AS avg_battery_level) FROM """

# Checks of the validation report, as SQL over the CTEs above.
def _report(rides: str = "fact_rides", tel: str = "fact_tel", revenue: str = "mart_revenue", fleet: str = "mart_fleet") -> str:
    return f"""
, recon AS (
  SELECT count(*) AS fact_completed_rides,
         (SELECT CAST(coalesce(sum(completed_rides), 0) AS BIGINT) FROM {revenue}) AS mart_completed_rides
  FROM {rides}
  WHERE event_type = 'end'
    AND event_ts >= (SELECT min(hour_start) FROM {revenue})
    AND event_ts < (SELECT max(hour_end) FROM {revenue})
),
recon2 AS (
  SELECT fact_completed_rides, mart_completed_rides,
         abs(fact_completed_rides - mart_completed_rides) AS diff,
         CASE WHEN fact_completed_rides > 0
              THEN CAST(abs(fact_completed_rides - mart_completed_rides) AS DOUBLE) / fact_completed_rides * 100.0
              ELSE 0.0 END AS diff_pct
  FROM recon
),
fleet_b AS (
  SELECT max(fleet_size_seen) AS max_fleet_size_seen,
         (SELECT count(*) FROM (SELECT DISTINCT scooter_id FROM {tel})) AS distinct_scooters
  FROM {fleet}
),
report AS (
  SELECT 'Revenue count within tolerance' AS "check", diff_pct <= {TOLERANCE} AS passed,
         CAST(diff_pct AS DOUBLE) AS observed, CAST({TOLERANCE} AS DOUBLE) AS "limit" FROM recon2
  UNION ALL
  SELECT 'Fleet max within bounds', coalesce(max_fleet_size_seen <= distinct_scooters, true),
         CAST(max_fleet_size_seen AS DOUBLE), CAST(distinct_scooters AS DOUBLE) FROM fleet_b
  UNION ALL
  SELECT 'No nulls in fact_rides', n = 0, CAST(n AS DOUBLE), 0.0 FROM (
    SELECT count(*) FILTER (WHERE ride_id IS NULL) + count(*) FILTER (WHERE event_ts IS NULL)
         + count(*) FILTER (WHERE fare_amount IS NULL) + count(*) FILTER (WHERE scooter_id IS NULL)
         + count(*) FILTER (WHERE user_id IS NULL) AS n FROM {rides})
  UNION ALL
  SELECT 'No negative fares', n = 0, CAST(n AS DOUBLE), 0.0 FROM (SELECT count(*) FILTER (WHERE fare_amount < 0) AS n FROM {rides})
  UNION ALL
  SELECT 'No negative distances', n = 0, CAST(n AS DOUBLE), 0.0 FROM (SELECT count(*) FILTER (WHERE distance_km < 0) AS n FROM {rides})
  UNION ALL
  SELECT 'No nulls in fact_telemetry', n = 0, CAST(n AS DOUBLE), 0.0 FROM (
    SELECT count(*) FILTER (WHERE scooter_id IS NULL) + count(*) FILTER (WHERE event_ts IS NULL)
         + count(*) FILTER (WHERE battery_level IS NULL) + count(*) FILTER (WHERE scooter_status IS NULL) AS n
    FROM {tel})
  UNION ALL
  SELECT 'No invalid battery levels', n = 0, CAST(n AS DOUBLE), 0.0 FROM (
    SELECT count(*) FILTER (WHERE battery_level < 0 OR battery_level > 100) AS n FROM {tel})
  UNION ALL
  SELECT 'No nulls in mart_revenue', n = 0, CAST(n AS DOUBLE), 0.0 FROM (
    SELECT count(*) FILTER (WHERE completed_rides IS NULL) + count(*) FILTER (WHERE total_revenue IS NULL)
         + count(*) FILTER (WHERE hour_start IS NULL) AS n FROM {revenue})
  UNION ALL
  SELECT 'No nulls in mart_fleet', n = 0, CAST(n AS DOUBLE), 0.0 FROM (
    SELECT count(*) FILTER (WHERE fleet_size_seen IS NULL) + count(*) FILTER (WHERE avg_battery_level IS NULL)
         + count(*) FILTER (WHERE hour_start IS NULL) AS n FROM {fleet})
)
"""


_REPORT = _report()


# The stored tables with faults put in, as velolake.plans.frames.with_faults does it.
FAULTY = """
, rides_f AS (SELECT * REPLACE (
    CASE WHEN duration_mins % 7 = 0 THEN -1 - fare_amount ELSE fare_amount END AS fare_amount,
    CASE WHEN duration_mins % 11 = 0 THEN -1 - distance_km ELSE distance_km END AS distance_km,
    CASE WHEN duration_mins % 13 <> 0 THEN user_id END AS user_id) FROM fact_rides),
tel_f AS (SELECT * REPLACE (
    CASE WHEN signal_strength = 3 THEN battery_level + 150 ELSE battery_level END AS battery_level,
    CASE WHEN signal_strength <> 4 THEN scooter_status END AS scooter_status) FROM fact_tel),
revenue_f AS (SELECT * REPLACE (completed_rides * 2 AS completed_rides,
    CASE WHEN hour(hour_start) <> 5 THEN total_revenue END AS total_revenue) FROM mart_revenue),
fleet_f AS (SELECT * REPLACE (fleet_size_seen + 100000 AS fleet_size_seen,
    CASE WHEN hour(hour_start) <> 5 THEN avg_battery_level END AS avg_battery_level) FROM mart_fleet)
"""


ORACLE: dict[str, str] = {
    "bronze_parse_rides": BASE + f"SELECT {RIDE_COLS} FROM rides_raw",
    "bronze_parse_telemetry": BASE + f"SELECT {TEL_COLS} FROM tel_raw",
    "silver_rides_valid": BASE + "SELECT * FROM silver_rides",
    "silver_rides_quarantine": BASE + "SELECT * FROM quarantine_rides",
    "silver_rides_undecided": BASE + f"SELECT {RIDE_COLS} FROM rides_checked WHERE is_valid IS NULL",
    "silver_rides_quarantine_with_undecided": BASE + f"""
        SELECT {RIDE_COLS}, CASE WHEN is_valid IS NULL THEN undecided_messages ELSE all_messages END AS error_message
        FROM rides_checked WHERE NOT coalesce(is_valid, false)""",
    "silver_telemetry_valid": BASE + "SELECT * FROM silver_tel",
    "silver_telemetry_quarantine": BASE + "SELECT * FROM quarantine_tel",
    "silver_telemetry_undecided": BASE + f"SELECT {TEL_COLS} FROM tel_checked WHERE is_valid IS NULL",
    "silver_telemetry_quarantine_with_undecided": BASE + f"""
        SELECT {TEL_COLS}, CASE WHEN is_valid IS NULL THEN undecided_messages ELSE all_messages END AS error_message
        FROM tel_checked WHERE NOT coalesce(is_valid, false)""",
    "quarantine_reason_counts": BASE + """
        SELECT source, reason, count(*) AS "rows" FROM (
          SELECT 'ride_events' AS source, unnest(string_split(error_message, '|')) AS reason FROM quarantine_rides
          UNION ALL
          SELECT 'telemetry', unnest(string_split(error_message, '|')) FROM quarantine_tel)
        GROUP BY source, reason""",
    "fact_rides": BASE + "SELECT * FROM fact_rides",
    "fact_telemetry": BASE + "SELECT * FROM fact_tel",
    "fact_epoch_rejects": BASE + """
        SELECT 'ride_events' AS source, count(*) FILTER (WHERE abs("timestamp" // 1000) > 9223372036854) AS epoch_rejects,
               count(*) AS valid_rows FROM silver_rides
        UNION ALL
        SELECT 'telemetry', count(*) FILTER (WHERE abs("timestamp" // 1000) > 9223372036854), count(*) FROM silver_tel""",
    "dim_payment_method": BASE + "SELECT DISTINCT payment_method FROM fact_rides WHERE payment_method IS NOT NULL",
    "dim_city": BASE + "SELECT DISTINCT city FROM fact_rides WHERE city IS NOT NULL",
    "dim_time_hourly": BASE + """
        SELECT hour_start, CAST(year(hour_start) AS INTEGER) AS year, CAST(month(hour_start) AS INTEGER) AS month,
               CAST(day(hour_start) AS INTEGER) AS day, CAST(dayofweek(hour_start) + 1 AS INTEGER) AS day_of_week,
               CAST(hour(hour_start) AS INTEGER) AS hour
        FROM (SELECT DISTINCT date_trunc('hour', event_ts) AS hour_start
              FROM (SELECT event_ts FROM fact_rides UNION ALL SELECT event_ts FROM fact_tel))""",
    "mart_revenue": BASE + f"SELECT {REV} FROM mart_revenue",
    "mart_fleet_health": BASE + f"SELECT {FLEET} FROM mart_fleet",
    "mart_revenue_minutely": MINUTE + f"SELECT {REV} FROM mart_revenue",
    "mart_fleet_health_minutely": MINUTE + f"SELECT {FLEET} FROM mart_fleet",
    "mart_revenue_default": BASE + REV_DEFAULT + "mart_revenue",
    "mart_fleet_health_default": BASE + FLEET_DEFAULT + "mart_fleet)",
    "mart_revenue_approx_bounds": BASE + """
        SELECT hour_start, hour_end, completed_rides, true AS completed_rides_within_bound FROM mart_revenue""",
    "mart_fleet_approx_bounds": BASE + """
        SELECT hour_start, hour_end, fleet_size_seen, true AS fleet_size_seen_within_bound,
               true AS low_battery_scooters_within_bound, true AS scooters_in_use_within_bound,
               true AS scooters_in_maintenance_within_bound FROM mart_fleet""",
    "fact_overview": BASE + """
        SELECT 'fact_rides' AS "table", count(*) AS "rows", min(event_ts) AS min_event_ts, max(event_ts) AS max_event_ts FROM fact_rides
        UNION ALL
        SELECT 'fact_telemetry', count(*), min(event_ts), max(event_ts) FROM fact_tel""",
    "mart_bounds": BASE + "SELECT min(hour_start) AS min_hour_start, max(hour_end) AS max_hour_end FROM mart_revenue",
    "revenue_reconciliation": BASE + _REPORT + f"""
        SELECT fact_completed_rides, mart_completed_rides, diff, diff_pct,
               diff_pct <= {TOLERANCE} AS within_tolerance FROM recon2""",
    "revenue_totals": BASE + """
        SELECT round(sum(total_revenue), 6) AS total_revenue, round(sum(total_distance_km), 6) AS total_distance_km,
               count(*) AS windows FROM mart_revenue""",
    "fleet_totals": BASE + """
        SELECT CAST(sum(fleet_size_seen) AS BIGINT) AS total_fleet_observations,
               CAST(sum(low_battery_scooters) AS BIGINT) AS total_low_battery,
               CAST(sum(scooters_in_use) AS BIGINT) AS total_in_use,
               CAST(sum(scooters_in_maintenance) AS BIGINT) AS total_maintenance,
               count(*) AS windows FROM mart_fleet""",
    "fleet_bound": BASE + _REPORT + """
        SELECT max_fleet_size_seen, distinct_scooters,
               coalesce(max_fleet_size_seen <= distinct_scooters, true) AS within_bounds FROM fleet_b""",
    "fact_rides_null_checks": BASE + """
        SELECT count(*) FILTER (WHERE ride_id IS NULL) AS null_ride_id, count(*) FILTER (WHERE event_ts IS NULL) AS null_event_ts,
               count(*) FILTER (WHERE fare_amount IS NULL) AS null_fare_amount,
               count(*) FILTER (WHERE scooter_id IS NULL) AS null_scooter_id,
               count(*) FILTER (WHERE user_id IS NULL) AS null_user_id FROM fact_rides""",
    "fact_telemetry_null_checks": BASE + """
        SELECT count(*) FILTER (WHERE scooter_id IS NULL) AS null_scooter_id,
               count(*) FILTER (WHERE event_ts IS NULL) AS null_event_ts,
               count(*) FILTER (WHERE battery_level IS NULL) AS null_battery_level,
               count(*) FILTER (WHERE scooter_status IS NULL) AS null_scooter_status FROM fact_tel""",
    "mart_revenue_null_checks": BASE + """
        SELECT count(*) FILTER (WHERE completed_rides IS NULL) AS null_completed_rides,
               count(*) FILTER (WHERE total_revenue IS NULL) AS null_total_revenue,
               count(*) FILTER (WHERE hour_start IS NULL) AS null_hour_start FROM mart_revenue""",
    "mart_fleet_null_checks": BASE + """
        SELECT count(*) FILTER (WHERE fleet_size_seen IS NULL) AS null_fleet_size_seen,
               count(*) FILTER (WHERE avg_battery_level IS NULL) AS null_avg_battery_level,
               count(*) FILTER (WHERE hour_start IS NULL) AS null_hour_start FROM mart_fleet""",
    "fare_distance_quality": BASE + """
        SELECT count(*) FILTER (WHERE fare_amount < 0) AS negative_fares,
               count(*) FILTER (WHERE fare_amount = 0) AS zero_fares,
               count(*) FILTER (WHERE distance_km < 0) AS negative_distances FROM fact_rides""",
    "zero_fares": BASE + """
        SELECT count(*) FILTER (WHERE fare_amount = 0) AS zero_fares FROM fact_rides""",
    "battery_quality": BASE + """
        SELECT count(*) FILTER (WHERE battery_level < 0 OR battery_level > 100) AS invalid_battery FROM fact_tel""",
    "validation_report": BASE + _REPORT + "SELECT * FROM report",
    "validation_report_faulty": BASE + FAULTY + _report("rides_f", "tel_f", "revenue_f", "fleet_f") + "SELECT * FROM report",
    "validation_summary": BASE + _REPORT + """
        SELECT count(*) FILTER (WHERE passed) AS passed, count(*) AS total FROM report""",
    "latest_revenue_windows": BASE + f"SELECT {REV} FROM mart_revenue ORDER BY hour_start DESC LIMIT 3",
    "latest_fleet_windows": BASE + f"SELECT {FLEET} FROM mart_fleet ORDER BY hour_start DESC LIMIT 3",
    "kpi_revenue": BASE + """
        SELECT round(coalesce(sum(coalesce(total_revenue, 0.0)), 0.0), 6) AS total_revenue,
               CAST(coalesce(sum(coalesce(completed_rides, 0)), 0) AS BIGINT) AS completed_rides FROM mart_revenue""",
    "kpi_fleet": BASE + """
        SELECT round(avg(coalesce(avg_battery_level, 0.0)), 6) AS avg_battery_level,
               CAST(coalesce(sum(coalesce(low_battery_scooters, 0)), 0) AS BIGINT) AS low_battery_scooters,
               CAST(coalesce(sum(coalesce(scooters_in_maintenance, 0)), 0) AS BIGINT) AS scooters_in_maintenance
        FROM mart_fleet""",
    "series_revenue": BASE + """
        SELECT hour_start, round(total_revenue, 6) AS total_revenue FROM mart_revenue
        WHERE hour_start IS NOT NULL AND total_revenue IS NOT NULL ORDER BY hour_start""",
    "series_battery": BASE + """
        SELECT hour_start, round(avg_battery_level, 6) AS avg_battery_level FROM mart_fleet
        WHERE hour_start IS NOT NULL AND avg_battery_level IS NOT NULL ORDER BY hour_start""",
    "last10_revenue": BASE + f"SELECT {REV} FROM (SELECT * FROM mart_revenue ORDER BY hour_start DESC NULLS FIRST LIMIT 10) ORDER BY hour_start NULLS LAST",
    "last10_fleet": BASE + f"SELECT {FLEET} FROM (SELECT * FROM mart_fleet ORDER BY hour_start DESC NULLS FIRST LIMIT 10) ORDER BY hour_start NULLS LAST",
    "series_revenue_text_times": BASE + """
        SELECT hour_start, round(total_revenue, 6) AS total_revenue FROM mart_revenue
        WHERE hour(hour_start) <> 23 AND total_revenue IS NOT NULL""",
    "kpi_absent_columns": BASE + """
        SELECT CAST(NULL AS DOUBLE) AS avg_battery_level, CAST(0 AS BIGINT) AS low_battery_scooters,
               CAST(sum(scooters_in_maintenance) AS BIGINT) AS scooters_in_maintenance, CAST(0 AS BIGINT) AS points
        FROM mart_fleet""",
    "silver_schema_merge": BASE + """
        SELECT * REPLACE (CASE WHEN user_id % 2 <> 0 THEN city END AS city) FROM silver_rides""",
    "mart_revenue_rollup": BASE + f"SELECT *, true AS equals_direct FROM ({REV_DEFAULT} mart_revenue)",
    "mart_fleet_rollup": BASE + f"SELECT *, true AS equals_direct FROM ({FLEET_DEFAULT} mart_fleet))",
    "fleet_totals_distinct": MINUTE + f"""
        SELECT (SELECT count(*) FROM mart_fleet) AS windows, count(DISTINCT scooter_id) AS fleet_size_seen,
               count(DISTINCT CASE WHEN battery_level < {LOW_BATTERY} THEN scooter_id END) AS low_battery_scooters,
               count(DISTINCT CASE WHEN scooter_status = 'in_use' THEN scooter_id END) AS scooters_in_use,
               count(DISTINCT CASE WHEN scooter_status = 'maintenance' THEN scooter_id END) AS scooters_in_maintenance,
               true AS fleet_size_seen_within_bound, true AS low_battery_scooters_within_bound,
               true AS scooters_in_use_within_bound, true AS scooters_in_maintenance_within_bound FROM fact_tel""",
}
