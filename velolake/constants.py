"""Fixed values that must equal the reference pipeline's for results to match.

Everything here is data, stated plainly in the reference's own order.
"""

# --- fixed values: allowed domains used by the silver rule sets -----------------
ALLOWED_SCOOTER_STATUS = ["available", "in_use", "charging", "maintenance"]
ALLOWED_PAYMENT_METHODS = ["card", "wallet", "cash"]
ALLOWED_RIDE_STATUS = ["in_progress", "completed", "cancelled"]
ALLOWED_EVENT_TYPES = ["start", "end"]

# --- fixed values: silver error messages, in rule order ----------------------------
TELEMETRY_MESSAGES = [
    "scooter_id is null",
    "battery_level out of range [0-100]",
    "latitude out of range [-90,90]",
    "longitude out of range [-180,180]",
    "timestamp is null",
    "speed_kmh out of range [0,60]",
    "odometer_km must be >= 0",
    "temperature_c out of range [-20,70]",
    "signal_strength out of range [1,5]",
    "scooter_status invalid",
]
RIDE_MESSAGES = [
    "ride_id is null",
    "user_id is null",
    "user_id must be > 0",
    "scooter_id is null",
    "event_type must be 'start' or 'end'",
    "timestamp is null",
    "duration_mins out of range [0,180]",
    "distance_km out of range [0,100]",
    "fare_amount must be >= 0",
    "payment_method invalid",
    "ride_status invalid",
]
ERROR_SEPARATOR = "|"

# --- fixed values: gold / mart parameters -------------------------------------------
COMPLETED_EVENT_TYPE = "end"
LOW_BATTERY_THRESHOLD = 20
MART_WINDOW_DURATION = "1 minute"   # the reference's "fast demo mode" window
MART_WATERMARK = "1 minute"
DEDUP_WATERMARK = "7 days"
REVENUE_DIFF_TOLERANCE_PCT = 5.0

# --- fixed values: names of the nine checks of the validation report ----------------
CHECK_REVENUE_COUNT = "Revenue count within tolerance"
CHECK_FLEET_MAX = "Fleet max within bounds"
CHECK_RIDE_NULLS = "No nulls in fact_rides"
CHECK_TELEMETRY_NULLS = "No nulls in fact_telemetry"
CHECK_REVENUE_NULLS = "No nulls in mart_revenue"
CHECK_FLEET_NULLS = "No nulls in mart_fleet"
CHECK_FARES = "No negative fares"
CHECK_BATTERY = "No invalid battery levels"
CHECK_DISTANCES = "No negative distances"

# Window used by the named hourly queries (README: "hourly aggregates").
HOURLY = "1 hour"
