"""Names, limits, labels and texts that results depend on.

Nothing here is computed. Every value is part of the contract of an operator
and is stated once, in its natural order.
"""

# --- column sets of the weather layers -------------------------------------
BRONZE_COLUMNS = (
    "city",
    "country",
    "temperature_kelvin",
    "temperature_celsius",
    "feels_like_celsius",
    "humidity",
    "pressure",
    "wind_speed",
    "wind_direction",
    "weather_condition",
    "weather_description",
    "clouds_percentage",
    "visibility",
    "timestamp",
    "sunrise",
    "sunset",
    "ingested_at",
)
METADATA_COLUMNS = ("_transformed_at", "_source_layer")

# --- row validation ---------------------------------------------------------
MISSING_REASON = "Missing required field '{field}'"
RANGE_REASON = " outside range [{low}, {high}]"
INFINITE_REASON = "cannot convert float infinity to integer"

# --- gates ------------------------------------------------------------------
SEVERITIES = ("info", "warning", "critical")
LAYERS = ("bronze", "silver", "gold")
ALERTED_STATUSES = ("failed", "blocked")
NULL_PERCENT_CRITICAL = 10
FRESHNESS_HOURS = 24
SAMPLE_SIZE = 5
REASON_ISSUES = 5
BLOCK_TEXT_ISSUES = 3

# --- enrichment -------------------------------------------------------------
# right-closed bins; a value on or below the first edge, or above the last, has no label
TEMPERATURE_EDGES = (-100, 0, 10, 20, 30, 100)
TEMPERATURE_LABELS = ("freezing", "cold", "mild", "warm", "hot")
WIND_EDGES = (-1, 5, 15, 30, 200)
WIND_LABELS = ("calm", "light", "moderate", "strong")

KELVIN_OFFSET = 273.15

# heat index, in degrees Fahrenheit and percent
HEAT_MIN_FAHRENHEIT = 80
HEAT_MIN_HUMIDITY = 40
HEAT_BASE = 61.0
HEAT_PIVOT = 68.0
HEAT_SLOPE = 1.2
HEAT_HUMIDITY_SLOPE = 0.094

DAYTIME_HOURS = (6, 18)
COMFORT_CELSIUS = (18, 26)
COMFORT_HUMIDITY = (30, 60)

# display marks, each used below its upper limit
TEMPERATURE_MARKS = ((0, "🥶"), (15, "❄️"), (25, "🌤️"))
TEMPERATURE_MARK_ABOVE = "🔥"
GOOD_PERCENT = 95

# --- robust outliers --------------------------------------------------------
MAD_SCALE = 0.6745
OUTLIER_THRESHOLD = 3.5
OUTLIER_MIN_SAMPLES = 3

# --- serving and reports ----------------------------------------------------
UPSERT_UPDATES = ("temperature_celsius", "humidity", "ingested_at")
PLAUSIBLE_CELSIUS = (-50, 60)
LATEST_ROWS = 100
RECENT_RUNS = 20
RUN_STATS_WINDOW = 50
TREND_DAYS = 14
HISTOGRAM_BINS = 20
QUARANTINE_DAYS = 90

# --- landing payloads -------------------------------------------------------
FETCH_OUTCOMES = {
    401: "Invalid API key",
    404: "City not found: {name}",
    429: "Rate limit exceeded",
}
FETCH_FAILED = "API request failed"
UNKNOWN = "Unknown"
