"""Fixed values.

Everything in this module must equal the values of the system we mirror for
results to agree: category labels and their draw thresholds, value ranges of
the generated weather columns, the region centroids used for coordinate
jitter, the risk-score cut points, the rule that labels rows, the training
options, the sixteen next-day observations that are scored, and the published
evaluation numbers.  They are listed plainly, in their natural order.
"""

from __future__ import annotations

# --- fixed values: weather labels, drawn in this order with these cut points
WEATHER_LABELS = ["sunny", "cloudy", "windy", "rainy", "stormy"]
WEATHER_THRESHOLDS = [0.2, 0.4, 0.6, 0.8]

# --- fixed values: the sixteen German states, drawn in this order; the k-th
# draw (k = 1..15) compares against k/16, the last label is the fallback.
STATES = [
    "Baden-Württemberg",
    "Bayern",
    "Berlin",
    "Brandenburg",
    "Bremen",
    "Hamburg",
    "Hessen",
    "Mecklenburg-Vorpommern",
    "Niedersachsen",
    "Nordrhein-Westfalen",
    "Rheinland-Pfalz",
    "Saarland",
    "Sachsen",
    "Sachsen-Anhalt",
    "Schleswig-Holstein",
    "Thüringen",
]
STATE_THRESHOLDS = [0.0625, 0.125, 0.1875, 0.25, 0.3125, 0.375, 0.4375, 0.5,
                    0.5625, 0.625, 0.6875, 0.75, 0.8125, 0.875, 0.9375]

# --- fixed values: state centroid and jitter width
# state: (longitude, longitude spread, latitude, latitude spread)
CENTROIDS = {
    "Baden-Württemberg": (9.0, 2.5, 48.5, 2.0),
    "Bayern": (11.5, 4.0, 48.5, 3.0),
    "Berlin": (13.4, 0.5, 52.5, 0.3),
    "Brandenburg": (13.0, 2.0, 52.3, 2.0),
    "Bremen": (8.8, 0.3, 53.1, 0.2),
    "Hamburg": (10.0, 0.3, 53.6, 0.2),
    "Hessen": (9.0, 2.0, 50.5, 2.0),
    "Mecklenburg-Vorpommern": (12.5, 2.5, 53.5, 1.5),
    "Niedersachsen": (9.5, 3.0, 52.5, 2.5),
    "Nordrhein-Westfalen": (7.5, 2.5, 51.5, 2.0),
    "Rheinland-Pfalz": (7.5, 2.0, 50.0, 2.0),
    "Saarland": (7.0, 0.5, 49.4, 0.5),
    "Sachsen": (13.5, 2.0, 51.0, 1.5),
    "Sachsen-Anhalt": (11.5, 2.0, 51.8, 1.5),
    "Schleswig-Holstein": (9.5, 2.0, 54.2, 1.5),
    "Thüringen": (11.0, 1.5, 50.8, 1.2),
}
DEFAULT_CENTROID = (10.0, 2.0, 51.0, 2.0)

# --- fixed values: generated numeric columns, value = u * scale + offset
# column: (scale, offset)
NUMERIC_DRAWS = {
    "temperature_celsius": (25.0, 10.0),
    "humidity_percent": (70.0, 20.0),
    "pressure_hpa": (20.0, 990.0),
    "wind_speed_ms": (15.0, 0.0),
    "wind_direction_degrees": (360.0, 0.0),
    "precipitation_mm": (5.0, 0.0),
    "visibility_km": (10.0, 0.0),
}
ELEVATION_DRAW = (1500.0, 50.0)
STATION_COUNT = 16          # station_1 .. station_16
MONTH_COUNT = 12            # 1 .. 12

# --- fixed values: risk scores (strict comparisons, first match wins)
TEMP_SCORE_CUTS = [(25.0, 4), (20.0, 3)]      # temperature > cut
TEMP_SCORE_DEFAULT = 2
HUMIDITY_SCORE_CUTS = [(40.0, 4), (60.0, 3)]  # humidity < cut
HUMIDITY_SCORE_DEFAULT = 2

# --- fixed values: rule label
# high:     temperature > 30 and humidity < 30 and wind speed > 10
# moderate: temperature > 25 and humidity < 50
# low:      otherwise
HIGH_RULE = {"temperature_gt": 30.0, "humidity_lt": 30.0, "wind_gt": 10.0}
MODERATE_RULE = {"temperature_gt": 25.0, "humidity_lt": 50.0}
RISK_LABELS = ["high", "moderate", "low"]

# --- fixed values: model options
LABEL_COLUMN = "wildfire_risk_label"
NUMERIC_FEATURES = [
    "temperature_celsius",
    "humidity_percent",
    "pressure_hpa",
    "wind_speed_ms",
    "wind_direction_degrees",
    "precipitation_mm",
    "visibility_km",
    "temp_risk_score",
    "humidity_risk_score",
    "elevation_meters",
]
CATEGORICAL_FEATURES = ["weather_condition", "state_province"]
ORDINAL_FEATURES = ["month"]   # an integer column, so treated as numeric
MAX_ITERATIONS = 49
LEARN_RATE = 0.1
L1_REG = 0.01
L2_REG = 0.01
EVAL_FRACTION = 0.2
AUTO_CLASS_WEIGHTS = True
DEFAULT_TRAINING_ROWS = 1000
MODEL_TYPE = "LOGISTIC_REGRESSION"

# --- fixed values: table names
TRAINING_TABLE = "wildfire_training_data"
PREDICTIONS_TABLE = "next_day_wildfire_predictions"
DEFAULT_MODEL_NAME = "wildfire_risk_model"

# --- fixed values: next-day observations that are scored
# All taken at 2025-09-18 10:00:00 read as a UTC instant and shown as
# Europe/Berlin wall time (12:00:00); month 9.
OBSERVATION_TIME = "2025-09-18 10:00:00"
OBSERVATION_ZONE = "Europe/Berlin"
OBSERVATION_COLUMNS = [
    "station_id", "state_province", "temperature_celsius", "humidity_percent",
    "pressure_hpa", "wind_speed_ms", "wind_direction_degrees",
    "precipitation_mm", "visibility_km", "weather_condition",
    "elevation_meters",
]
NEXT_DAY_OBSERVATIONS = [
    ("station_BY", "Bayern", 31.0, 32.0, 1012.5, 15.0, 225.0, 0.0, 18.0, "sunny", 580.0),
    ("station_BW", "Baden-Württemberg", 29.0, 38.0, 1010.0, 12.0, 180.0, 0.0, 15.0, "sunny", 420.0),
    ("station_BB", "Brandenburg", 27.0, 42.0, 1008.0, 8.0, 90.0, 0.0, 12.0, "cloudy", 85.0),
    ("station_SN", "Sachsen", 26.0, 48.0, 1009.0, 6.0, 135.0, 0.5, 14.0, "cloudy", 280.0),
    ("station_NW", "Nordrhein-Westfalen", 24.0, 58.0, 1011.0, 7.0, 270.0, 1.0, 16.0, "rainy", 180.0),
    ("station_HE", "Hessen", 25.5, 52.0, 1010.5, 9.0, 200.0, 0.2, 13.0, "cloudy", 320.0),
    ("station_NI", "Niedersachsen", 23.0, 65.0, 1013.0, 11.0, 315.0, 0.8, 11.0, "windy", 95.0),
    ("station_SH", "Schleswig-Holstein", 21.0, 72.0, 1014.0, 13.0, 300.0, 1.5, 9.0, "rainy", 45.0),
    ("station_MV", "Mecklenburg-Vorpommern", 22.5, 68.0, 1013.5, 10.0, 45.0, 0.3, 10.0, "windy", 70.0),
    ("station_BE", "Berlin", 26.5, 45.0, 1009.5, 7.5, 120.0, 0.0, 13.5, "sunny", 55.0),
    ("station_HH", "Hamburg", 22.0, 70.0, 1014.5, 12.0, 280.0, 2.0, 8.0, "rainy", 25.0),
    ("station_HB", "Bremen", 23.5, 66.0, 1013.8, 11.5, 295.0, 1.2, 9.5, "windy", 15.0),
    ("station_RP", "Rheinland-Pfalz", 27.5, 46.0, 1011.2, 8.5, 210.0, 0.1, 14.5, "sunny", 250.0),
    ("station_SL", "Saarland", 28.0, 44.0, 1010.8, 9.5, 195.0, 0.0, 16.5, "sunny", 290.0),
    ("station_ST", "Sachsen-Anhalt", 26.8, 43.0, 1008.5, 7.0, 150.0, 0.0, 12.5, "cloudy", 120.0),
    ("station_TH", "Thüringen", 25.2, 49.0, 1009.8, 6.5, 170.0, 0.2, 13.8, "cloudy", 380.0),
]

# --- fixed values: published evaluation of the reference model
PUBLISHED_METRICS = {
    "accuracy": "0.7589743589743589",
    "f1_score": "0.5187807923595764",
    "log_loss": "0.5989319550016924",
    "precision": "0.5267094017094016",
    "recall": "0.8244677798817927",
    "roc_auc": "0.9511888111888112",
}
