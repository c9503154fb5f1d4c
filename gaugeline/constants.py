"""Sensor ranges, stations, thresholds, window sizes, codes.

They are configuration that results depend on; everything else in the package
takes them as defaults and lets the caller pass others.
"""

# Allowed range and unit per sensor type.
SENSOR_RANGES = [
    ("water_level", 0.0, 50.0, "m"),
    ("flow_rate", 0.0, 5000.0, "m3/s"),
    ("rainfall", 0.0, 500.0, "mm"),
    ("temperature", -10.0, 45.0, "degC"),
    ("ph", 0.0, 14.0, ""),
    ("turbidity", 0.0, 1000.0, "NTU"),
    ("dissolved_oxygen", 0.0, 20.0, "mg/L"),
]
RANGE_OF = {name: (low, high) for name, low, high, _ in SENSOR_RANGES}

# Default monitoring stations (id, name, latitude, longitude).
STATIONS = [
    ("S001", "upper reach", 30.05, 120.10),
    ("S002", "middle reach", 30.15, 120.30),
    ("S003", "lower reach", 30.25, 120.50),
    ("S004", "reservoir", 29.50, 119.20),
    ("S005", "tributary", 30.05, 119.95),
]

# Warning level, name, lowest water level, confidence.
WARNING_THRESHOLDS = [
    (1, "blue", 15.0, 0.95),
    (2, "yellow", 20.0, 0.92),
    (3, "orange", 25.0, 0.88),
    (4, "red", 30.0, 0.85),
]
# The grade below the first threshold.
NO_RISK = (0, "normal", 0.98)

# Penalties of the record rules, in tenths of the quality score.
PENALTY_TENTHS = {
    "water_level": 3,
    "rainfall": 2,
    "temperature": 2,
    "logical": 3,
    "timestamp": 2,
}
MIN_QUALITY = 0.6

# Heavy rain with a low level is inconsistent.
HEAVY_RAIN = 50.0
LOW_LEVEL = 1.0
# A reading expires once it is eight full days old.
EXPIRY = "8 days"

# data_quality codes.
QUALITY_OK, QUALITY_ABNORMAL, QUALITY_MISSING = 1, 2, 3

# Warning types and the default delivery channels.
WARNING_TYPES = [(1, "flood"), (2, "drought"), (3, "pollution")]
CHANNELS = ["system_notification", "app_push", "sms"]
WARNING_HOURS = 24

# Window length, horizon, model features.
WINDOW_ROWS = 72
HORIZON = 24
FEATURES = ["water_level", "flow_rate", "rainfall", "temperature"]
TARGET = "water_level"

# Sensors per station, hourly sampling, wet-hour bound.
SENSORS_PER_STATION = 3
SAMPLING = "1 hour"
WET_HOUR = 0.5

# Titles and texts of flood warnings: level, title, content. Both are printf
# patterns; the title takes the station, the content the station and the level.
FLOOD_TEXTS = [
    (4, "RED - %s", "%s: peak of %s m expected within the forecast. Clear the flood plain now."),
    (3, "ORANGE - %s", "%s: peak of %s m expected within the forecast. Man the barriers; crews on call."),
    (2, "YELLOW - %s", "%s: peak of %s m expected within the forecast. Check pumps and gates today."),
    (1, "BLUE - %s", "%s: peak of %s m expected within the forecast. For information."),
]
FLOOD_TEXT_OTHER = ("NOTICE - %s", "%s: level of %s m.")
