"""Thresholds, geofences and label tables shared by every job."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: units and codes of the AIS message format -----------------------------------
EARTH_RADIUS_NM = 3440.065
SOG_NOT_AVAILABLE = 102.3
COG_NOT_AVAILABLE = 360.0
HEADING_NOT_AVAILABLE = 511
NULL_TOKENS = ("", "nan", "NaT", "None", "none", "null")
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# --- Fixed values: canonical columns of a position report and the header spellings accepted ----
TEXT_FIELDS = (
    "vessel_name", "imo", "call_sign", "vessel_type", "status", "cargo", "transceiver_class",
)
NUMBER_FIELDS = ("lat", "lon", "sog", "cog", "heading", "length", "width", "draft")
HEADER_ALIASES = {
    "mmsi": ("mmsi",),
    "base_datetime": ("basedatetime", "base_date_time", "base_datetime", "timestamp", "time"),
    "lat": ("lat", "latitude"),
    "lon": ("lon", "longitude"),
    "sog": ("sog", "speed"),
    "cog": ("cog", "course"),
    "heading": ("heading", "true_heading"),
    "vessel_name": ("vesselname", "vessel_name", "vessel_nm", "name"),
    "imo": ("imo",),
    "call_sign": ("callsign", "call_sign"),
    "vessel_type": ("vesseltype", "vessel_type", "vessel_ny_status", "type"),
    "status": ("status", "nav_status"),
    "length": ("length",),
    "width": ("width",),
    "draft": ("draft",),
    "cargo": ("cargo",),
    "transceiver_class": ("transceiverclass", "transceiver_class", "transceiver"),
}


@dataclass(frozen=True)
class Box:
    """A latitude/longitude rectangle, borders included."""

    name: str
    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


# --- Fixed values: geofences -------------------------------------------------------------------
PORT_BOXES = (
    Box("Houston Ship Channel", 29.50, 29.85, -95.30, -94.80),
    Box("New York Harbor", 40.50, 40.75, -74.30, -73.90),
    Box("Port of Los Angeles / Long Beach", 33.70, 33.85, -118.35, -118.10),
    Box("Port of New Orleans", 29.00, 30.00, -90.50, -89.50),
    Box("Port of Miami", 25.70, 25.85, -80.20, -80.05),
)
LEGACY_RISK_BOX = Box("Suez", 29.5, 31.5, 31.0, 33.5)
US_WATERS = Box("US Waters", 24.0, 49.0, -125.0, -66.0)
COASTAL_ZONES = (
    Box("Atlantic / East Coast", 24.0, 47.0, -82.0, -66.0),
    Box("Pacific / West Coast", 32.0, 49.0, -125.0, -117.0),
    Box("Gulf of Mexico", 24.0, 31.0, -97.0, -80.0),
    Box("Great Lakes", 41.0, 49.0, -93.0, -76.0),
)
# Region labels in order of precedence; None means "any latitude".
REGION_RULES = (
    ("East Coast", -82, -66, None, None),
    ("West Coast", -125, -117, None, None),
    ("Gulf of Mexico", -97, -80, 24, 31),
    ("Great Lakes", -93, -76, 41, 49),
)
REGION_OTHER = "Other US Waters"


@dataclass(frozen=True)
class Thresholds:
    """Every tunable number of the jobs, with the defaults the jobs run with."""

    stopped_kn: float = 0.5
    slow_kn: float = 2.0
    speeding_kn: float = 30.0
    max_sog_kn: float = 60.0
    teleport_kn: float = 100.0
    congestion_high: int = 15
    congestion_medium: int = 5
    near_miss_nm: float = 0.1
    near_miss_min_sog: float = 1.0
    converging_deg: float = 45.0
    sudden_stop_kn: float = 5.0
    sharp_turn_deg: float = 45.0
    sharp_turn_min_sog: float = 2.0
    gap_seconds: int = 300
    train_last_day: int = 5
    test_day: int = 6


DEFAULTS = Thresholds()

# --- Fixed values: vessel type labels, one table per consumer ----------------------------------
VESSEL_TYPES_CLEANED = {
    "0": "Not Available", "30": "Fishing", "31": "Towing", "36": "Sailing",
    "37": "Pleasure Craft", "50": "Pilot Vessel", "52": "Tug", "60": "Passenger",
    "70": "Cargo", "80": "Tanker", "35": "Military", "51": "SAR", "90": "Other",
}
VESSEL_TYPES_SHARED = {
    "0": "Not Available", "20": "Wing in Ground", "30": "Fishing", "31": "Towing",
    "32": "Towing Large", "33": "Dredging", "35": "Military", "36": "Sailing",
    "37": "Pleasure Craft", "40": "High Speed Craft", "50": "Pilot Vessel",
    "51": "SAR Vessel", "52": "Tug", "53": "Port Tender", "55": "Law Enforcement",
    "60": "Passenger", "70": "Cargo", "71": "Cargo Hazardous A", "80": "Tanker",
    "81": "Tanker Hazardous A", "89": "Tanker", "90": "Other",
}
VESSEL_TYPES_TRACK = {
    "0": "Not Available", "30": "Fishing", "31": "Towing", "32": "Towing Large",
    "35": "Military", "36": "Sailing", "37": "Pleasure Craft", "40": "High Speed",
    "50": "Pilot Vessel", "51": "SAR Vessel", "52": "Tug", "53": "Port Tender",
    "55": "Law Enforcement", "60": "Passenger", "70": "Cargo", "71": "Cargo Hazardous",
    "80": "Tanker", "81": "Tanker Hazardous", "89": "Tanker", "90": "Other",
}
VESSEL_TYPES_NUMERIC = {
    30: "Fishing", 31: "Towing", 32: "Towing (Large)", 33: "Dredging", 34: "Diving",
    35: "Military", 36: "Sailing", 37: "Pleasure", 50: "Pilot Vessel", 51: "SAR",
    52: "Tug", 53: "Port Tender", 60: "Passenger", 70: "Cargo", 80: "Tanker", 90: "Other",
}
VESSEL_TYPES_SCREEN = {
    "0": "Unknown", "1": "Reserved", "30": "Fishing", "31": "Towing", "32": "Towing Large",
    "35": "Military", "36": "Sailing", "37": "Pleasure", "40": "High Speed", "50": "Pilot",
    "51": "SAR", "52": "Tug", "55": "Law Enf.", "60": "Passenger", "70": "Cargo",
    "71": "Cargo-Hazardous", "80": "Tanker", "81": "Tanker-Hazardous", "89": "Tanker",
    "90": "Other",
}

# --- Fixed values: navigation status labels ----------------------------------------------------
STATUS_CLEANED = {
    "0": "Underway/Engine", "1": "At Anchor", "2": "Not Under Command", "5": "Moored",
    "6": "Aground", "7": "Fishing", "8": "Underway/Sailing",
}
STATUS_SHARED = {
    "0": "Underway using engine", "1": "At anchor", "2": "Not under command",
    "3": "Restricted manoeuvrability", "5": "Moored", "6": "Aground",
    "7": "Engaged in fishing", "8": "Underway sailing", "15": "Not defined",
}
STATUS_NUMERIC = {
    0: "Underway/Engine", 1: "At Anchor", 2: "Not Under Command", 3: "Restricted",
    5: "Moored", 6: "Aground", 7: "Fishing", 8: "Underway/Sail",
}
# status code -> (underway, stopped, anchored, moored, aground)
STATUS_FLAGS = {
    "0": (True, False, False, False, False),
    "1": (False, True, True, False, False),
    "2": (False, False, False, False, False),
    "3": (True, False, False, False, False),
    "5": (False, True, False, True, False),
    "6": (False, True, False, False, True),
    "7": (True, False, False, False, False),
    "8": (True, False, False, False, False),
    "15": (False, False, False, False, False),
}

# --- Fixed values: alert vocabulary ------------------------------------------------------------
ANOMALY_KINDS = (
    "SUDDEN_STOP", "SHARP_TURN", "UNUSUAL_SPEED", "STATIONARY_RISK", "ML_ANOMALY",
    "UNEXPECTED_DIRECTION",
)
COLLISION_KIND = "COLLISION_RISK"
SEVERITY_ORDER = {"LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}
LEVEL_ORDER = {"LOW": 1, "MEDIUM": 2, "HIGH": 3}

# --- Fixed values: model settings --------------------------------------------------------------
FOREST_FEATURES = ("sog", "cog", "heading", "sog_change", "heading_change", "distance_nm")
FOREST_FEATURES_WIDE = (
    "sog", "cog", "heading", "lat", "lon", "sog_change", "heading_change",
    "time_delta_sec", "distance_nm", "length", "width", "draft",
)
POSITION_FEATURES = (
    "lat", "lon", "sog", "cog", "heading", "sog_change", "heading_change",
    "time_delta_sec", "hour", "month",
)
CONGESTION_FEATURES = (
    "vessel_count", "avg_sog", "stopped_count", "hour", "day_of_week", "is_weekend",
    "lat_bin", "lon_bin",
)
PREDICT_MINUTES = (5, 10, 15)
PING_SECONDS = 28

# --- Fixed values: weather severity ------------------------------------------------------------
WIND_CEILING = 24.5
WAVE_CEILING = 6.0
WIND_WEIGHT = 0.6
WAVE_WEIGHT = 0.4
WEATHER_CELL_DEG = 0.5
