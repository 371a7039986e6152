"""One StructType per stream, plus the fixed values every layer shares."""

from __future__ import annotations

from pyspark.sql import types as T


_TEXT, _REAL, _WHOLE, _LONG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


# The fields of each stream's messages.
QUAKE = _struct(
    id=_TEXT, mag=_REAL, place=_TEXT, time_ms=_LONG, lon=_REAL, lat=_REAL, depth_km=_REAL,
    alert=_TEXT, tsunami=_WHOLE, sig=_WHOLE, status=_TEXT, mag_type=_TEXT, net=_TEXT, ingested_at=_TEXT,
)
FIRE = _struct(
    lat=_REAL, lon=_REAL, brightness=_REAL, frp=_REAL, confidence=_TEXT, acq_date=_TEXT, acq_time=_TEXT,
    satellite=_TEXT, daynight=_TEXT, scan=_REAL, track=_REAL, ingested_at=_TEXT,
)
AIR = _struct(
    location_id=_TEXT, sensor_id=_TEXT, parameter=_TEXT, value=_REAL, unit=_TEXT, lat=_REAL, lon=_REAL,
    country=_TEXT, measured_at=_TEXT, ingested_at=_TEXT,
)

# Landing files. Scalars are read as text so that one bad number rejects one record, not a file.
QUAKE_FEATURE = _struct(
    id=_TEXT,
    properties=_struct(
        mag=_TEXT, place=_TEXT, time=_TEXT, alert=_TEXT, tsunami=_TEXT, sig=_TEXT,
        status=_TEXT, magType=_TEXT, net=_TEXT,
    ),
    geometry=_struct(coordinates=T.ArrayType(_TEXT)),
)
QUAKE_FILE = _struct(features=T.ArrayType(QUAKE_FEATURE), _corrupt_record=_TEXT)
FIRE_COLUMNS = (
    "latitude", "longitude", "bright_ti4", "frp", "confidence", "acq_date", "acq_time",
    "satellite", "daynight", "scan", "track",
)
AIR_RESULT = _struct(
    value=_TEXT,
    coordinates=_struct(latitude=_TEXT, longitude=_TEXT),
    datetime=_struct(utc=_TEXT),
    sensorsId=_TEXT,
    locationsId=_TEXT,
)
AIR_FILE = _struct(results=T.ArrayType(AIR_RESULT), _corrupt_record=_TEXT)

KINDS = ("earthquakes", "wildfires", "pollution")
STREAM_SCHEMA = dict(zip(KINDS, (QUAKE, FIRE, AIR)))

# The physical sort order of each base table.
SORT_KEY = {
    "earthquakes": ("event_time", "id"),
    "wildfires": ("event_time", "lat", "lon"),
    "pollution": ("event_time", "parameter", "location_id"),
}

# What makes two deliveries the same observation.
NATURAL_KEY = {
    "earthquakes": ("id",),
    "wildfires": ("lat", "lon", "acq_date", "acq_time", "satellite"),
    "pollution": ("sensor_id", "parameter", "measured_at"),
}

# The message key of each topic, and its number of partitions.
TOPIC_KEY = {"earthquakes": "net", "wildfires": "satellite", "pollution": "parameter"}
TOPIC_PARTITIONS = 3

# Measured parameters and monitored countries by service id.
PARAMETERS = {2: "pm25", 5: "no2", 3: "o3"}
COUNTRIES = {
    22: "France",
    68: "United States",
    23: "India",
    13: "Brazil",
    108: "Indonesia",
    59: "Japan",
    48: "Turkey",
}
AIR_UNIT = "µg/m³"

# Model inputs, in model order.
ZONE = ("zone_lat", "zone_lon")
FEATURES = (
    "zone_lat", "zone_lon", "abs_lat",
    "eq_count_7d", "max_mag_7d", "avg_mag_7d", "shallow_eq_ratio", "hours_since_last_eq",
    "fire_count_7d", "max_frp_7d", "avg_frp_7d",
    "avg_pm25_48h", "max_pm25_48h", "avg_no2_48h",
)
LABEL = "significant_event"
