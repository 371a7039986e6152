"""The map layer: a position on the globe, a size and a colour per event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import seconds_text
from ..functions.encode import fixed
from ..functions.grid import has_place, on_sphere
from ..schemas import AIR_UNIT

# Fixed values of the map: radii, sizes, colours, and the reading below which air counts as clean.
QUAKE_RADIUS, FIRE_RADIUS, AIR_RADIUS = 1.01, 1.008, 1.006
CLEAN_AIR = 25.0


def _layer(df: DataFrame, kind: str, radius: float, **look) -> DataFrame:
    placed = df.filter(has_place())
    place = on_sphere(F.col("lat"), F.col("lon"), radius)
    return placed.select(
        F.lit(kind).alias("type"),
        "lat", "lon", "event_time",
        *(c.alias(n) for n, c in place.items()),
        look["size"].alias("size"),
        look["color"].alias("color"),
        look["opacity"].alias("opacity"),
    )


def quake_markers(quakes: DataFrame) -> DataFrame:
    mag = F.col("mag")
    drawn = F.when(mag != 0, mag).otherwise(F.lit(1.0))
    return _layer(
        quakes, "earthquake", QUAKE_RADIUS,
        size=F.greatest(F.lit(0.005), drawn * F.lit(0.008)),
        color=F.when(mag >= 5, "#ff0000").when(mag >= 3, "#ff6644").otherwise("#ff9966"),
        opacity=F.lit(1.0),
    )


def fire_markers(fires: DataFrame) -> DataFrame:
    return _layer(
        fires, "wildfire", FIRE_RADIUS,
        size=F.greatest(F.lit(0.004), F.log10(F.col("frp") + F.lit(1.0)) * F.lit(0.006)),
        color=F.lit("#ff6600"),
        opacity=F.lit(1.0),
    )


def air_markers(air: DataFrame) -> DataFrame:
    value = F.col("value")
    return _layer(
        air.filter(value >= CLEAN_AIR), "pollution", AIR_RADIUS,
        size=F.lit(0.012),
        color=F.lit("#00bfff"),
        opacity=F.least(value / F.lit(200.0), F.lit(0.6)),
    )


def marker_layer(quakes: DataFrame, fires: DataFrame, air: DataFrame) -> DataFrame:
    return quake_markers(quakes).unionByName(fire_markers(fires)).unionByName(air_markers(air))


def detail_text(quakes: DataFrame) -> DataFrame:
    """The lines of the detail panel of a quake, ready to show."""
    dash = F.lit("—")
    return quakes.select(
        "id",
        F.concat(F.lit("M"), fixed(F.col("mag"), 1), F.lit(" Earthquake")).alias("title"),
        F.when(F.length("place") > 0, F.col("place")).otherwise(dash).alias("place"),
        F.concat(fixed(F.col("depth_km"), 1), F.lit(" km")).alias("depth"),
        F.when(F.length("status") > 0, F.col("status")).otherwise(dash).alias("status"),
        F.when(F.col("tsunami") != 0, "Yes").otherwise("No").alias("tsunami"),
        F.coalesce(seconds_text(F.col("event_time")), dash).alias("time"),
    )


def fire_detail_text(fires: DataFrame) -> DataFrame:
    """The lines of the detail panel of a fire."""
    return fires.select(
        "lat", "lon",
        F.lit("Active Wildfire").alias("title"),
        F.concat(fixed(F.col("frp"), 1), F.lit(" MW")).alias("frp"),
        F.concat(fixed(F.col("brightness"), 1), F.lit(" K")).alias("brightness"),
        "confidence", "satellite",
        F.concat_ws(" ", "acq_date", "acq_time").alias("time"),
    )


def air_detail_text(air: DataFrame) -> DataFrame:
    """The lines of the detail panel of a reading."""
    return air.select(
        F.concat(F.lit("Pollution — "), F.upper("parameter")).alias("title"),
        F.concat(fixed(F.col("value"), 1), F.lit(f" {AIR_UNIT}")).alias("value"),
        F.when(F.length("country") > 0, F.col("country")).otherwise("—").alias("country"),
        F.col("location_id").alias("station"),
    )
