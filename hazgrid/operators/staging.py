"""Base tables -> classified observations that have a position and a usable measure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import depth_class, frp_class, mag_class
from ..functions.grid import has_place


def _partition_column(df: DataFrame) -> list[str]:
    """Keep the date folder column, so horizons further up still prune folders."""
    return ["event_date"] if "event_date" in df.columns else []


def stage_quakes(quakes: DataFrame) -> DataFrame:
    return quakes.filter(F.col("mag").isNotNull() & has_place()).select(
        "id", "mag", "place", "lon", "lat", "depth_km",
        F.coalesce("alert", F.lit("none")).alias("alert"),
        "tsunami", "sig", "status", "mag_type", "net", "event_time",
        depth_class(F.col("depth_km")).alias("depth_class"),
        mag_class(F.col("mag")).alias("mag_class"),
        *_partition_column(quakes),
    )


def stage_fires(fires: DataFrame) -> DataFrame:
    return fires.filter(has_place() & (F.col("frp") > 0)).select(
        "lat", "lon", "brightness", "frp", "confidence", "satellite", "daynight", "scan", "track", "event_time",
        frp_class(F.col("frp")).alias("frp_class"),
        *_partition_column(fires),
    )


def stage_air(air: DataFrame) -> DataFrame:
    wide = [F.when(F.col("parameter") == p, F.col("value")).alias(p) for p in ("pm25", "no2", "o3")]
    return air.filter((F.col("value") >= 0) & has_place()).select(
        "location_id", "sensor_id", "parameter", "value", "unit", "lat", "lon", "country", "event_time",
        *wide,
        *_partition_column(air),
    )
