"""Grid cells and positions on the unit sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cell(degrees: Column) -> Column:
    """Whole degree, ties to even. ``rint`` stays a JVM intrinsic; ``+ 0.0`` turns -0.0 into 0.0."""
    return F.rint(degrees) + F.lit(0.0)


def zone_columns(lat: str = "lat", lon: str = "lon") -> list[Column]:
    return [cell(F.col(lat)).alias("zone_lat"), cell(F.col(lon)).alias("zone_lon")]


def has_place(lat: str = "lat", lon: str = "lon") -> Column:
    """Plain NULL tests, which reach the Parquet scan (``dropna`` becomes a predicate that does not)."""
    return F.col(lat).isNotNull() & F.col(lon).isNotNull()


def on_sphere(lat: Column, lon: Column, radius: float) -> dict[str, Column]:
    """Cartesian position: y through the north pole, x and z around the equator."""
    polar = F.radians(F.lit(90.0) - lat)
    around = F.radians(lon + F.lit(180.0))
    r = F.lit(radius)
    return {
        "x": -r * F.sin(polar) * F.cos(around),
        "y": r * F.cos(polar),
        "z": r * F.sin(polar) * F.sin(around),
    }
