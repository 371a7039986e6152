"""The risk table that maps and services read."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import risk_level
from ..functions.clock import moment, since, utc_now
from .zones import HORIZON_DAYS


def risk_zones(zones: DataFrame, as_of: datetime | None = None, days: float = HORIZON_DAYS) -> DataFrame:
    """Zones still active, with a 0-100 score and a level. Sorting is left to the reader."""
    at = as_of or utc_now()
    score = F.col("raw_risk_score")
    percent = F.least(F.rint(score / F.lit(10.0) * F.lit(100.0)) + F.lit(0.0), F.lit(100.0))
    return since(zones, at, "last_activity", days=days).select(
        "zone_lat", "zone_lon", "eq_count", "max_mag", "fire_count", "max_frp", "avg_pm25", "max_pm25",
        "raw_risk_score", "last_activity",
        percent.alias("risk_score_pct"),
        risk_level(score).alias("risk_level"),
        moment(at).alias("computed_at"),
    )
