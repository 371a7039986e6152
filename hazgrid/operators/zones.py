"""Activity per one-degree cell, from the three staged tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import since
from ..functions.grid import zone_columns
from ..schemas import ZONE

HORIZON_DAYS = 7
EPOCH = "1970-01-01 00:00:00"


def quake_zones(quakes: DataFrame, as_of: datetime | None = None, days: float = HORIZON_DAYS) -> DataFrame:
    rows = since(quakes, as_of, days=days).select(*zone_columns(), "mag", "event_time")
    return rows.groupBy(*ZONE).agg(
        F.count("*").alias("eq_count"),
        F.max("mag").alias("max_mag"),
        F.avg("mag").alias("avg_mag"),
        F.max("event_time").alias("last_eq_time"),
    )


def fire_zones(fires: DataFrame, as_of: datetime | None = None, days: float = HORIZON_DAYS) -> DataFrame:
    rows = since(fires, as_of, days=days).select(*zone_columns(), "frp", "event_time")
    return rows.groupBy(*ZONE).agg(
        F.count("*").alias("fire_count"),
        F.max("frp").alias("max_frp"),
        F.avg("frp").alias("avg_frp"),
        F.max("event_time").alias("last_fire_time"),
    )


def air_zones(air: DataFrame, as_of: datetime | None = None, days: float = HORIZON_DAYS) -> DataFrame:
    """Averages skip the empty cells of the wide form; a cell with ozone only is still a zone."""
    rows = since(air, as_of, days=days).select(*zone_columns(), "pm25", "no2", "event_time")
    return rows.groupBy(*ZONE).agg(
        F.avg("pm25").alias("avg_pm25"),
        F.max("pm25").alias("max_pm25"),
        F.avg("no2").alias("avg_no2"),
        F.max("event_time").alias("last_pol_time"),
    )


def raw_risk_score(max_mag: Column, max_frp: Column, max_pm25: Column) -> Column:
    return max_mag * F.lit(10.0) + max_frp / F.lit(100.0) + max_pm25 / F.lit(10.0)


_MEASURES = ("max_mag", "avg_mag", "max_frp", "avg_frp", "avg_pm25", "max_pm25", "avg_no2")


def finish(zones: DataFrame, last_activity: Column) -> DataFrame:
    """Zeros for what a zone has none of, and the composite score."""
    zero = {m: F.coalesce(F.col(m), F.lit(0.0)) for m in _MEASURES}
    count = {c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in ("eq_count", "fire_count")}
    return zones.select(
        *ZONE,
        count["eq_count"].alias("eq_count"),
        zero["max_mag"].alias("max_mag"),
        zero["avg_mag"].alias("avg_mag"),
        count["fire_count"].alias("fire_count"),
        zero["max_frp"].alias("max_frp"),
        zero["avg_frp"].alias("avg_frp"),
        zero["avg_pm25"].alias("avg_pm25"),
        zero["max_pm25"].alias("max_pm25"),
        zero["avg_no2"].alias("avg_no2"),
        raw_risk_score(zero["max_mag"], zero["max_frp"], zero["max_pm25"]).alias("raw_risk_score"),
        last_activity.alias("last_activity"),
    )


def active_zones(
    quakes: DataFrame, fires: DataFrame, air: DataFrame, as_of: datetime | None = None, days: float = HORIZON_DAYS
) -> DataFrame:
    """Every zone with any activity, in one pass: stack the three sources, then group once.

    Each source fills only its own measures, so one aggregate with map-side partial
    sums gives what three aggregates and two full outer joins would give, with one
    shuffle of at most one row per zone and task, and no hot zone.
    """
    def part(df: DataFrame, **measures: Column) -> DataFrame:
        empty = F.lit(None).cast("double")
        named = [measures.get(m, empty).alias(m) for m in ("mag", "frp", "pm25", "no2")]
        flags = [measures.get(m, F.lit(False)).alias(m) for m in ("is_quake", "is_fire")]
        return since(df, as_of, days=days).select(*zone_columns(), "event_time", *named, *flags)

    stacked = (
        part(quakes, mag=F.col("mag"), is_quake=F.lit(True))
        .unionAll(part(fires, frp=F.col("frp"), is_fire=F.lit(True)))
        .unionAll(part(air, pm25=F.col("pm25"), no2=F.col("no2")))
    )
    zones = stacked.groupBy(*ZONE).agg(
        F.count_if("is_quake").alias("eq_count"),
        F.max("mag").alias("max_mag"),
        F.avg("mag").alias("avg_mag"),
        F.count_if("is_fire").alias("fire_count"),
        F.max("frp").alias("max_frp"),
        F.avg("frp").alias("avg_frp"),
        F.avg("pm25").alias("avg_pm25"),
        F.max("pm25").alias("max_pm25"),
        F.avg("no2").alias("avg_no2"),
        F.max("event_time").alias("last_activity"),
    )
    return finish(zones, F.col("last_activity"))


def active_zones_joined(
    quakes: DataFrame, fires: DataFrame, air: DataFrame, as_of: datetime | None = None, days: float = HORIZON_DAYS
) -> DataFrame:
    """The same table by full outer joins of the three zone tables.

    USING joins coalesce the keys, so a zone known to one source only keeps its
    position. Each side is already grouped, hence unique and small per key.
    """
    zones = (
        quake_zones(quakes, as_of, days)
        .join(fire_zones(fires, as_of, days), list(ZONE), "full_outer")
        .join(air_zones(air, as_of, days), list(ZONE), "full_outer")
    )
    never = F.lit(EPOCH).cast("timestamp_ntz")
    times = [F.coalesce(F.col(c), never) for c in ("last_eq_time", "last_fire_time", "last_pol_time")]
    return finish(zones, F.greatest(*times))
