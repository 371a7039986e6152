"""Per-zone model inputs and labels, read from the base tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import hours_between, moment, since, utc_now
from ..functions.grid import has_place, zone_columns
from ..schemas import FEATURES, LABEL, ZONE

FEATURE_DAYS = 7
AIR_HOURS = 48
LABEL_HOURS = 24
# What counts as a significant event.
STRONG_MAG = 4.0
STRONG_FRP = 100.0

def _is_shallow() -> Column:
    return F.col("depth_km") < 20


def _placed(df: DataFrame) -> DataFrame:
    return df.filter(has_place())


def _of(parameter: str) -> Column:
    return F.when(F.col("parameter") == parameter, F.col("value"))


def quake_features(quakes: DataFrame, as_of: datetime | None = None, days: float = FEATURE_DAYS) -> DataFrame:
    at = as_of or utc_now()
    rows = since(_placed(quakes), at, days=days).select(*zone_columns(), "mag", "depth_km", "event_time")
    return rows.groupBy(*ZONE).agg(
        F.count("*").alias("eq_count_7d"),
        F.max("mag").alias("max_mag_7d"),
        F.avg("mag").alias("avg_mag_7d"),
        (F.count_if(_is_shallow()) / F.count("*")).alias("shallow_eq_ratio"),
        hours_between(F.max("event_time"), moment(at)).alias("hours_since_last_eq"),
    )


def fire_features(fires: DataFrame, as_of: datetime | None = None, days: float = FEATURE_DAYS) -> DataFrame:
    rows = since(_placed(fires), as_of, days=days).select(*zone_columns(), "frp")
    return rows.groupBy(*ZONE).agg(
        F.count("*").alias("fire_count_7d"), F.max("frp").alias("max_frp_7d"), F.avg("frp").alias("avg_frp_7d")
    )


def air_features(air: DataFrame, as_of: datetime | None = None, hours: float = AIR_HOURS) -> DataFrame:
    rows = since(_placed(air), as_of, hours=hours).select(*zone_columns(), "parameter", "value")
    return rows.groupBy(*ZONE).agg(
        F.avg(_of("pm25")).alias("avg_pm25_48h"),
        F.max(_of("pm25")).alias("max_pm25_48h"),
        F.avg(_of("no2")).alias("avg_no2_48h"),
    )


def label_zones(
    quakes: DataFrame, fires: DataFrame, as_of: datetime | None = None, hours: float = LABEL_HOURS
) -> DataFrame:
    """Zones with a strong quake or fire in the label horizon, each once."""
    strong_quakes = since(_placed(quakes), as_of, hours=hours).filter(F.col("mag") >= STRONG_MAG)
    strong_fires = since(_placed(fires), as_of, hours=hours).filter(F.col("frp") > STRONG_FRP)
    zones = strong_quakes.select(*zone_columns()).unionAll(strong_fires.select(*zone_columns()))
    return zones.distinct().withColumn(LABEL, F.lit(1))


def _as_model_input(zones: DataFrame, *extra: str) -> DataFrame:
    filled = zones.withColumn("abs_lat", F.abs("zone_lat")).na.fill(0)
    return filled.select(*FEATURES, *extra)


def zone_features_joined(
    quakes: DataFrame, fires: DataFrame, air: DataFrame, as_of: datetime | None = None
) -> DataFrame:
    """The feature table by left joins from the quake zones."""
    at = as_of or utc_now()
    zones = (
        quake_features(quakes, at)
        .join(fire_features(fires, at), list(ZONE), "left")
        .join(air_features(air, at), list(ZONE), "left")
    )
    return _as_model_input(zones)


def training_set(
    quakes: DataFrame,
    fires: DataFrame,
    air: DataFrame,
    as_of: datetime | None = None,
    label_hours: float = LABEL_HOURS,
) -> DataFrame:
    """Features and label of every zone that had a quake, in one pass.

    Only zones with quakes are kept, so left joins from the quake zones equal one
    grouping of the stacked sources followed by ``eq_count > 0``: one shuffle of
    partial aggregates instead of four shuffles and three joins.
    """
    if label_hours > FEATURE_DAYS * 24:
        raise ValueError("the label horizon must lie within the feature horizon")
    at = as_of or utc_now()
    none = F.lit(None).cast("double")

    def part(df: DataFrame, span: dict[str, float], strong: Column, **measures: Column) -> DataFrame:
        names = ("mag", "depth_km", "frp", "pm25", "no2")
        recent = F.col("event_time") >= moment(at - timedelta(hours=label_hours), dict(df.dtypes)["event_time"])
        rows = since(_placed(df), at, **span)
        return rows.select(
            *zone_columns(),
            *(measures.get(n, none).alias(n) for n in names),
            measures.get("quake_time", F.lit(None).cast("timestamp_ntz")).alias("quake_time"),
            measures.get("is_fire", F.lit(False)).alias("is_fire"),
            F.coalesce(strong & recent, F.lit(False)).alias("strong"),
        )

    week = {"days": FEATURE_DAYS}
    stacked = (
        part(
            quakes, week, F.col("mag") >= STRONG_MAG,
            mag=F.col("mag"), depth_km=F.col("depth_km"), quake_time=F.col("event_time"),
        )
        .unionAll(part(fires, week, F.col("frp") > STRONG_FRP, frp=F.col("frp"), is_fire=F.lit(True)))
        .unionAll(part(air, {"hours": AIR_HOURS}, F.lit(False), pm25=_of("pm25"), no2=_of("no2")))
    )
    quake_count = F.count("quake_time")
    zones = stacked.groupBy(*ZONE).agg(
        quake_count.alias("eq_count_7d"),
        F.max("mag").alias("max_mag_7d"),
        F.avg("mag").alias("avg_mag_7d"),
        F.try_divide(F.count_if(_is_shallow()), quake_count).alias("shallow_eq_ratio"),
        hours_between(F.max("quake_time"), moment(at)).alias("hours_since_last_eq"),
        F.count_if("is_fire").alias("fire_count_7d"),
        F.max("frp").alias("max_frp_7d"),
        F.avg("frp").alias("avg_frp_7d"),
        F.avg("pm25").alias("avg_pm25_48h"),
        F.max("pm25").alias("max_pm25_48h"),
        F.avg("no2").alias("avg_no2_48h"),
        F.max(F.col("strong").cast("int")).alias(LABEL),
    )
    return _as_model_input(zones.filter(F.col("eq_count_7d") > 0), LABEL)


def zone_features(
    quakes: DataFrame, fires: DataFrame, air: DataFrame, as_of: datetime | None = None
) -> DataFrame:
    """The inputs alone, as the explanation job reads them; the unused label is pruned away."""
    return training_set(quakes, fires, air, as_of).select(*FEATURES)


def training_set_joined(
    quakes: DataFrame,
    fires: DataFrame,
    air: DataFrame,
    as_of: datetime | None = None,
    label_hours: float = LABEL_HOURS,
) -> DataFrame:
    """The training set by left joins; unlabelled zones are negatives."""
    at = as_of or utc_now()
    features = zone_features_joined(quakes, fires, air, at)
    labelled = features.join(label_zones(quakes, fires, at, label_hours), list(ZONE), "left")
    return labelled.withColumn(LABEL, F.coalesce(F.col(LABEL), F.lit(0))).select(*FEATURES, LABEL)


def label_distribution(rows: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows per label, and the share of positives in the whole table, in one pass."""
    totals = rows.agg(
        F.count("*").alias("n"), F.sum(F.col(label)).alias("positives")
    )
    per_label = F.array(
        F.struct(F.lit(0).alias("label"), (F.col("n") - F.col("positives")).alias("zones")),
        F.struct(F.lit(1).alias("label"), F.col("positives").alias("zones")),
    )
    unfolded = totals.select(F.try_divide("positives", "n").alias("positive_rate"), F.inline(per_label))
    return unfolded.filter(F.col("zones") > 0).select("label", "zones", "positive_rate")


def class_weight(rows: DataFrame, label: str = LABEL) -> DataFrame:
    """Negatives per positive; 1 when there are no positives."""
    negatives, positives = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    ratio = F.when(positives > 0, F.try_divide(negatives, positives)).otherwise(F.lit(1.0))
    return rows.agg(negatives.alias("negatives"), positives.alias("positives"), ratio.alias("scale_pos_weight"))
