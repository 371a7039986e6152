"""Zone activity from sums of whole days: what an hourly run reads does not grow with a day's rows.

A zone's day is a row of counts, sums, maxima and the last time, which merge by adding and by
taking the larger. Closed days are stored, a folder each; a look back of seven days reads the
days in between from there, and rows only of the day the horizon falls into and of the current one.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import since, utc_now
from ..functions.grid import zone_columns
from ..schemas import ZONE
from .zones import HORIZON_DAYS, finish

_SUMS = ("eq_count", "n_mag", "sum_mag", "fire_count", "n_frp", "sum_frp", "n_pm25", "sum_pm25", "n_no2", "sum_no2")
_LARGEST = ("max_mag", "max_frp", "max_pm25", "last_activity")
_VALUES = {"mag": "quake", "frp": "fire", "pm25": "air", "no2": "air"}


def _stacked(quakes: DataFrame, fires: DataFrame, air: DataFrame) -> DataFrame:
    own = {"quake": quakes, "fire": fires, "air": air}
    parts = []
    for source, rows in own.items():
        values = [(F.col(v) if s == source else F.lit(None).cast("double")).alias(v) for v, s in _VALUES.items()]
        parts.append(rows.select(F.to_date("event_time").alias("day"), *zone_columns(), "event_time", F.lit(source).alias("source"), *values))
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def _partial(rows: DataFrame, *keys: str) -> DataFrame:
    counted: list[Column] = [F.count_if(F.col("source") == s).alias(c) for s, c in (("quake", "eq_count"), ("fire", "fire_count"))]
    for value in _VALUES:
        counted += [F.count(value).alias(f"n_{value}"), F.sum(value).alias(f"sum_{value}"), F.max(value).alias(f"max_{value}")]
    return rows.groupBy(*keys).agg(*counted, F.max("event_time").alias("last_activity")).select(*keys, *_SUMS, *_LARGEST)


def zone_days(quakes: DataFrame, fires: DataFrame, air: DataFrame) -> DataFrame:
    """A row for each day and zone of the staged tables."""
    return _partial(_stacked(quakes, fires, air), "day", *ZONE)


def store_days(days: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder for each day; days that are written again are replaced, others stay."""
    writer = days.hint("rebalance", F.col("day")).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day").parquet(path)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    sums = ", ".join(f"{c} {'double' if c.startswith('sum_') else 'bigint'}" for c in _SUMS)
    schema = f"{', '.join(f'{z} double' for z in ZONE)}, {sums}, max_mag double, max_frp double, max_pm25 double"
    return spark.read.schema(f"{schema}, last_activity timestamp_ntz, day date").parquet(path)


def active_zones(
    days: DataFrame, quakes: DataFrame, fires: DataFrame, air: DataFrame, as_of: datetime | None = None,
    horizon: float = HORIZON_DAYS,
) -> DataFrame:
    """The same table as ``zones.active_zones``: stored days strictly between the horizon's day and that of ``as_of``."""
    now = as_of or utc_now()
    first, last = (now - timedelta(days=horizon)).date(), now.date()

    def edges(rows: DataFrame) -> DataFrame:
        kept = since(rows, now, days=horizon)
        if first >= last:
            return kept
        time, kind = F.col("event_time"), dict(rows.dtypes)["event_time"]
        next_day = F.lit(str(first + timedelta(days=1))).cast(kind)
        return kept.filter((time < next_day) | (time >= F.lit(str(last)).cast(kind)))

    between = days.filter((F.col("day") > F.lit(first)) & (F.col("day") < F.lit(last)))
    own = _partial(_stacked(*(edges(rows) for rows in (quakes, fires, air))), *ZONE)
    zone_free = F.col("last_activity").cast("timestamp_ntz").alias("last_activity")
    held = [*ZONE, *_SUMS, *(c for c in _LARGEST if c != "last_activity")]
    both = between.select(*held, zone_free).unionByName(own.select(*held, zone_free))
    merged = both.groupBy(*ZONE).agg(
        *(F.sum(c).alias(c) for c in _SUMS), *(F.max(c).alias(c) for c in _LARGEST)
    )
    means = {f"avg_{v}": F.try_divide(F.col(f"sum_{v}"), F.col(f"n_{v}")) for v in _VALUES}
    return finish(merged.withColumns(means), F.col("last_activity"))
