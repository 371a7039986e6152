"""Event times, horizons and hour differences."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def moment(at: datetime, dtype: str = "timestamp_ntz") -> Column:
    """A literal of the wanted timestamp type; folds to a constant, so filters on it push down."""
    return F.lit(at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(dtype)


def since(
    df: DataFrame, as_of: datetime | None, column: str = "event_time", strict: bool = False, **span: float
) -> DataFrame:
    """Rows from ``as_of - span`` on. On a date-partitioned table whole folders are pruned too."""
    start = (as_of or utc_now()) - timedelta(**span)
    edge = moment(start, dict(df.dtypes)[column])
    kept = df.filter(F.col(column) > edge if strict else F.col(column) >= edge)
    if "event_date" in df.columns and column == "event_time":
        kept = kept.filter(F.col("event_date") >= F.lit(start.date()))
    return kept


def hours_between(start: Column, end: Column) -> Column:
    """Number of full-hour marks crossed from ``start`` to ``end``: 10:59 -> 11:01 is one."""
    a, b = F.date_trunc("HOUR", start), F.date_trunc("HOUR", end)
    return F.timestamp_diff("HOUR", a, b)


def padded(clock_text: Column) -> Column:
    """At least four characters, zeros in front; longer text stays whole (``lpad`` would cut it)."""
    return F.when(F.length(clock_text) < 4, F.lpad(clock_text, 4, "0")).otherwise(clock_text)


def seconds_text(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss")


def iso_text(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")


def event_time(kind: str) -> Column:
    """When an observation happened, from the columns its stream carries. Unreadable -> NULL."""
    if kind == "earthquakes":
        return F.timestamp_millis(F.col("time_ms"))
    if kind == "wildfires":
        text = F.concat(F.col("acq_date"), F.lit(" "), padded(F.col("acq_time")))
        return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HHmm"))
    if kind == "pollution":
        return F.try_to_timestamp(F.col("measured_at"))
    raise ValueError(f"unknown kind: {kind}")


def with_event_time(df: DataFrame, kind: str, dtype: str = "timestamp") -> DataFrame:
    """The same derivation for files and for streams; batch tables keep it zone-free."""
    return df.withColumn("event_time", event_time(kind).cast(dtype))
