"""The parameterised queries that maps and dashboards ask."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import moment, seconds_text, since, utc_now
from .dedup import first_per_key, first_per_key_salted
from .ranking import positions

# Result limits.
QUAKE_ROWS, FIRE_ROWS, AIR_ROWS, ZONE_ROWS, SNAPSHOT_ROWS = 500, 1000, 500, 200, 200
PULL_ROWS = {"earthquakes": 50, "wildfires": 100, "pollution": 100}
SOURCE_ROWS = 100

_COLUMNS = {
    "earthquakes": ("id", "mag", "place", "lat", "lon", "depth_km", "alert", "tsunami", "sig", "status"),
    "wildfires": ("lat", "lon", "brightness", "frp", "confidence", "satellite", "daynight"),
    "pollution": ("location_id", "parameter", "value", "lat", "lon", "country"),
}


def _ties(columns: tuple[str, ...]) -> list[Column]:
    return [F.asc_nulls_last(c) for c in columns]


def _shown(rows: DataFrame, columns: tuple[str, ...], time: str = "event_time") -> DataFrame:
    return rows.select(*columns, seconds_text(F.col(time)).alias(time))


def recent_quakes(
    quakes: DataFrame, as_of: datetime | None = None, hours: float = 24, min_mag: float = 0.0, limit: int = QUAKE_ROWS
) -> DataFrame:
    """Newest first."""
    rows = since(quakes, as_of, hours=hours).filter(F.col("mag") >= min_mag)
    return _shown(rows.orderBy(F.desc("event_time"), "id").limit(limit), _COLUMNS["earthquakes"])


def snapshot_quakes(
    quakes: DataFrame, as_of: datetime | None = None, hours: float = 24, limit: int = SNAPSHOT_ROWS
) -> DataFrame:
    """What a client sees on connecting: the newest quakes of any magnitude."""
    rows = since(quakes, as_of, hours=hours).orderBy(F.desc("event_time"), "id").limit(limit)
    return _shown(rows, _COLUMNS["earthquakes"][:7])


def active_fires(
    fires: DataFrame, as_of: datetime | None = None, hours: float = 24, limit: int = FIRE_ROWS
) -> DataFrame:
    """Strongest first; equal strength goes to the newer, then to the position."""
    columns = _COLUMNS["wildfires"]
    rows = since(fires, as_of, hours=hours)
    return _shown(rows.orderBy(F.desc("frp"), F.desc("event_time"), *_ties(columns)).limit(limit), columns)


def latest_air(
    air: DataFrame, as_of: datetime | None = None, parameter: str = "pm25", hours: float = 48, limit: int = AIR_ROWS
) -> DataFrame:
    """Highest values first; each station reading with the last time it was seen at that value."""
    columns = _COLUMNS["pollution"]
    seen = since(air, as_of, hours=hours).filter(F.col("parameter") == parameter)
    grouped = seen.groupBy(*columns).agg(F.max("event_time").alias("event_time"))
    ranked = grouped.orderBy(F.desc("value"), F.desc("event_time"), *_ties(columns)).limit(limit)
    return _shown(ranked, columns)


def latest_air_per_station(air: DataFrame, as_of: datetime | None = None, hours: float = 48) -> DataFrame:
    """The newest reading of every station and parameter."""
    columns = _COLUMNS["pollution"]
    recent = since(air, as_of, hours=hours).select(*columns, "event_time")
    order = [F.desc("event_time"), F.desc("value"), *_ties(("lat", "lon"))]
    return _shown(first_per_key(recent, ["location_id", "parameter"], order), columns)


def top_risk_zones(mart: DataFrame, limit: int = ZONE_ROWS) -> DataFrame:
    """By capped score; the many ties at the cap are settled by the raw score, then the cell."""
    order = [F.desc("risk_score_pct"), F.desc("raw_risk_score"), F.asc("zone_lat"), F.asc("zone_lon")]
    columns = (
        "zone_lat", "zone_lon", "eq_count", "max_mag", "fire_count", "max_frp", "avg_pm25",
        "risk_score_pct", "risk_level",
    )
    return _shown(mart.orderBy(*order).limit(limit), columns, "last_activity")


def global_stats(
    quakes: DataFrame, fires: DataFrame, air: DataFrame, as_of: datetime | None = None, hours: float = 24
) -> DataFrame:
    """Four scalars and the time they hold for, in one row and one aggregate: each task sends a single partial row."""
    def part(df: DataFrame, kind: str, mag: Column) -> DataFrame:
        return since(df, as_of, hours=hours).select(F.lit(kind).alias("kind"), mag.alias("mag"))

    none = F.lit(None).cast("double")
    stacked = (
        part(quakes, "quake", F.col("mag")).unionAll(part(fires, "fire", none)).unionAll(part(air, "air", none))
    )
    return stacked.agg(
        F.count_if(F.col("kind") == "quake").alias("earthquakes_24h"),
        F.count_if(F.col("kind") == "fire").alias("wildfires_24h"),
        F.count_if(F.col("kind") == "air").alias("pollution_24h"),
        F.max("mag").alias("max_mag_24h"),
        seconds_text(moment(as_of or utc_now())).alias("timestamp"),
    )


def pull_since(
    events: DataFrame, kind: str, last: datetime, limit: int | None = None, last_key: tuple | None = None
) -> DataFrame:
    """The next rows after a cursor, oldest first, with a typed ``event_time`` for the next cursor.

    With ``last_key`` (the shown columns of the last row already sent, after the
    time) the cursor is compound: rows that share the last time are not skipped.
    """
    columns = _COLUMNS[kind]
    edge = moment(last, dict(events.dtypes)["event_time"])
    newer = F.col("event_time") > edge
    if last_key is not None:
        kinds = dict(events.dtypes)
        here = F.struct(*(part for c in columns for part in _comparable(F.col(c), kinds[c])))
        there = F.struct(*(part for c, v in zip(columns, last_key) for part in _comparable(F.lit(v).cast(kinds[c]), kinds[c])))
        newer = newer | ((F.col("event_time") == edge) & (here > there))
    rows = events.filter(newer)
    if "event_date" in events.columns:
        rows = rows.filter(F.col("event_date") >= F.lit(last.date()))
    order = [F.asc("event_time"), *(F.asc(c) for c in columns)]
    return rows.orderBy(*order).limit(limit or PULL_ROWS[kind]).select(*columns, "event_time")


def pages(events: DataFrame, kind: str, limit: int | None = None) -> DataFrame:
    """The whole table in the pages that ``pull_since`` gives one after the other, numbered from 0.

    Read at once by many tasks, so a table is pulled to its end in a fixed number of jobs.
    """
    columns = _COLUMNS[kind]
    placed = positions(events.select(*columns, "event_time"), [F.asc("event_time"), *(F.asc(c) for c in columns)])
    return placed.withColumn("page", F.expr(f"position DIV {limit or PULL_ROWS[kind]}")).drop("position")


def _comparable(value: Column, kind: str) -> tuple[Column, Column]:
    """A value and whether it is there, so that comparing never yields NULL and missing values come first."""
    return value.isNotNull(), F.coalesce(value, F.lit("" if kind == "string" else 0).cast(kind))


Cursor = tuple[datetime, tuple | None]


def next_cursor(pulled: DataFrame, kind: str, last: datetime, last_key: tuple | None = None) -> Cursor:
    """Time and key of the last row of a pull, where the next one goes on; unchanged when nothing came.

    With both, rows that share the last time are sent by the next pull, however many they are.
    """
    columns = _COLUMNS[kind]
    row = pulled.orderBy(F.desc("event_time"), *(F.desc(c) for c in columns)).first()
    return (row["event_time"], tuple(row[c] for c in columns)) if row else (last, last_key)


def event_feed(
    quakes: DataFrame, fires: DataFrame, air: DataFrame, cursors: dict[str, datetime | Cursor],
    limits: dict[str, int] | None = None,
) -> DataFrame:
    """New events of all three kinds as one feed; ``_type`` says which columns are filled.

    A cursor is a time, or what ``next_cursor`` returned.
    """
    tables = {"earthquakes": quakes, "wildfires": fires, "pollution": air}
    tags = {"earthquakes": "earthquake", "wildfires": "wildfire", "pollution": "pollution"}
    feed = None
    for kind, events in tables.items():
        last, key = cursors[kind] if isinstance(cursors[kind], tuple) else (cursors[kind], None)
        pulled = pull_since(events, kind, last, (limits or PULL_ROWS)[kind], key)
        part = pulled.withColumn("event_time", seconds_text(F.col("event_time"))).withColumn("_type", F.lit(tags[kind]))
        feed = part if feed is None else feed.unionByName(part, allowMissingColumns=True)
    return feed


def latest_per_request(air: DataFrame, n: int = SOURCE_ROWS) -> DataFrame:
    """What the air service returns: the newest ``n`` readings per country and parameter."""
    columns = (*_COLUMNS["pollution"], "sensor_id")
    order = [F.desc("event_time"), *_ties(("location_id", "sensor_id", "value", "lat", "lon"))]
    return _shown(first_per_key_salted(air, ["country", "parameter"], order, n), columns)
