"""The three base tables, and the raw feeds before them, derived from an ``events`` table.

``events`` has (event_id, ts, user_id, event_type, value, props) with an integer ``k``
in ``props``. Positions, magnitudes and readings follow from these columns, so every
query grows with the table it reads.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.clock import hours_between, moment
from .functions.grid import has_place, zone_columns
from .schemas import AIR_UNIT, COUNTRIES, FEATURES, PARAMETERS, ZONE

INGESTED_AT = "2024-02-01T00:00:00+00:00"
EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


class BaseTables:
    """The three base tables and the time queries count back from, each made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def source(self) -> DataFrame:
        return events(self.spark, self.sf_dir)

    @cached_property
    def quakes(self) -> DataFrame:
        return quakes(self.source)

    @cached_property
    def fires(self) -> DataFrame:
        return fires(self.source)

    @cached_property
    def air(self) -> DataFrame:
        return air(self.source)

    @cached_property
    def as_of(self) -> datetime:
        """The newest event, resolved once so that horizons are literals; reads one column."""
        return self.source.agg(F.max("ts")).first()[0]


def base_tables(spark: SparkSession, sf_dir: str) -> BaseTables:
    return BaseTables(spark, sf_dir)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir.rstrip('/')}/events.parquet")


# Positions near the equator in tenths of a degree, with exact .5 ties and some missing latitudes.
_LAT = "CASE WHEN k <> 99 THEN CAST((u % 15) * 10 + (k % 10) - 75 AS DOUBLE) / 10D END AS lat"
_LON = "CAST(((u DIV 15) % 36) * 10 + (k DIV 10) - 55 AS DOUBLE) / 10D AS lon"
_STAMP = f"'{INGESTED_AT}' AS ingested_at"


def _keyed(source: DataFrame, types: str) -> DataFrame:
    """Events of some types with the integer ``k`` of their properties and ``u``, the user.

    ``k`` comes from a generator, so that conditions on what is derived from it do not parse
    the properties again; conditions on the stored columns still reach the scan.
    """
    wanted = source if types == "all" else source.filter(f"event_type IN ({types})")
    return wanted.selectExpr(
        "event_id", "ts", "event_type", "value", "user_id AS u",
        "explode(array(CAST(get_json_object(props, '$.k') AS INT))) AS k",
    )


def quakes(source: DataFrame) -> DataFrame:
    return _keyed(source, "'error'").selectExpr(
        "concat('ev', event_id) AS id",
        "least(value / 25D, 9.5D) - 0.5D AS mag",
        "concat('zone ', u) AS place",
        "unix_millis(CAST(ts AS TIMESTAMP)) AS time_ms",
        _LON,
        _LAT,
        "CAST(k * 3 AS DOUBLE) AS depth_km",
        "CASE k % 5 WHEN 0 THEN 'green' WHEN 1 THEN 'yellow' WHEN 2 THEN 'orange' WHEN 3 THEN 'red' END AS alert",
        "IF(k % 20 = 0, 1, 0) AS tsunami",
        "k * 10 AS sig",
        "IF(k % 2 = 0, 'reviewed', 'automatic') AS status",
        "'ml' AS mag_type",
        "CASE k % 3 WHEN 0 THEN 'us' WHEN 1 THEN 'ak' ELSE 'ci' END AS net",
        _STAMP,
        "ts AS event_time",
    )


def fires(source: DataFrame) -> DataFrame:
    return _keyed(source, "'view'").selectExpr(
        _LAT,
        _LON,
        "CAST(300 + k AS DOUBLE) AS brightness",
        "value * 5D AS frp",
        "CASE k % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'nominal' ELSE 'high' END AS confidence",
        "date_format(ts, 'yyyy-MM-dd') AS acq_date",
        "CAST(hour(ts) * 100 + minute(ts) AS STRING) AS acq_time",
        "IF(k % 2 = 0, 'N', 'T') AS satellite",
        "IF(hour(ts) BETWEEN 6 AND 17, 'D', 'N') AS daynight",
        "k / 100D AS scan",
        "k / 100D AS track",
        _STAMP,
        "ts AS event_time",
    )


def air(source: DataFrame) -> DataFrame:
    named = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(COUNTRIES.values()))
    return _keyed(source, "'purchase', 'signup', 'click'").selectExpr(
        "CAST(u AS STRING) AS location_id",
        "CAST(u * 3 + k % 3 AS STRING) AS sensor_id",
        "CASE event_type WHEN 'purchase' THEN 'pm25' WHEN 'signup' THEN 'no2' ELSE 'o3' END AS parameter",
        "value - 5D AS value",
        f"'{AIR_UNIT}' AS unit",
        _LAT,
        _LON,
        f"CASE u % 7 {named} END AS country",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS measured_at",
        _STAMP,
        "ts AS event_time",
    )


# Raw feeds: what the services deliver, flaws included, as landed text.


def raw_quakes(source: DataFrame) -> DataFrame:
    """Features with every flaw the feed can have, each on its own remainder of the number."""
    flawed = quakes(source).selectExpr("*", "CAST(substr(id, 3) AS BIGINT) % 20 AS flaw")
    return flawed.selectExpr(
        "IF(flaw = 0, NULL, id) AS id",
        """named_struct(
            'mag', CASE flaw WHEN 1 THEN NULL WHEN 2 THEN 'n/a' ELSE CAST(mag AS STRING) END,
            'place', IF(flaw = 3, NULL, place),
            'time', CAST(time_ms AS STRING),
            'alert', alert,
            'tsunami', IF(flaw = 4, NULL, CAST(tsunami AS STRING)),
            'sig', IF(flaw = 5, 'many', CAST(sig AS STRING)),
            'status', IF(flaw = 7, NULL, status),
            'magType', IF(flaw = 8, NULL, mag_type),
            'net', IF(flaw = 9, NULL, net)) AS properties""",
        """named_struct('coordinates', IF(flaw = 6,
            array(CAST(lon AS STRING), CAST(lat AS STRING)),
            array(CAST(lon AS STRING), CAST(lat AS STRING), CAST(depth_km AS STRING)))) AS geometry""",
    )


def raw_fires(source: DataFrame) -> DataFrame:
    """Delimited text: mixed-case confidence, sometimes missing, times without leading zeros."""
    flawed = fires(source).selectExpr("*", "CAST(track * 100 + 0.5D AS INT) AS k")
    return flawed.selectExpr(
        "CAST(lat AS STRING) AS latitude",
        "CAST(lon AS STRING) AS longitude",
        "IF(k = 50, 'hot', CAST(brightness AS STRING)) AS bright_ti4",
        "CAST(frp AS STRING) AS frp",
        "CASE WHEN k % 4 = 1 THEN upper(confidence) WHEN k % 10 <> 9 THEN confidence END AS confidence",
        "acq_date", "acq_time", "satellite", "daynight",
        "CAST(scan AS STRING) AS scan",
        "CAST(track AS STRING) AS track",
    )


def raw_air(source: DataFrame) -> DataFrame:
    """Results with optional nested objects, tagged with the ids of the request that returned them."""
    country_id = " ".join(f"WHEN '{name}' THEN {i}" for i, name in COUNTRIES.items())
    parameter_id = " ".join(f"WHEN '{name}' THEN {i}" for i, name in PARAMETERS.items())
    return air(source).selectExpr("*", "CAST(sensor_id AS BIGINT) AS s").selectExpr(
        "IF(s % 11 = 10, NULL, CAST(value AS STRING)) AS value",
        """IF(s % 13 = 12, NULL, named_struct('latitude', CAST(lat AS STRING), 'longitude', CAST(lon AS STRING)))
           AS coordinates""",
        "IF(s % 17 = 16, NULL, named_struct('utc', IF(s % 19 = 18, '', measured_at))) AS datetime",
        "IF(s % 23 = 22, NULL, sensor_id) AS sensorsId",
        "IF(s % 29 = 28, NULL, location_id) AS locationsId",
        f"CASE country {country_id} END AS country_id",
        f"CASE parameter {parameter_id} END AS parameter_id",
    )


RAW = {"earthquakes": raw_quakes, "wildfires": raw_fires, "pollution": raw_air}


# Scored tables for the measures and for the prediction store.


def scored(source: DataFrame) -> DataFrame:
    """A label and a score with many ties."""
    return source.selectExpr("IF(event_type = 'error', 1, 0) AS label", "CAST(floor(value) AS DOUBLE) AS score")


def scored_with_gaps(source: DataFrame) -> DataFrame:
    """The same with scores that are missing or not a number."""
    score = "CASE WHEN user_id % 7 = 0 THEN NULL WHEN user_id % 11 = 0 THEN DOUBLE('NaN') ELSE floor(value) END"
    return source.selectExpr("IF(event_type = 'error', 1, 0) AS label", f"CAST({score} AS DOUBLE) AS score")


def deliveries(rows: DataFrame, without_first: str, **replaced: str) -> DataFrame:
    """Three deliveries of every row, the last first; those that ``without_first`` holds for miss the earliest.

    ``replaced`` are SQL expressions for columns, to take out parts of a key.
    """
    rows = rows.withColumns({c: F.expr(e) for c, e in replaced.items()})
    each = rows.withColumn("_copy", F.explode(F.array(*map(F.lit, (2, 0, 1)))))
    kept = each.filter(f"NOT (_copy = 0 AND coalesce({without_first}, false))")
    return kept.withColumn("ingested_at", F.format_string("2024-02-01T%02d:00:00+00:00", "_copy")).drop("_copy")


def prediction_runs(source: DataFrame) -> DataFrame:
    """Scores of zones over time: many rows per zone, one per event."""
    placed = _keyed(source, "all").selectExpr("ts", "value", _LAT, _LON).filter(has_place())
    return placed.select(
        *zone_columns(),
        F.expr("least(value / 100D, 1D) AS ml_risk_score"),
        F.expr("date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") AS predicted_at"),
    )


def driver_rows(source: DataFrame, as_of: datetime) -> DataFrame:
    """A zone and a signed value per model input for each quake, standing in for attributions."""
    table = quakes(source).filter(has_place())
    values = {
        "abs_lat": -F.abs("lat"),
        "max_mag_7d": F.col("mag") * 3,
        "shallow_eq_ratio": F.col("depth_km") / F.lit(-30.0),
        "hours_since_last_eq": hours_between(F.col("event_time"), moment(as_of)) / F.lit(100.0),
    }
    columns = [values.get(f, F.lit(0.0)).cast("double").alias(f) for f in FEATURES if f not in ZONE]
    return table.select("id", *zone_columns(), *columns)
