"""Raw feed records -> typed observations, with a reason for every record left out.

``*_candidates`` types a record and names the first rule it breaks in
``reject_reason`` (NULL: accepted). ``accepted`` and ``rejected`` split the two
sides of the same projection, so nothing is lost silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import padded
from ..functions.encode import evaluated_once
from ..schemas import AIR, AIR_UNIT, FIRE, QUAKE
from ..sources.dimensions import name_ids

REASON = "reject_reason"
CORRUPT = "_corrupt_record"


def _text(name: str, default: str) -> Column:
    return F.coalesce(F.col(name), F.lit(default))


def _number(name: str) -> Column:
    return F.col(name).try_cast("double")


def _whole(name: str) -> Column:
    """An integer with default 0: a missing field counts as 0, an unreadable one stays NULL."""
    return F.when(F.col(name).isNull(), F.lit(0)).otherwise(_number(name).try_cast("int"))


def _malformed(raw: DataFrame) -> Column:
    return F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)


def _first_reason(*rules: tuple[Column, str]) -> Column:
    return F.coalesce(*(F.when(broken, reason) for broken, reason in rules)).alias(REASON)


def _any_null(*columns: Column) -> Column:
    verdict = F.lit(False)
    for column in columns:
        verdict = verdict | column.isNull()
    return verdict


def _judged(raw: DataFrame, *columns: Column) -> DataFrame:
    return raw.select(evaluated_once(*columns))


def quake_candidates(raw: DataFrame, ingested_at: str) -> DataFrame:
    place = F.col("geometry.coordinates")
    mag = _number("properties.mag")
    time_ms = F.col("properties.time").try_cast("bigint")
    lon, lat, depth = (F.get(place, i).try_cast("double") for i in range(3))
    tsunami, sig = _whole("properties.tsunami"), _whole("properties.sig")
    return _judged(
        raw,
        F.col("id"),
        mag.alias("mag"),
        _text("properties.place", "").alias("place"),
        time_ms.alias("time_ms"),
        lon.alias("lon"),
        lat.alias("lat"),
        depth.alias("depth_km"),
        F.col("properties.alert").alias("alert"),
        tsunami.alias("tsunami"),
        sig.alias("sig"),
        _text("properties.status", "automatic").alias("status"),
        _text("properties.magType", "").alias("mag_type"),
        _text("properties.net", "us").alias("net"),
        F.lit(ingested_at).alias("ingested_at"),
        _first_reason(
            (_malformed(raw), "malformed"),
            (F.coalesce(F.col("id"), F.lit("")) == "", "no_id"),
            (F.col("properties.mag").isNull(), "no_magnitude"),
            (_any_null(mag, time_ms, lon, lat, depth, tsunami, sig), "unparsable"),
        ),
    )


def fire_candidates(raw: DataFrame, ingested_at: str) -> DataFrame:
    confidence = F.lower(_text("confidence", "nominal"))
    numbers = {
        "lat": _number("latitude"),
        "lon": _number("longitude"),
        "brightness": _number("bright_ti4"),
        "frp": _number("frp"),
        "scan": _number("scan"),
        "track": _number("track"),
    }
    texts = [F.col(c) for c in ("acq_date", "acq_time", "satellite", "daynight")]
    return _judged(
        raw,
        *(numbers[c].alias(c) for c in ("lat", "lon", "brightness", "frp")),
        confidence.alias("confidence"),
        F.col("acq_date"),
        padded(F.col("acq_time")).alias("acq_time"),
        F.col("satellite"),
        F.col("daynight"),
        *(numbers[c].alias(c) for c in ("scan", "track")),
        F.lit(ingested_at).alias("ingested_at"),
        _first_reason(
            (_malformed(raw), "malformed"),
            (confidence == "low", "low_confidence"),
            (_any_null(*numbers.values(), *texts), "unparsable"),
        ),
    )


def air_candidates(raw: DataFrame, ingested_at: str) -> DataFrame:
    named = name_ids(raw)
    value, lat, lon = _number("value"), _number("coordinates.latitude"), _number("coordinates.longitude")
    measured_at = F.col("datetime.utc")
    return _judged(
        named,
        _text("locationsId", "").alias("location_id"),
        _text("sensorsId", "unknown").alias("sensor_id"),
        F.col("parameter"),
        value.alias("value"),
        F.lit(AIR_UNIT).alias("unit"),
        lat.alias("lat"),
        lon.alias("lon"),
        F.col("country"),
        measured_at.alias("measured_at"),
        F.lit(ingested_at).alias("ingested_at"),
        _first_reason(
            (_malformed(raw), "malformed"),
            (F.col("value").isNull(), "no_value"),
            (value < 0, "negative_value"),
            (_any_null(F.col("coordinates.latitude"), F.col("coordinates.longitude")), "no_position"),
            (F.coalesce(measured_at, F.lit("")) == "", "no_time"),
            (_any_null(value, lat, lon), "unparsable"),
        ),
    )


CANDIDATES = {"earthquakes": quake_candidates, "wildfires": fire_candidates, "pollution": air_candidates}
_COLUMNS = {"earthquakes": QUAKE.names, "wildfires": FIRE.names, "pollution": AIR.names}


def accepted(candidates: DataFrame, kind: str) -> DataFrame:
    return candidates.filter(F.col(REASON).isNull()).select(*_COLUMNS[kind])


def rejected(candidates: DataFrame) -> DataFrame:
    return candidates.filter(F.col(REASON).isNotNull())


def normalize(raw: DataFrame, kind: str, ingested_at: str) -> DataFrame:
    return accepted(CANDIDATES[kind](raw, ingested_at), kind)


def ingest_stats(candidates: dict[str, DataFrame]) -> DataFrame:
    """Per feed: records seen, records sent on, records rejected. One pass per feed, one row out."""
    parts = [
        c.select(F.lit(kind).alias("source"), F.col(REASON)) for kind, c in candidates.items()
    ]
    tagged = parts[0]
    for part in parts[1:]:
        tagged = tagged.unionAll(part)
    return tagged.groupBy("source").agg(
        F.count("*").alias("total_features"),
        F.count_if(F.col(REASON).isNull()).alias("sent"),
        F.count(REASON).alias("rejected"),
    )
