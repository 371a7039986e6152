"""Every named query over the ``events``-derived tables: name -> (spark, folder) -> DataFrame.

Averages, ratios and trigonometric values are rounded to six digits here, at the
edge, because their last bits depend on the order of summation. The operators
themselves return them unrounded.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import fixtures
from .fixtures import BaseTables, base_tables
from .functions.classify import risk_label
from .functions.clock import moment, with_event_time
from .functions.encode import envelope, tsv_line
from .ml import explain, model
from .operators import attribution, dedup, features, markers, metrics, normalize, profile, rollup, serving, split, zones
from .operators.staging import stage_air, stage_fires, stage_quakes
from .plans import layers
from .schemas import FEATURES, KINDS, LABEL, NATURAL_KEY, STREAM_SCHEMA, ZONE
from .session import scratch_path, settled, use_utc
from .sinks import tables, topics
from .sources import dimensions, landing
from .streaming import jobs
from .streaming import topics as messages

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 6
_QUERIES: dict[str, Query] = {}


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), DIGITS) for c in columns})


def _real_integers(df: DataFrame) -> DataFrame:
    """Integers that may be missing as doubles: data frames of other engines have no common type for them."""
    return df.withColumns({c: F.col(c).cast("double") for c in ("time_ms", "tsunami", "sig") if c in df.columns})


def _query(build: Callable) -> Callable:
    """Register a query that needs the base tables."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return build(base_tables(spark, sf_dir))

    _QUERIES[build.__name__] = run
    return build


def _events_query(build: Callable) -> Callable:
    """Register a query that reads the events directly and needs no horizon."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return build(fixtures.events(spark, sf_dir))

    _QUERIES[build.__name__] = run
    return build


def _base(t: BaseTables) -> tuple[DataFrame, DataFrame, DataFrame]:
    return t.quakes, t.fires, t.air


def _staged(t: BaseTables) -> tuple[DataFrame, DataFrame, DataFrame]:
    return layers.staged(*_base(t))


# Normalising raw feeds


@_events_query
def normalize_quakes(events):
    return normalize.normalize(fixtures.raw_quakes(events), "earthquakes", fixtures.INGESTED_AT)


@_events_query
def normalize_fires(events):
    return normalize.normalize(fixtures.raw_fires(events), "wildfires", fixtures.INGESTED_AT)


@_events_query
def normalize_air(events):
    return normalize.normalize(fixtures.raw_air(events), "pollution", fixtures.INGESTED_AT)


# The same through landing files that Spark writes from the raw feeds


@_events_query
def landed_quakes(events):
    raw = landing.quake_files(events.sparkSession, _quake_documents(events), one_per_line=True)
    return normalize.normalize(raw, "earthquakes", fixtures.INGESTED_AT)


PER_DOCUMENT = 25


def _documents(rows: DataFrame, items: str, *keep: str) -> DataFrame:
    """Rows gathered into documents of some observations each."""
    item = F.struct(*(c for c in rows.columns if c not in keep)).alias("item")
    numbered = rows.select(*keep, F.expr(f"monotonically_increasing_id() DIV {PER_DOCUMENT}").alias("document"), item)
    return numbered.groupBy(*keep, "document").agg(F.collect_list("item").alias(items)).drop("document")


def _quake_documents(events: DataFrame) -> str:
    path = scratch_path(events.sparkSession, "landing-quakes")
    _documents(fixtures.raw_quakes(events), "features").write.json(path)
    return path


@_events_query
def landed_rejects(events):
    """Rejected quake records per reason, read from documents of which some are cut off."""
    path = _quake_documents(events)
    broken = events.filter("event_type = 'error' AND event_id % 40 = 0")
    broken.select(F.format_string('{"features": [{"id": "ev%s", ', "event_id").alias("value")).write.mode("append").text(path)
    raw = landing.quake_files(events.sparkSession, path, one_per_line=True)
    candidates = normalize.CANDIDATES["earthquakes"](raw, fixtures.INGESTED_AT)
    return normalize.rejected(candidates).groupBy(normalize.REASON).agg(F.count("*").alias("records"))


@_events_query
def landed_fires(events):
    path = scratch_path(events.sparkSession, "landing-fires")
    fixtures.raw_fires(events).write.option("header", True).csv(path)
    return normalize.normalize(landing.fire_files(events.sparkSession, path), "wildfires", fixtures.INGESTED_AT)


@_events_query
def landed_air(events):
    path = scratch_path(events.sparkSession, "landing-air")
    ids = ["country_id", "parameter_id"]
    feed = fixtures.raw_air(events)
    _documents(feed, "results", *ids).write.partitionBy(*ids).json(path)
    raw = landing.air_files(events.sparkSession, path, one_per_line=True)
    return normalize.normalize(raw, "pollution", fixtures.INGESTED_AT)


PER_LARGE_DOCUMENT = 20_000


def _large_documents(rows: DataFrame, items: str, path: str, *keep: str) -> None:
    """Rows as files of one document each, a record to a line, of ``PER_LARGE_DOCUMENT`` records on average."""
    documents = max(1, -(-rows.count() // PER_LARGE_DOCUMENT))
    record = F.to_json(F.struct(*(c for c in rows.columns if c not in keep)))
    spread = F.pmod(F.xxhash64(record), F.lit(documents))
    named = rows.select(*keep, spread.alias("document"), F.lit(1).alias("part"), record.alias("value"))
    place = F.row_number().over(Window.partitionBy("document", *keep).orderBy("value"))
    listed = named.withColumn("value", F.concat(F.when(place > 1, ",").otherwise(""), "value"))
    ends = F.explode(F.array(F.struct(F.lit(0).alias("part"), F.lit('{"%s":[' % items).alias("value")),
                             F.struct(F.lit(2).alias("part"), F.lit("]}").alias("value"))))
    both = listed.unionByName(named.select(*keep, "document").distinct().select(*keep, "document", ends.alias("end")).select(
        *keep, "document", "end.*"))
    folders = [*keep, "document"]
    laid = both.repartition(*folders).sortWithinPartitions(*folders, "part", F.col("value").startswith(","))
    laid.drop("part").write.partitionBy(*folders).text(path)


@_events_query
def landed_large_quakes(events):
    """Read from documents of many features, each cut into tasks where a feature begins."""
    path = scratch_path(events.sparkSession, "landing-large-quakes")
    _large_documents(fixtures.raw_quakes(events).select(F.lit("Feature").alias("type"), "*"), "features", path)
    raw = landing.quake_files(events.sparkSession, path, record_start=landing.QUAKE_START)
    return normalize.normalize(raw, "earthquakes", fixtures.INGESTED_AT)


@_events_query
def landed_large_air(events):
    """The same of result pages, of which some records begin otherwise."""
    path = scratch_path(events.sparkSession, "landing-large-air")
    feed = fixtures.raw_air(events)
    _large_documents(feed.select("datetime", *(c for c in feed.columns if c != "datetime")), "results", path, "country_id", "parameter_id")
    raw = landing.air_files(events.sparkSession, path, record_start=landing.AIR_START)
    return normalize.normalize(raw, "pollution", fixtures.INGESTED_AT)


def _candidates(events):
    return {kind: normalize.CANDIDATES[kind](fixtures.RAW[kind](events), fixtures.INGESTED_AT) for kind in KINDS}


@_events_query
def rejects(events):
    """Rejected records per feed and reason."""
    parts = [
        normalize.rejected(c).select(F.lit(kind).alias("source"), normalize.REASON)
        for kind, c in _candidates(events).items()
    ]
    tagged = parts[0].unionAll(parts[1]).unionAll(parts[2])
    return tagged.groupBy("source", normalize.REASON).agg(F.count("*").alias("records"))


@_events_query
def ingest_stats(events):
    return normalize.ingest_stats(_candidates(events))


@_events_query
def event_time_derive(events):
    """Each kind's event time from the columns its stream carries: milliseconds, date and clock, ISO text."""
    made = {
        "earthquakes": fixtures.quakes(events),
        "wildfires": fixtures.fires(events),
        "pollution": fixtures.air(events),
    }
    parts = []
    for kind, df in made.items():
        derived = with_event_time(df.withColumnRenamed("event_time", "landed"), kind, "timestamp_ntz")
        parts.append(derived.select(F.lit(kind).alias("kind"), "landed", "event_time"))
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


# Dimensions


@_events_query
def dim_lookup(events):
    """Measurements per named country and parameter, the names looked up by id."""
    ids = fixtures.raw_air(events).select("country_id", "parameter_id")
    counted = ids.groupBy("country_id", "parameter_id").agg(F.count("*").alias("readings"))
    return dimensions.name_ids(counted).select("country_id", "country", "parameter_id", "parameter", "readings")


@_events_query
def dim_cross(events):
    """Every request of a poll, with the number of readings it brought (0 included)."""
    ids = fixtures.raw_air(events).select("country_id", "parameter_id")
    counted = ids.groupBy("country_id", "parameter_id").agg(F.count("*").alias("readings"))
    wanted = dimensions.requests(events.sparkSession)
    return wanted.join(counted, ["country_id", "parameter_id"], "left").na.fill(0, ["readings"])


# Staging and classes


@_query
def stg_earthquakes(t):
    return stage_quakes(t.quakes)


@_query
def stg_wildfires(t):
    return stage_fires(t.fires)


@_query
def stg_pollution(t):
    return stage_air(t.air)


@_events_query
def risk_label_of_score(events):
    runs = fixtures.prediction_runs(events)
    return runs.withColumn("ml_risk_label", risk_label(F.col("ml_risk_score")))


_QUERIES["risk_label"] = _QUERIES.pop("risk_label_of_score")


# Zones and the risk table


@_query
def zone_quakes(t):
    return _rounded(zones.quake_zones(stage_quakes(t.quakes), t.as_of), "avg_mag")


@_query
def zone_fires(t):
    return _rounded(zones.fire_zones(stage_fires(t.fires), t.as_of), "avg_frp")


@_query
def zone_air(t):
    return _rounded(zones.air_zones(stage_air(t.air), t.as_of), "avg_pm25", "avg_no2")


_ZONE_MEANS = ("avg_mag", "avg_frp", "avg_pm25", "avg_no2", "raw_risk_score")


@_query
def int_active_zones(t):
    return _rounded(zones.active_zones(*_staged(t), t.as_of), *_ZONE_MEANS)


@_query
def int_active_zones_rolled(t):
    """From stored partial sums of whole days and the rows of the two days at the edges."""
    path = scratch_path(t.spark, "zone-days")
    rollup.store_days(rollup.zone_days(*_staged(t)), path)
    return _rounded(rollup.active_zones(rollup.read_days(t.spark, path), *_staged(t), t.as_of), *_ZONE_MEANS)


@_query
def int_active_zones_joined(t):
    return _rounded(zones.active_zones_joined(*_staged(t), t.as_of), *_ZONE_MEANS)


@_query
def mart_risk_zones(t):
    return _rounded(layers.mart(*_base(t), t.as_of), "avg_pm25", "raw_risk_score")


# Serving


@_query
def recent_quakes(t):
    return serving.recent_quakes(t.quakes, t.as_of)


@_query
def recent_strong_quakes(t):
    return serving.recent_quakes(t.quakes, t.as_of, hours=72, min_mag=2.5)


@_query
def snapshot_quakes(t):
    return serving.snapshot_quakes(t.quakes, t.as_of)


@_query
def active_fires(t):
    return serving.active_fires(t.fires, t.as_of)


@_query
def pollution_latest(t):
    return serving.latest_air(t.air, t.as_of)


@_query
def pollution_latest_station(t):
    return serving.latest_air_per_station(t.air, t.as_of)


@_query
def risk_zones_top(t):
    return _rounded(serving.top_risk_zones(layers.mart(*_base(t), t.as_of)), "avg_pm25")


@_query
def global_stats(t):
    return serving.global_stats(*_base(t), t.as_of)


@_query
def incremental_pull(t):
    return serving.pull_since(t.quakes, "earthquakes", t.as_of - timedelta(days=1))


@_query
def result_envelope(t):
    """A service answer: the number of rows and the rows as a JSON array, newest first."""
    columns = ("id", "place", "alert", "tsunami", "status", "event_time")
    newest = t.quakes.filter(F.col("event_time") >= moment(t.as_of - timedelta(days=1))).select(*columns)
    newest = newest.orderBy(F.desc("event_time"), "id").limit(serving.QUAKE_ROWS)
    return envelope(newest, -F.unix_micros(F.col("event_time").cast("timestamp")), F.col("id"))


@_query
def event_feed(t):
    return _real_integers(serving.event_feed(*_base(t), {kind: t.as_of - timedelta(hours=6) for kind in KINDS}))


@_query
def latest_per_source_cap(t):
    return serving.latest_per_request(t.air)


@_query
def marker_layer(t):
    layer = markers.marker_layer(*_base(t))
    return _rounded(layer, "x", "y", "z", "size", "opacity")


def _pulled_to_end(t: BaseTables, kind: str, rows: DataFrame) -> DataFrame:
    """The whole table in pulls, times cut to days so that far more rows share one than a pull takes."""
    daily = rows.withColumn("event_time", F.date_trunc("DAY", "event_time").cast("timestamp_ntz"))
    return _real_integers(serving.pages(daily, kind))


@_query
def pull_to_end_quakes(t):
    return _pulled_to_end(t, "earthquakes", t.quakes)


@_query
def pull_to_end_fires(t):
    return _pulled_to_end(t, "wildfires", t.fires)


@_query
def pull_to_end_air(t):
    return _pulled_to_end(t, "pollution", t.air)


@_query
def quake_details(t):
    return markers.detail_text(t.quakes)


@_query
def fire_details(t):
    return markers.fire_detail_text(t.fires)


@_query
def air_details(t):
    return markers.air_detail_text(t.air)


# Delivery: dedup, encoding, profile


def _delivered_twice(quakes: DataFrame) -> DataFrame:
    later = quakes.withColumn("ingested_at", F.lit("2024-02-01T01:00:00+00:00"))
    return quakes.unionByName(later)


@_events_query
def dedup_events(events):
    """All quakes, delivered by two polls, once each."""
    return dedup.distinct_events(_delivered_twice(fixtures.quakes(events)), "earthquakes")


@_query
def new_events_antijoin(t):
    """Two polls bring every quake; those older than a week had landed before."""
    landed = t.quakes.filter(F.col("event_time") < moment(t.as_of - timedelta(days=7)))
    return dedup.new_events(_delivered_twice(t.quakes), landed, "earthquakes")


def _fire_deliveries(t: BaseTables) -> DataFrame:
    return fixtures.deliveries(t.fires, "daynight = 'D'")


def _air_deliveries(t: BaseTables) -> DataFrame:
    return fixtures.deliveries(t.air, "parameter = 'o3'", sensor_id="IF(location_id LIKE '%7', NULL, sensor_id)")


@_query
def dedup_fires(t):
    """Three deliveries of every fire, of which some miss the earliest; positions may be missing."""
    return dedup.distinct_events(_fire_deliveries(t), "wildfires")


@_query
def dedup_air(t):
    """Three deliveries of every reading, of which some miss the earliest; sensors may be missing."""
    return dedup.distinct_events(_air_deliveries(t), "pollution")


@_query
def new_fires(t):
    """Of these, fires older than a week had landed before."""
    landed = t.fires.filter(F.col("event_time") < moment(t.as_of - timedelta(days=7)))
    return dedup.new_events(_fire_deliveries(t), landed, "wildfires")


@_query
def new_air(t):
    """Of these, readings older than a week had landed before, as they came last."""
    deliveries = _air_deliveries(t)
    landed = deliveries.filter(F.col("event_time") < moment(t.as_of - timedelta(days=7)))
    return dedup.new_events(deliveries, landed, "pollution")


@_query
def tsv_encode(t):
    parts = [
        df.select(F.lit(kind).alias("kind"), tsv_line(df).alias("line")) for kind, df in zip(KINDS, _base(t))
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@_query
def topic_encode(t):
    """Messages of all kinds, decoded again field by field, as number texts differ between engines."""
    parts = [topics.messages(df.drop("event_time"), kind) for kind, df in zip(KINDS, _base(t))]
    fields = {f.name: f for schema in STREAM_SCHEMA.values() for f in schema}
    sent = parts[0].unionAll(parts[1]).unionAll(parts[2])
    data = sent.select("topic", "key", F.from_json("value", StructType(list(fields.values()))).alias("data"))
    return _real_integers(data.select("topic", "key", "data.*"))


@_query
def source_profile(t):
    parts = [profile.source_profile(df, kind) for kind, df in zip(KINDS, _base(t))]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@_events_query
def predictions_latest(events):
    latest = tables.latest_predictions(fixtures.prediction_runs(events))
    return latest.withColumn("ml_risk_label", risk_label(F.col("ml_risk_score")))


BATCHES = 5


def _streamed(t: BaseTables, kind: str, order: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Every event delivered twice, as message files in the given order that a stream takes one by one; what it landed."""
    rows = {"earthquakes": t.quakes, "wildfires": t.fires, "pollution": t.air}[kind]
    twice = rows.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
    root, table, progress = (scratch_path(t.spark, name) for name in ("messages", "landed", "progress"))
    topics.land_messages(order(twice).drop("_copy", "event_time"), kind, root)
    arriving = messages.typed(messages.file_stream(t.spark, kind, root, max_files=1), kind)
    jobs.append_new_stream(arriving, kind, table, progress, {"availableNow": True}).awaitTermination()
    landed = tables.read_table(t.spark, kind, table, batched=True).drop("batch_id", "event_date")
    landed = landed.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    # which of several events with one key comes first depends on the order of files; the keys do not
    return landed if kind == "earthquakes" else landed.select(*NATURAL_KEY[kind])


@_query
def new_revised_quakes(t):
    """Quakes that later polls bring again with their times revised by hours or weeks, among new ones: each id lands once."""
    path = scratch_path(t.spark, "revised")
    for poll, (days, known) in enumerate(((0, "sig % 3 = 0"), (25, "sig % 3 <= 1"), (-60, "true"))):
        moved = F.col("event_time").cast("timestamp") + F.expr(f"INTERVAL {days} DAYS")
        later = t.quakes.filter(known).withColumns({"event_time": moved, "time_ms": F.unix_millis(moved)})
        tables.append_new(later, "earthquakes", path, poll)
    landed = tables.read_table(t.spark, "earthquakes", path, batched=True)
    return landed.select("id", "mag", "time_ms", F.col("event_time").cast("timestamp_ntz").alias("event_time"))


def _committed(t: BaseTables, kinds: dict[str, DataFrame]) -> DataFrame:
    """What one feed hands on of tables that grow by batches, while days are compacted; a stopped feed goes on where it was."""
    roots = {kind: scratch_path(t.spark, f"committed-{kind}") for kind in kinds}
    out = scratch_path(t.spark, "handed-on")
    publish = lambda rows, batch_id: rows.write.parquet(f"{out}/part={batch_id}")
    for batch, share in enumerate((F.xxhash64("event_time") % 3 == 0, F.xxhash64("event_time") % 2 == 0, F.lit(True))):
        for kind, rows in kinds.items():
            stamped = rows.withColumn("event_time", F.col("event_time").cast("timestamp"))
            tables.append_new(stamped.filter(share), kind, roots[kind], batch)
            if batch == 1:
                tables.compact(t.spark, kind, roots[kind], t.as_of.date(), clean=False)
        if batch:
            jobs.commit_feed(t.spark, roots, publish, f"{out}-progress", {"availableNow": True}).awaitTermination()
    return t.spark.read.option("mergeSchema", True).parquet(out).drop("part")


@_query
def committed_feed(t):
    """One feed of all three kinds with one cursor: each observation once."""
    handed = _committed(t, {"earthquakes": t.quakes, "wildfires": t.fires, "pollution": t.air})
    of = {"earthquake": "earthquakes", "wildfire": "wildfires", "pollution": "pollution"}
    keys = {key: [tag for tag, kind in of.items() if key in NATURAL_KEY[kind]] for k in KINDS for key in NATURAL_KEY[k]}
    return handed.select("_type", *(F.when(F.col("_type").isin(tags), F.col(key)).alias(key) for key, tags in keys.items()))


def _shuffled(rows: DataFrame) -> DataFrame:
    return rows.repartition(BATCHES, F.xxhash64(*rows.columns))


def _newest_first(rows: DataFrame) -> DataFrame:
    """A replay backwards: every batch brings first sightings far behind what was seen."""
    return rows.repartitionByRange(BATCHES, F.desc("event_time"), "_copy")


@_query
def stream_new_quakes(t):
    return _streamed(t, "earthquakes", _shuffled)


@_query
def stream_new_fires(t):
    return _streamed(t, "wildfires", _shuffled)


@_query
def stream_new_air(t):
    return _streamed(t, "pollution", _shuffled)


@_query
def stream_first_quakes(t):
    return _streamed(t, "earthquakes", _newest_first)


@_query
def stream_first_fires(t):
    return _streamed(t, "wildfires", _newest_first)


@_query
def stream_first_air(t):
    return _streamed(t, "pollution", _newest_first)


# Features, labels, split


@_query
def features_quakes_7d(t):
    return _rounded(features.quake_features(t.quakes, t.as_of), "avg_mag_7d", "shallow_eq_ratio")


@_query
def features_fires_7d(t):
    return _rounded(features.fire_features(t.fires, t.as_of), "avg_frp_7d")


@_query
def features_air_48h(t):
    return _rounded(features.air_features(t.air, t.as_of), "avg_pm25_48h", "avg_no2_48h")


@_query
def label_zones(t):
    return features.label_zones(t.quakes, t.fires, t.as_of)


_FEATURE_MEANS = ("avg_mag_7d", "shallow_eq_ratio", "avg_frp_7d", "avg_pm25_48h", "avg_no2_48h")


@_query
def zone_features(t):
    return _rounded(features.zone_features(*_base(t), t.as_of), *_FEATURE_MEANS)


@_query
def zone_features_joined(t):
    return _rounded(features.zone_features_joined(*_base(t), t.as_of), *_FEATURE_MEANS)


@_query
def training_set(t):
    return _rounded(features.training_set(*_base(t), t.as_of), *_FEATURE_MEANS)


@_query
def training_set_joined(t):
    return _rounded(features.training_set_joined(*_base(t), t.as_of), *_FEATURE_MEANS)


@_query
def label_distribution(t):
    return _rounded(features.label_distribution(features.training_set(*_base(t), t.as_of)), "positive_rate")


@_query
def class_weight(t):
    return _rounded(features.class_weight(features.training_set(*_base(t), t.as_of)), "scale_pos_weight")


@_query
def stratified_split(t):
    """First four fifths of each class by zone."""
    rows = settled(features.training_set(*_base(t), t.as_of).select(*ZONE, LABEL), "zones")
    return split.split_by_order(rows, "zone_lat", [F.col("zone_lon")], [LABEL])


@_query
def stratified_split_seeded(t):
    """The split that training uses."""
    rows = settled(features.training_set(*_base(t), t.as_of).select(*ZONE, LABEL), "zones")
    return split.stratified_split(rows)


# Measures over scored rows


@_events_query
def roc_auc(events):
    measures = metrics.ranking(fixtures.scored(events), "label", "score")
    return _rounded(measures.select("positives", "negatives", "roc_auc"), "roc_auc")


@_events_query
def average_precision(events):
    measures = metrics.ranking(fixtures.scored(events), "label", "score")
    return _rounded(measures.select("positives", "average_precision"), "average_precision")


@_events_query
def ranking_with_gaps(events):
    """Both measures over scores of which some are missing or not a number."""
    measures = metrics.ranking(fixtures.scored_with_gaps(events), "label", "score")
    return _rounded(measures, "roc_auc", "average_precision")


@_events_query
def classification_report(events):
    guessed = fixtures.scored(events).withColumn("prediction", F.when(F.col("score") >= 50, 1).otherwise(0))
    return _rounded(metrics.classification_report(guessed, "label", "prediction"), "precision", "recall", "f1")


@_query
def top_drivers(t):
    """The three strongest values of each quake's row, one per line."""
    source = fixtures.driver_rows(t.source, t.as_of)
    names = [f for f in FEATURES if f not in ZONE]
    drivers = attribution.top_drivers(attribution.contribution_map(names))
    unfolded = source.select("id", F.posexplode(drivers).alias("rank", "driver"))
    return _rounded(unfolded.select("id", "rank", "driver.feature", "driver.value"), "value")


# The risk model. Training takes a minute or more, so one stored model per table serves all
# queries of a session, as the scoring and explaining jobs share one model file.

MODEL_QUERIES: list[str] = []
_STORED: dict[tuple, tuple[str, DataFrame, DataFrame]] = {}


def _version(events: DataFrame) -> tuple:
    """What tells a table from its successor in the same place: newest file, and bytes of all."""
    files = events.select("_metadata.file_path", "_metadata.file_modification_time", "_metadata.file_size").distinct()
    return tuple(files.agg(F.max("file_modification_time"), F.sum("file_size")).first())


def _model_query(build: Callable) -> Callable:
    """Register a query over (path of the stored model, all zones, hold-out zones)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        t = base_tables(spark, sf_dir)
        key = (spark.sparkContext.applicationId, sf_dir, _version(t.source))
        if key not in _STORED:
            trained = model.train(features.training_set(*_base(t), t.as_of))
            path = scratch_path(spark, "model")
            model.save(trained, path, t.as_of)
            _STORED[key] = (path, trained.zones, trained.holdout)
        return build(*_STORED[key])

    _QUERIES[build.__name__] = run
    MODEL_QUERIES.append(build.__name__)
    return build


@_model_query
def model_invariants(path, zone_rows, holdout):
    """What must hold of any trained model's scores, contributions and weights, whatever its trees are."""
    loaded = model.load(path)
    scores, spark = model.predictions(loaded, zone_rows), zone_rows.sparkSession
    score = F.col("ml_risk_score")
    label = F.when(score > 0.7, "critical").when(score > 0.4, "high").when(score > 0.2, "moderate").otherwise("low")
    scored = scores.agg(
        F.count("*").alias("zones"),
        F.min(score.between(0, 1)).alias("scores_in_range"),
        F.min(F.col("ml_risk_label") == label).alias("labels_follow_scores"),
    ).first()
    values = F.map_values("shap_values")
    off = F.col("base_value") + F.aggregate(values, F.lit(0.0), lambda a, b: a + b) - F.col("margin")
    explained = explain.explained(zone_rows, path).agg(
        F.count("*").alias("explained_zones"),
        F.sum(F.size(values)).alias("contributions"),
        F.min(F.abs(off) < 1e-6).alias("contributions_add_up"),
    ).first()
    weights = model.importances(spark, loaded).agg(
        F.count("*").alias("inputs"), F.abs(F.sum("importance") - 1).alias("off")
    ).first()
    row = {**scored.asDict(), **explained.asDict(), "inputs": weights["inputs"], "weights_add_up": weights["off"] < 1e-6}
    return spark.createDataFrame([tuple(row.values())], StructType.fromDDL(
        "zones bigint, scores_in_range boolean, labels_follow_scores boolean, explained_zones bigint, "
        "contributions bigint, contributions_add_up boolean, inputs bigint, weights_add_up boolean"
    ))


@_model_query
def ml_score_zones(path, zone_rows, holdout):
    return model.predictions(model.load(path), zone_rows)


@_model_query
def top_risk_zones(path, zone_rows, holdout):
    return model.top_zones(model.predictions(model.load(path), zone_rows))


@_model_query
def feature_importance(path, zone_rows, holdout):
    return model.importances(zone_rows.sparkSession, model.load(path))


@_model_query
def holdout_report(path, zone_rows, holdout):
    return model.evaluation(model.load(path), holdout)[0]


@_model_query
def holdout_ranking(path, zone_rows, holdout):
    return model.evaluation(model.load(path), holdout)[1]


@_model_query
def attributions(path, zone_rows, holdout):
    return explain.attributions(zone_rows, path)


@_model_query
def attribution_long(path, zone_rows, holdout):
    return explain.attribution_long(zone_rows, path)


@_model_query
def attribution_of_top(path, zone_rows, holdout):
    return explain.attribution_of_top(zone_rows, path)


@_model_query
def attribution_importance(path, zone_rows, holdout):
    return explain.attribution_importance(zone_rows, path)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
