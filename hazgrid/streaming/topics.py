"""Typed streams from JSON messages, on a broker or in landing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.clock import with_event_time
from ..schemas import NATURAL_KEY, STREAM_SCHEMA

CORRUPT = "_corrupt_record"

# Fixed value: how late rows of a stream may be for stateful steps.
LATENESS = {"pollution": "2 hours"}
# How long after its arrival a repeat is known by state, where nothing is stated.
NEAR = "2 hours"
# What one batch takes in at most, so that a backlog is worked off in steps.
MAX_OFFSETS, MAX_FILES = 1_000_000, 1_000


def broker_stream(spark: SparkSession, topic: str, servers: str, max_offsets: int | None = MAX_OFFSETS) -> DataFrame:
    """Messages of a topic from now on; needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def file_stream(spark: SparkSession, topic: str, root: str, max_files: int | None = MAX_FILES) -> DataFrame:
    """Messages from text files below ``root/topic``, one JSON object per line."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(f"{root.rstrip('/')}/{topic}")


def parse_messages(messages: DataFrame, kind: str) -> DataFrame:
    """``value`` -> the columns of the kind, plus the raw text where it is not readable as such."""
    schema = T.StructType([*STREAM_SCHEMA[kind].fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col("value").cast("string"), schema, {"columnNameOfCorruptRecord": CORRUPT})
    return messages.select(F.inline(F.array(parsed)))  # parsed once; a filter stays above a generator


def typed(messages: DataFrame, kind: str) -> DataFrame:
    """Readable messages with their event time. Unreadable ones are left to ``unreadable``."""
    rows = parse_messages(messages, kind).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return with_event_time(rows, kind)


def unreadable(messages: DataFrame, kind: str) -> DataFrame:
    """Messages that are not JSON, or whose event time cannot be read, with the reason."""
    rows = with_event_time(parse_messages(messages, kind), kind)
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed").when(F.col("event_time").isNull(), "no_event_time")
    text = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*STREAM_SCHEMA[kind].names)))
    return rows.select(reason.alias("reject_reason"), text.alias("value")).filter("reject_reason IS NOT NULL")


def with_watermark(rows: DataFrame, kind: str, lateness: str | None = None) -> DataFrame:
    """Mark how late rows may be, where that is stated. On its own this drops nothing; stateful steps use it."""
    late = lateness or LATENESS.get(kind)
    return rows.withWatermark("event_time", late) if late else rows


def without_near_repeats(rows: DataFrame, kind: str, span: str | None = None) -> DataFrame:
    """Rows of a stream less those whose key arrived within ``span`` before.

    The watermark runs on the time of arrival, which no row is behind, so nothing is dropped
    for being late, be it days old. State holds the keys of the last ``span`` and no more; older repeats
    are left to the key index.
    """
    arriving = rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", span or LATENESS.get(kind, NEAR))
    return arriving.dropDuplicatesWithinWatermark(list(NATURAL_KEY[kind])).drop("_arrived")


def counted(messages: DataFrame, kind: str) -> DataFrame:
    """``typed`` messages that have an event time, counted on their way by kind of verdict.

    Sent, accepted and rejected messages of each batch are in the query's progress as
    ``intake_<kind>``, without a job of their own; ``Intake`` adds them up.
    """
    rows = with_event_time(parse_messages(messages, kind), kind)
    good = F.col(CORRUPT).isNull() & F.col("event_time").isNotNull()
    seen = rows.observe(
        f"intake_{kind}",
        F.count(F.lit(1)).alias("total_features"),
        F.count_if(good).alias("sent"),
        F.count_if(~good).alias("rejected"),
    )
    return seen.filter(good).drop(CORRUPT)


class Intake(StreamingQueryListener):
    """Counts of running streams, by kind, as their batches finish; add it with ``spark.streams.addListener``."""

    def __init__(self) -> None:
        self.counts: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            if name.startswith("intake_"):
                held = self.counts.setdefault(name.removeprefix("intake_"), {})
                for part, n in row.asDict().items():
                    held[part] = held.get(part, 0) + n

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
