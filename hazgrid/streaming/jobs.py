"""The running streams: topics to tables, and the change feed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.clock import seconds_text
from ..operators.dedup import first_per_key
from ..schemas import KINDS, NATURAL_KEY
from ..session import use_utc
from ..sinks import log
from ..sinks.tables import append_new, open_folders, read_table, write_batch
from .topics import MAX_FILES, counted, file_stream, unreadable, without_near_repeats

TRIGGER = {"processingTime": "10 seconds"}


def _started(rows: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, name: str, trigger) -> StreamingQuery:
    """Run ``each`` on every batch that holds rows. An error in it stops the stream; nothing is swallowed."""
    def once(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()  # several passes follow; sources and state are read once
        try:
            if not held.isEmpty():
                each(held, batch_id)
        finally:
            held.unpersist()

    return (
        rows.writeStream.queryName(name)
        .outputMode("append")
        .foreachBatch(once)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}")
        .trigger(**(trigger or TRIGGER))
        .start()
    )


def append_stream(
    rows: DataFrame, kind: str, table: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append micro-batches to a table, written by the executors.

    A batch that is run again after a failure replaces its own folder.
    """
    return _started(
        rows, lambda batch, batch_id: write_batch(batch, kind, table, batch_id), checkpoint, f"append_{kind}", trigger
    )


def append_new_stream(
    rows: DataFrame, kind: str, table: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append only observations that no earlier batch landed, however late the repeat comes.

    A batch is reduced to one row per key before its only shuffle, and the key index is asked for
    its keys, whatever their times. No state is kept between batches, and no late
    row is dropped, be it a repeat or a first sighting. Rows without event time belong to the
    rejects and are left to ``unreadable``.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        append_new(batch, kind, table, batch_id)

    return _started(rows.filter("event_time IS NOT NULL"), each, checkpoint, f"append_new_{kind}", trigger)


def reject_stream(
    bad: DataFrame, kind: str, rejects: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep what could not be read, with the reason, as it came."""
    return (
        bad.writeStream.queryName(f"rejects_{kind}")
        .format("parquet")
        .option("path", f"{rejects.rstrip('/')}/{kind}")
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/rejects_{kind}")
        .trigger(**(trigger or TRIGGER))
        .start()
    )


def start_all(
    spark: SparkSession,
    topics: str,
    tables: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_files: int | None = MAX_FILES,
    source: Callable[[str], DataFrame] | None = None,
    rejects: str | None = None,
) -> dict[str, StreamingQuery]:
    """One stream per kind.

    ``source`` gives the messages of a topic; by default text files below ``topics``,
    ``max_files`` of them at a time. Repeats that follow soon are dropped by state, all others
    by the key index. With a ``rejects`` folder, unreadable messages are written
    there by streams of their own.
    """
    use_utc(spark)
    read = source or (lambda kind: file_stream(spark, kind, topics, max_files))
    running = {}
    for kind in KINDS:
        rows, table = without_near_repeats(counted(read(kind), kind), kind), f"{tables.rstrip('/')}/{kind}"
        running[kind] = append_new_stream(rows, kind, table, checkpoint, trigger)
        if rejects:
            running[f"rejects_{kind}"] = reject_stream(unreadable(read(kind), kind), kind, rejects, checkpoint, trigger)
    return running


def wait_any(spark: SparkSession, seconds: float | None = None) -> bool | None:
    """Until any stream stops or fails (then its error is raised)."""
    return spark.streams.awaitAnyTermination(seconds) if seconds else spark.streams.awaitAnyTermination()


_TAG = {"earthquakes": "earthquake", "wildfires": "wildfire", "pollution": "pollution"}


def change_feed(
    rows: DataFrame, kind: str, publish: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Hand each batch of new rows, tagged and with a readable time, to ``publish``.

    The checkpoint is the cursor: what arrived since the last batch, each row once, also
    for rows that share a second.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        shown = batch.withColumn("event_time", seconds_text(F.col("event_time")))
        publish(shown.withColumn("_type", F.lit(_TAG[kind])), batch_id)

    return _started(rows, each, checkpoint, f"feed_{kind}", trigger)


def table_stream(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """A batch-written table as a stream of the files that batches added, as they appear; merged files are not.

    Also what was replaced or left by a batch that stopped, unless it is swept; ``commit_feed`` goes by the log.
    """
    reader = spark.readStream.schema(read_table(spark, kind, path, batched=True).schema).option("basePath", path)
    return reader.parquet(f"{path.rstrip('/')}/event_date=*/batch_id=*/write=batch-*")


def commit_feed(
    spark: SparkSession, roots: dict[str, str], publish: Callable[[DataFrame, int], None], checkpoint: str,
    trigger: dict | None = None, most: int = 100,
) -> StreamingQuery:
    """Hand the rows of each commit of some tables (kind -> path), tagged and with a readable time, to ``publish``.

    The logs of all tables are one stream with one checkpoint, the cursor over all kinds, and
    ``most`` commits of each are taken at a time. What batches added is sent, each key once:
    merging rows or keys sends nothing, and of a repeated batch goes what it did not have
    before. Columns that a kind does not have are null.
    """
    commits = None
    for kind, path in roots.items():
        reader = spark.readStream.schema("value string").option("wholetext", True).option("maxFilesPerTrigger", most)
        own = reader.text(f"{path.rstrip('/')}/{log.LOG}/*.json").select(F.lit(kind).alias("kind"), "value")
        commits = own if commits is None else commits.unionAll(own)

    def each(batch: DataFrame, batch_id: int) -> None:
        done: dict[str, list[log.Manifest]] = {}
        for row in batch.collect():  # a few commits
            done.setdefault(row["kind"], []).append(log.Manifest.of(row["value"]))
        feed = None
        for kind in sorted(done):
            rows = _committed(spark, kind, roots[kind], [m for m in done[kind] if m.cause == "batch"])
            if rows is not None:
                feed = rows if feed is None else feed.unionByName(rows, allowMissingColumns=True)
        if feed is not None:
            publish(feed, batch_id)

    return _started(commits, each, checkpoint, "commits", trigger)


def _committed(spark: SparkSession, kind: str, path: str, done: list[log.Manifest]) -> DataFrame | None:
    part = lambda folders: [f for f in folders if not f.is_keys]
    added = part(folder for manifest in done for folder in manifest.added)
    if not added:
        return None
    rows = open_folders(spark, kind, path, added)
    replaced = part(folder for manifest in done for folder in manifest.removed)
    if replaced:  # without keys that an earlier form of the batch had, as far as it still exists
        before = open_folders(spark, kind, path, log.existing(spark, path, replaced))
        known = before.select(*NATURAL_KEY[kind], F.lit(0).alias("_turn"))
        stacked = rows.withColumn("_turn", F.lit(1)).unionByName(known, allowMissingColumns=True)
        first = first_per_key(stacked, NATURAL_KEY[kind], [F.col("_turn"), F.desc("batch_id")])
        rows = first.filter("_turn = 1").select(*rows.columns)
    shown = rows.withColumn("event_time", seconds_text(F.col("event_time"))).drop("event_date", "batch_id")
    return shown.withColumn("_type", F.lit(_TAG[kind]))
