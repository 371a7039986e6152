"""Typed base tables on a file system: date folders, sorted files, batches that land whole, and an index of their keys."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import distinct_events, latest_per_key, new_events
from ..schemas import NATURAL_KEY, SORT_KEY, STREAM_SCHEMA, ZONE
from . import log

_FOLDERS = ("event_date", "batch_id", "write")
#: The key index: its folder, key folders of a level before they are merged, and keys that are asked for one by one.
KEYS, MOST_KEY_WRITES, FEW = "_keys", 32, 200


def _laid_out(events: DataFrame, kind: str, *folders: str) -> DataFrame:
    """Rows in the order the table stores them.

    ``rebalance`` lets adaptive execution cut a date that holds most of the rows into
    several files and pack thin dates together; sorting by the table key inside each
    task gives every file and row group narrow min/max ranges to skip by.
    """
    return events.hint("rebalance", F.col("event_date")).sortWithinPartitions(*folders, *SORT_KEY[kind])


def _dated(events: DataFrame) -> DataFrame:
    return events.withColumn("event_date", F.to_date("event_time"))


def write_table(events: DataFrame, kind: str, path: str, mode: str = "append") -> None:
    _laid_out(_dated(events), kind, "event_date").write.mode(mode).partitionBy("event_date").parquet(path)


def _write_id(cause: str) -> str:
    return f"{cause}-{uuid.uuid4().hex}"


def _rows_written(events: DataFrame, kind: str, path: str, batch_id: int) -> list[log.Folder]:
    """Write the rows of a batch, a folder for each date, and say which."""
    if events.isEmpty():
        return []  # and nothing would be observed
    write, days = _write_id("batch"), Observation()
    rows = _dated(events).observe(days, F.collect_set("event_date").alias("days"))
    rows = rows.withColumns({"batch_id": F.lit(batch_id).cast("bigint"), "write": F.lit(write)})
    _laid_out(rows, kind, *_FOLDERS).write.mode("append").partitionBy(*_FOLDERS).parquet(path)
    return [
        log.Folder(f"event_date={day}/batch_id={batch_id}/write={write}", batch_id, day=day)
        for day in sorted(d.isoformat() for d in days.get["days"])
    ]


def write_batch(events: DataFrame, kind: str, path: str, batch_id: int, keys: bool = True) -> None:
    """Land one micro-batch: its rows below their dates and their keys in the key index, in one commit.

    A batch that has landed before is replaced whole, also where its rows now fall on other
    dates. Once compaction has merged it, a batch is final and its repeat writes nothing.
    """
    spark = events.sparkSession
    if log.newest(spark, path).settled >= batch_id:
        return
    added = _rows_written(events, kind, path, batch_id)
    if keys and added:
        added.append(_keys_written(with_marks(events, kind), path, batch_id, 0))

    def change(now: log.Manifest) -> log.Manifest:
        earlier = tuple(folder for folder in now.live if folder.batch == batch_id and folder.level == 0)
        return replace(now, added=tuple(added), removed=earlier)

    log.commit(spark, path, "batch", change)
    merge_keys(spark, kind, path)


def append_new(events: DataFrame, kind: str, path: str, batch_id: int) -> int:
    """Land the observations of a batch that no other batch has landed, ever; returns how many."""
    held = events.filter("event_time IS NOT NULL")
    known = landed_keys(held, kind, path, batch_id)
    # the folders of known keys are fixed here, so what is lost of the cache comes out the same again
    fresh = (distinct_events(held, kind) if known is None else new_events(held, known, kind)).persist()
    try:
        write_batch(fresh, kind, path, batch_id)
        return fresh.count()
    finally:
        fresh.unpersist()


def compact(spark: SparkSession, kind: str, path: str, day: date, clean: bool = True) -> None:
    """Put the batches of a closed day into one folder, sorted, each observation once.

    The merged rows are written beside the others and take their place by one commit; only
    then the others go, or with ``clean=False`` stay for feeds that lag behind until ``log.sweep``.
    """
    own = [folder for folder in log.newest(spark, path).live if folder.day == day.isoformat()]
    if len(own) > 1:
        newest = max(folder.batch for folder in own)
        merged = log.Folder(
            f"event_date={day.isoformat()}/batch_id={newest}/write={_write_id('merged')}", newest, 1, day.isoformat()
        )
        rows = distinct_events(open_folders(spark, kind, path, own).drop("batch_id", "event_date"), kind)
        rows = rows.hint("rebalance").sortWithinPartitions(*SORT_KEY[kind])
        rows.write.parquet(f"{path.rstrip('/')}/{merged.path}")

        def change(now: log.Manifest) -> log.Manifest | None:
            if not set(own) <= set(now.live):
                return None  # a batch was repeated meanwhile: the next run merges
            return replace(now, added=(merged,), removed=tuple(own), settled=max(now.settled, newest))

        log.commit(spark, path, "compaction", change)
    if clean:
        log.sweep(spark, path, f"event_date={day.isoformat()}/batch_id=*/write=*")
        log.sweep_empty(spark, f"{path.rstrip('/')}/event_date={day.isoformat()}/batch_id=*")


def _columns(kind: str, time: str) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STREAM_SCHEMA[kind]) + f", event_time {time}"


def _reader(spark: SparkSession, kind: str, time: str, batched: bool) -> DataFrameReader:
    folders = "event_date date, batch_id bigint" if batched else "event_date date"
    return spark.read.schema(f"{_columns(kind, time)}, {folders}")


def open_folders(
    spark: SparkSession, kind: str, path: str, folders: list[log.Folder], time: str = "timestamp"
) -> DataFrame:
    """The rows of some folders of a batch-written table."""
    reader = _reader(spark, kind, time, batched=True)
    if not folders:
        return spark.createDataFrame([], f"{_columns(kind, time)}, event_date date, batch_id bigint")
    root = path.rstrip("/")
    return reader.option("basePath", root).parquet(*(f"{root}/{folder.path}" for folder in folders)).drop("write")


def read_table(
    spark: SparkSession, kind: str, path: str, time: str = "timestamp", batched: bool = False
) -> DataFrame:
    """The table with its folder columns; the schema is declared, so no file is opened for it.

    ``event_date`` stays in the result so that horizons prune folders. ``batched``: the
    table was written batch by batch, and is read as its log says.
    """
    if batched:
        return open_folders(spark, kind, path, [f for f in log.newest(spark, path).live if not f.is_keys], time)
    return _reader(spark, kind, time, batched).parquet(path)


# The key index: every landed key with its hash, sorted by it, with Parquet's Bloom filters. A
# batch reads the row groups that may have its keys, however long ago these landed.


def with_marks(rows: DataFrame, kind: str) -> DataFrame:
    """The natural key of rows with ``mark``, its hash; missing parts count as equal."""
    return rows.select(*NATURAL_KEY[kind], F.xxhash64(*NATURAL_KEY[kind]).alias("mark"))


def _keys_written(keys: DataFrame, path: str, batch_id: int, level: int) -> log.Folder:
    folder = log.Folder(f"{KEYS}/write={_write_id('keys')}", batch_id, level)
    # merged keys are dealt by ranges, so that files tell by their smallest and largest hash as well
    dealt = keys.repartitionByRange("mark") if level else keys.hint("rebalance")
    dealt.sortWithinPartitions("mark").write.option("parquet.bloom.filter.enabled#mark", "true").parquet(f"{path.rstrip('/')}/{folder.path}")
    return folder


def _open_keys(spark: SparkSession, kind: str, path: str, folders: list[log.Folder]) -> DataFrame:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STREAM_SCHEMA[kind] if f.name in NATURAL_KEY[kind])
    root = path.rstrip("/")
    reader = spark.read.schema(f"{columns}, mark bigint").option("basePath", f"{root}/{KEYS}")
    return reader.parquet(*(f"{root}/{folder.path}" for folder in folders)).drop("write")


def landed_keys(events: DataFrame, kind: str, path: str, batch_id: int) -> DataFrame | None:
    """Keys of other batches among which those of ``events`` would be; None when nothing has landed.

    Of up to ``FEW`` different keys only row groups are read whose Bloom filter has one of
    them; more keys are in most row groups anyway. This changes nothing of what is found.
    """
    spark = events.sparkSession
    held = [f for f in log.newest(spark, path).live if f.is_keys and not (f.batch == batch_id and f.level == 0)]
    if not held:
        return None
    keys = _open_keys(spark, kind, path, held)
    asked = with_marks(events, kind).select("mark").distinct().limit(FEW + 1).collect()
    if len(asked) <= FEW:
        spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(FEW))
        keys = keys.filter(F.col("mark").isin([row["mark"] for row in asked]))
    return keys.select(*NATURAL_KEY[kind])


def merge_keys(spark: SparkSession, kind: str, path: str, most: int = MOST_KEY_WRITES) -> None:
    """Merge the key folders of a level into one of the next when there are over ``most``.

    So a key is written again as often as the logarithm of the number of batches, and a
    look-up opens few folders. The newest batch stays apart, as it may be repeated.
    """
    keys = [folder for folder in log.newest(spark, path).live if folder.is_keys]
    newest = max((folder.batch for folder in keys), default=-1)
    for level in sorted({folder.level for folder in keys}):
        own = [f for f in keys if f.level == level and not (level == 0 and f.batch == newest)]
        if len(own) > most:
            last = max(folder.batch for folder in own)
            merged = _keys_written(_open_keys(spark, kind, path, own), path, last, level + 1)

            def change(now: log.Manifest) -> log.Manifest | None:
                if not set(own) <= set(now.live):
                    return None
                return replace(now, added=(merged,), removed=tuple(own), settled=max(now.settled, last))

            log.commit(spark, path, "keys", change)
            return


def append_predictions(predictions: DataFrame, path: str, run_id: str) -> None:
    """One folder per scoring run; running it again replaces that run."""
    predictions.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={run_id}")


def latest_predictions(runs: DataFrame) -> DataFrame:
    """One row per zone: the newest prediction wins."""
    return latest_per_key(runs, ZONE, "predicted_at", F.col("ml_risk_score").desc())


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return latest_predictions(spark.read.parquet(path).drop("run_id"))


#: Edge of a tile of zones in degrees: predictions of a tile are stored, and replaced, together.
TILE = 10


def _tile():
    """The number of a zone's tile; -1 for a zone without place. The globe has some 650."""
    column, row = F.floor(F.col("zone_lon") / TILE), F.floor(F.col("zone_lat") / TILE)
    return F.coalesce((row + 90 // TILE) * (360 // TILE) + column + 180 // TILE, F.lit(-1)).cast("int")


def _open_tiles(spark: SparkSession, path: str, folders: list[log.Folder]) -> DataFrame:
    root = path.rstrip("/")
    return spark.read.option("basePath", root).parquet(*(f"{root}/{folder.path}" for folder in folders)).drop("tile", "write")


def merge_predictions(predictions: DataFrame, path: str) -> None:
    """Replace the zones of a run in the current table: one row per zone, the newest prediction.

    Only tiles that the run has zones of are read and written again, as one commit; a merge that
    stops before leaves the table as it was, and one that another merge of the same tiles
    overtook starts again. Folders stay for one more commit, for readers that have just opened them.
    """
    spark, root = predictions.sparkSession, path.rstrip("/")
    run = predictions.withColumn("tile", _tile()).persist()
    try:
        tiles = sorted(row["tile"] for row in run.select("tile").distinct().collect())
        while tiles and not _tiles_replaced(spark, root, run, tiles):
            pass
    finally:
        run.unpersist()


def _tiles_replaced(spark: SparkSession, root: str, run: DataFrame, tiles: list[int]) -> bool:
    touched = lambda manifest: tuple(folder for folder in manifest.live if folder.tile in tiles)
    before = log.newest(spark, root)
    held, write = touched(before), _write_id("merge")
    rows = run.drop("tile")
    if held:
        rows = rows.unionByName(_open_tiles(spark, root, list(held)))
    merged = latest_predictions(rows).withColumns({"tile": _tile(), "write": F.lit(write)})
    merged = merged.hint("rebalance", F.col("tile")).sortWithinPartitions("tile", "write", *ZONE)
    merged.write.mode("append").partitionBy("tile", "write").parquet(root)
    added = tuple(log.Folder(f"tile={t}/write={write}", before.version + 1, tile=t) for t in tiles)

    def change(now: log.Manifest) -> log.Manifest | None:
        return replace(now, added=added, removed=held) if touched(now) == held else None

    done = log.commit(spark, root, "predictions", change).added == added
    for folder in before.removed if done else added:
        log.remove(spark, f"{root}/{folder.path}")
    return done


def current_predictions(spark: SparkSession, path: str) -> DataFrame:
    """The current table, as the last merge that was committed left it."""
    live = list(log.newest(spark, path).live)
    if not live:
        raise FileNotFoundError(f"no predictions in {path}")
    return _open_tiles(spark, path, live)
