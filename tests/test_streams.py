"""Streams over message files, run to the end of what is there, against the batch results."""

import glob
import time
from datetime import date, datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from hazgrid import fixtures
from hazgrid.functions.clock import since
from hazgrid.operators.dedup import distinct_events
from hazgrid.schemas import KINDS, NATURAL_KEY, STREAM_SCHEMA, ZONE
from hazgrid.sinks import log, tables, topics
from hazgrid.streaming import jobs
from hazgrid.streaming import topics as streams

NOW = {"availableNow": True}


def base(spark, sf_dir):
    source = fixtures.events(spark, sf_dir)
    return {"earthquakes": fixtures.quakes(source), "wildfires": fixtures.fires(source), "pollution": fixtures.air(source)}


@pytest.fixture(scope="module")
def topic_dir(spark, sf_dir, tmp_path_factory):
    """Every message twice, in two deliveries."""
    root = str(tmp_path_factory.mktemp("topics"))
    for kind, df in base(spark, sf_dir).items():
        for _ in range(2):
            topics.land_messages(df.drop("event_time").repartition(3), kind, root)
    return root


def finish(running):
    for query in running.values():
        query.awaitTermination(120)
        assert query.exception() is None


def rows(df, kind):
    names = [*STREAM_SCHEMA[kind].names, "event_time"]
    return sorted(map(tuple, df.select(*names).collect()), key=repr)


def test_tables_hold_each_event_once(spark, sf_dir, topic_dir, tmp_path):
    out, checkpoint = str(tmp_path / "tables"), str(tmp_path / "checkpoint")
    # two files per batch make repeats cross batches
    finish(jobs.start_all(spark, topic_dir, out, checkpoint, NOW, max_files=2))
    for kind, df in base(spark, sf_dir).items():
        landed = tables.read_table(spark, kind, f"{out}/{kind}", batched=True)
        want = distinct_events(streams.with_event_time(df.drop("event_time"), kind), kind)
        assert landed.count() == want.count()
        assert landed.select(*NATURAL_KEY[kind]).distinct().count() == landed.count()
        if kind == "earthquakes":
            assert rows(landed, kind) == rows(want, kind)


def test_restart_goes_on_where_it_stopped(spark, sf_dir, tmp_path):
    df = base(spark, sf_dir)["earthquakes"].drop("event_time")
    root, out, checkpoint = (str(tmp_path / n) for n in ("topics", "tables", "checkpoint"))
    run = lambda: jobs.append_new_stream(
        streams.typed(streams.file_stream(spark, "earthquakes", root), "earthquakes"), "earthquakes", out, checkpoint, NOW)
    topics.land_messages(df.filter("tsunami = 0"), "earthquakes", root)
    run().awaitTermination(60)
    first = tables.read_table(spark, "earthquakes", out, batched=True).count()
    topics.land_messages(df, "earthquakes", root)
    run().awaitTermination(60)
    run().awaitTermination(60)  # nothing new: nothing written
    landed = tables.read_table(spark, "earthquakes", out, batched=True)
    assert first < landed.count() == df.count()
    assert landed.select("batch_id").distinct().count() == 2


def test_unreadable_messages(spark, tmp_path):
    folder = tmp_path / "wildfires"
    folder.mkdir()
    lines = [
        '{"lat": 1.0, "lon": 2.0, "frp": 3.0, "acq_date": "2024-04-26", "acq_time": "48", "satellite": "N"}',
        '{"lat": 1.0, "lon": 2.0, "frp": 3.0, "acq_date": "2024-04-26", "acq_time": "2570", "satellite": "N"}',
        '{"lat": "north", "acq_date": "2024-04-26", "acq_time": "0001"}',
        "{broken",
    ]
    (folder / "m.txt").write_text("\n".join(lines))
    messages = spark.read.text(str(folder))
    good = streams.typed(messages, "wildfires").filter("event_time IS NOT NULL").collect()
    assert [r["event_time"].isoformat() for r in good] == ["2024-04-26T00:48:00"]
    bad = sorted(r["reject_reason"] for r in streams.unreadable(messages, "wildfires").collect())
    assert bad == ["malformed", "malformed", "no_event_time"]


def test_unreadable_messages_are_kept(spark, tmp_path):
    for kind in KINDS:
        (tmp_path / "topics" / kind).mkdir(parents=True)
        (tmp_path / "topics" / kind / "m.txt").write_text("{broken\n")
    root = str(tmp_path)
    running = jobs.start_all(spark, f"{root}/topics", f"{root}/t", f"{root}/c", NOW, rejects=f"{root}/rejects")
    finish(running)
    for kind in KINDS:
        assert [tuple(r) for r in spark.read.parquet(f"{root}/rejects/{kind}").collect()] == [("malformed", "{broken")]


def test_counts_of_a_running_stream(spark, sf_dir, tmp_path):
    """Totals of all batches are those of the messages, without another pass over them."""
    kind, df = "wildfires", base(spark, sf_dir)["wildfires"].drop("event_time")
    topics.land_messages(df.repartition(3), kind, str(tmp_path))
    (tmp_path / kind / "bad.txt").write_text('{"acq_date": "2024-04-26", "acq_time": "2570"}\n{broken\n')
    intake = streams.Intake()
    spark.streams.addListener(intake)
    try:
        rows = streams.counted(streams.file_stream(spark, kind, str(tmp_path), max_files=1), kind)
        jobs.append_new_stream(rows, kind, str(tmp_path / "t"), str(tmp_path / "c"), NOW).awaitTermination(120)
        n = df.count()
        wanted = {"total_features": n + 2, "sent": n, "rejected": 2}
        for _ in range(100):  # progress is reported a little later
            if intake.counts.get(kind) == wanted:
                break
            time.sleep(0.1)
        assert intake.counts == {kind: wanted}
    finally:
        spark.streams.removeListener(intake)


def test_watermark_alone_drops_nothing(spark, tmp_path):
    root = tmp_path / "pollution"
    root.mkdir()
    line = '{"sensor_id": "%d", "parameter": "o3", "value": 1.0, "measured_at": "2024-04-%02dT00:00:00Z"}'
    (root / "a.txt").write_text(line % (1, 20))
    kind, out = "pollution", str(tmp_path / "out")
    marked = lambda: streams.with_watermark(
        streams.typed(streams.file_stream(spark, kind, str(tmp_path), max_files=1), kind), kind)
    jobs.append_stream(marked(), kind, out, str(tmp_path / "c"), NOW).awaitTermination(60)
    (root / "b.txt").write_text(line % (2, 1))  # nineteen days late
    jobs.append_stream(marked(), kind, out, str(tmp_path / "c"), NOW).awaitTermination(60)
    assert tables.read_table(spark, kind, out, batched=True).count() == 2


def test_change_feed_sends_each_row_once(spark, sf_dir, topic_dir, tmp_path):
    seen = []
    publish = lambda batch, batch_id: seen.extend(batch.select("id", "event_time", "_type").collect())
    rows, table = streams.typed(streams.file_stream(spark, "earthquakes", topic_dir), "earthquakes"), str(tmp_path / "t")
    jobs.append_new_stream(rows, "earthquakes", table, str(tmp_path / "a"), NOW).awaitTermination(60)
    for _ in range(2):
        stream = jobs.table_stream(spark, "earthquakes", table)
        jobs.change_feed(stream, "earthquakes", publish, str(tmp_path / "c"), NOW).awaitTermination(60)
    assert len(seen) == len({r["id"] for r in seen}) == base(spark, sf_dir)["earthquakes"].count()
    assert {r["_type"] for r in seen} == {"earthquake"}


def test_failing_sink_stops_the_stream(spark, topic_dir, tmp_path):
    def publish(batch, batch_id):
        raise RuntimeError("sink is down")

    stream = streams.typed(streams.file_stream(spark, "earthquakes", topic_dir), "earthquakes")
    spark.streams.resetTerminated()
    jobs.change_feed(stream, "earthquakes", publish, str(tmp_path / "c"), NOW)
    with pytest.raises(Exception, match="sink is down"):
        jobs.wait_any(spark, 60)


def test_table_stream_and_layout(spark, sf_dir, tmp_path):
    quakes = base(spark, sf_dir)["earthquakes"].withColumn("event_time", F.col("event_time").cast("timestamp"))
    path = str(tmp_path / "t")
    tables.write_batch(quakes, "earthquakes", path, 0)
    tables.write_batch(quakes, "earthquakes", path, 0)
    again = tables.read_table(spark, "earthquakes", path, batched=True)
    assert again.count() == quakes.count()
    log.sweep(spark, path, "event_date=*/batch_id=*/write=*")
    stream = jobs.table_stream(spark, "earthquakes", path).writeStream.format("memory").queryName("landed").trigger(**NOW).start()
    stream.awaitTermination(60)
    assert spark.table("landed").count() == quakes.count()
    assert len(glob.glob(f"{path}/event_date=*/batch_id=0/*")) > 1
    for file in glob.glob(f"{path}/event_date=*/batch_id=0/*/*.parquet"):
        stored = pq.read_table(file, partitioning=None, columns=["event_time", "id"]).to_pylist()
        assert stored == sorted(stored, key=lambda r: (r["event_time"], r["id"]))
        footer = pq.ParquetFile(file)
        at = footer.schema_arrow.names.index("event_time")
        assert footer.schema.column(at).physical_type == "INT64"
        assert footer.metadata.row_group(0).column(at).statistics.has_min_max


def test_horizon_prunes_folders(spark, sf_dir, tmp_path):
    quakes = base(spark, sf_dir)["earthquakes"].withColumn("event_time", F.col("event_time").cast("timestamp"))
    path = str(tmp_path / "t")
    tables.write_table(quakes, "earthquakes", path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    recent = since(tables.read_table(spark, "earthquakes", path), datetime(2024, 1, 20), days=7)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "GreaterThanOrEqual(event_time" in plan
    assert recent.count() == quakes.filter("event_time >= TIMESTAMP'2024-01-13 00:00:00'").count()


def test_only_row_groups_of_the_keys_are_read(spark, sf_dir, tmp_path):
    quakes = base(spark, sf_dir)["earthquakes"].withColumn("event_time", F.col("event_time").cast("timestamp"))
    path = str(tmp_path / "t")
    assert tables.landed_keys(quakes, "earthquakes", path, 5) is None
    for batch in range(5):
        tables.write_batch(quakes.filter(F.pmod(F.xxhash64("id"), F.lit(5)) == batch), "earthquakes", path, batch)
    asked = spark.createDataFrame(quakes.limit(1).collect(), quakes.schema)
    near = tables.landed_keys(asked, "earthquakes", path, 9)
    assert {r.id for r in asked.select("id").collect()} == {r.id for r in near.collect()}
    leaf = near._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert "mark" in leaf.toString().split("PushedFilters:")[1].split("]")[0]
    read = leaf.metrics().apply("numOutputRows").value()
    assert 0 < read < quakes.count() / 3  # of five files one has the key
    everything = tables.landed_keys(quakes, "earthquakes", path, 9)
    assert everything.count() == quakes.count()
    own = quakes.filter(F.pmod(F.xxhash64("id"), F.lit(5)) == 3)
    assert tables.landed_keys(own, "earthquakes", path, 3).count() == 0  # a repeat is not held against itself


def test_one_id_lands_once_whatever_its_times(spark, sf_dir, tmp_path):
    quakes = base(spark, sf_dir)["earthquakes"].withColumn("event_time", F.col("event_time").cast("timestamp"))
    path, ids = str(tmp_path / "t"), quakes.count()
    for batch, days in enumerate((0, 2, 40, -400, 4000)):
        part = quakes if batch else quakes.filter("tsunami = 0 AND id NOT LIKE '%7'")
        tables.append_new(part.withColumn("event_time", F.col("event_time") + F.expr(f"INTERVAL {days} DAYS")), "earthquakes", path, batch)
    landed = tables.read_table(spark, "earthquakes", path, batched=True)
    assert landed.count() == landed.select("id").distinct().count() == ids


def test_merged_keys_find_the_same(spark, sf_dir, tmp_path):
    quakes = base(spark, sf_dir)["earthquakes"].withColumn("event_time", F.col("event_time").cast("timestamp"))
    path = str(tmp_path / "t")
    for batch, part in enumerate(quakes.randomSplit([1.0] * 5, 3)):
        tables.write_batch(part, "earthquakes", path, batch)
    keys = lambda: [f for f in log.newest(spark, path).live if f.is_keys]
    assert len(keys()) == 5
    tables.merge_keys(spark, "earthquakes", path, most=3)
    assert sorted(f.level for f in keys()) == [0, 1]
    assert tables.landed_keys(quakes, "earthquakes", path, 9).count() == quakes.count()
    tables.write_batch(quakes, "earthquakes", path, 2)  # merged, so final
    assert tables.read_table(spark, "earthquakes", path, batched=True).count() == quakes.count()


STOPS = ["_rows_written", "_keys_written", "log.commit", "log.put"]


class Stopped(Exception):
    pass


def stop_at(monkeypatch, name, before):
    """Let a step fail before or after it has done its work."""
    owner, step = (log, name.split(".")[1]) if "." in name else (tables, name)
    work = getattr(owner, step)

    def failing(*args, **kwargs):
        if not before:
            work(*args, **kwargs)
        raise Stopped

    monkeypatch.setattr(owner, step, failing)


@pytest.mark.parametrize("name", STOPS)
@pytest.mark.parametrize("before", [True, False])
def test_a_stopped_batch_is_whole_or_not_there(spark, sf_dir, tmp_path, monkeypatch, name, before):
    rows = base(spark, sf_dir)["earthquakes"].limit(6).withColumn("event_time", F.col("event_time").cast("timestamp"))
    rows, path = spark.createDataFrame(rows.collect(), rows.schema), str(tmp_path / "t")
    tables.write_batch(rows.limit(2), "earthquakes", path, 0)
    with monkeypatch.context() as patched:
        stop_at(patched, name, before)
        with pytest.raises(Stopped):
            tables.append_new(rows, "earthquakes", path, 1)
    ids = lambda: sorted(r.id for r in tables.read_table(spark, "earthquakes", path, batched=True).collect())
    assert len(ids()) in (2, 6)
    tables.append_new(rows, "earthquakes", path, 1)
    assert ids() == sorted(r.id for r in rows.collect())


@pytest.mark.parametrize("name", ["log.commit", "log.put", "log.sweep", "log.remove"])
@pytest.mark.parametrize("before", [True, False])
def test_a_stopped_compaction_loses_and_doubles_nothing(spark, sf_dir, tmp_path, monkeypatch, name, before):
    quakes = base(spark, sf_dir)["earthquakes"].withColumn("event_time", F.col("event_time").cast("timestamp"))
    path, day = str(tmp_path / "t"), date(2024, 1, 9)
    rows = quakes.filter(F.to_date("event_time") == F.lit(day)).limit(3)
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    for batch, part in enumerate(rows.collect()):
        tables.write_batch(spark.createDataFrame([part], rows.schema), "earthquakes", path, batch)
    count = lambda: tables.read_table(spark, "earthquakes", path, batched=True).count()
    with monkeypatch.context() as patched:
        stop_at(patched, name, before)
        with pytest.raises(Stopped):
            tables.compact(spark, "earthquakes", path, day)
    assert count() == 3
    tables.compact(spark, "earthquakes", path, day)
    assert count() == 3 and len(glob.glob(f"{path}/event_date={day}/*/*")) == 1


def test_two_writers_both_land(spark, sf_dir, tmp_path):
    quakes = base(spark, sf_dir)["earthquakes"].withColumn("event_time", F.col("event_time").cast("timestamp"))
    path = str(tmp_path / "t")
    tables.write_batch(quakes.filter("tsunami = 1"), "earthquakes", path, 0)
    stale = log.newest(spark, path)
    tables.write_batch(quakes.filter("tsunami = 0"), "earthquakes", path, 1)
    with pytest.raises(log.Taken):
        log.put(spark, path, log.Manifest(version=stale.version + 1))
    late = log.Folder("event_date=2024-01-01/batch_id=7/write=x", 7, day="2024-01-01")
    after = log.commit(spark, path, "batch", lambda now: log.Manifest(settled=now.settled, added=(late,)))
    assert after.version == stale.version + 2 and late in after.live and set(stale.live) < set(after.live)


def test_commit_feed_sends_each_row_once(spark, sf_dir, tmp_path):
    """Not again after compaction, nor what a repeated batch had sent before."""
    quakes = base(spark, sf_dir)["earthquakes"].withColumn("event_time", F.col("event_time").cast("timestamp"))
    path, seen = str(tmp_path / "t"), []
    feed = lambda: jobs.commit_feed(
        spark, {"earthquakes": path}, lambda rows, i: seen.extend(r.id for r in rows.collect()), str(tmp_path / "c"), NOW
    ).awaitTermination(90)
    tables.append_new(quakes.filter("tsunami = 0"), "earthquakes", path, 0)
    feed()
    tables.append_new(quakes.filter("id NOT LIKE '%3'"), "earthquakes", path, 1)
    feed()
    tables.write_batch(quakes.filter("tsunami = 1"), "earthquakes", path, 1)  # the batch again, with more rows
    tables.compact(spark, "earthquakes", path, date(2024, 1, 9), clean=False)
    feed()
    feed()
    assert sorted(seen) == sorted(r.id for r in quakes.select("id").collect())


def test_a_repeated_batch_replaces_itself_on_all_days(spark, sf_dir, tmp_path):
    quakes = base(spark, sf_dir)["earthquakes"].withColumn("event_time", F.col("event_time").cast("timestamp"))
    path, on = str(tmp_path / "t"), lambda day: quakes.filter(F.to_date("event_time") == F.lit(day))
    first, other = on(date(2024, 1, 9)), on(date(2024, 1, 12))
    tables.write_batch(first, "earthquakes", path, 1)
    tables.write_batch(other, "earthquakes", path, 2)
    tables.write_batch(other.limit(1), "earthquakes", path, 1)
    landed = tables.read_table(spark, "earthquakes", path, batched=True)
    assert landed.filter("batch_id = 1").count() == 1
    assert {r[0] for r in landed.select("event_date").distinct().collect()} == {date(2024, 1, 12)}
    # a repeat is held against all other batches, later ones too
    assert tables.landed_keys(other, "earthquakes", path, 1).count() == other.count()


def test_closed_days_are_put_into_one_folder(spark, sf_dir, tmp_path):
    quakes = base(spark, sf_dir)["earthquakes"].withColumn("event_time", F.col("event_time").cast("timestamp"))
    path, day = str(tmp_path / "t"), date(2024, 1, 9)
    rows = quakes.filter(F.to_date("event_time") == F.lit(day))
    for batch, part in enumerate(rows.randomSplit([1.0] * 4, 3)):
        tables.write_batch(part, "earthquakes", path, batch)
    for _ in range(2):
        tables.compact(spark, "earthquakes", path, day)
        assert len(glob.glob(f"{path}/event_date={day}/*")) == 1
        landed = tables.read_table(spark, "earthquakes", path, batched=True)
        assert sorted(r["id"] for r in landed.collect()) == sorted(r["id"] for r in rows.collect())


def test_near_repeats_by_state_others_by_the_index(spark, sf_dir, tmp_path):
    """State is bounded by its span; rows far behind in time are first sightings all the same."""
    kind, df = "pollution", base(spark, sf_dir)["pollution"].drop("event_time")
    twice = df.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
    topics.land_messages(twice.repartitionByRange(4, F.desc("measured_at"), "_copy").drop("_copy"), kind, str(tmp_path))
    wanted, held = df.select(*NATURAL_KEY[kind]).distinct().count(), {}
    for span in ("0 seconds", None):
        read = streams.typed(streams.file_stream(spark, kind, str(tmp_path), max_files=1), kind)
        rows, table = streams.without_near_repeats(read, kind, span), str(tmp_path / f"t{span}")
        query = jobs.append_new_stream(rows, kind, table, str(tmp_path / f"c{span}"), NOW)
        query.awaitTermination(180)
        assert tables.read_table(spark, kind, table, batched=True).count() == wanted
        held[span] = query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
        assert all(p["stateOperators"][0]["numRowsDroppedByWatermark"] == 0 for p in query.recentProgress if p["stateOperators"])
    assert held["0 seconds"] < wanted / 2 and held[None] == wanted


def test_all_kinds_have_a_schema():
    assert set(STREAM_SCHEMA) == set(KINDS) == set(NATURAL_KEY)


def test_merged_predictions_are_one_row_per_zone(spark, sf_dir, tmp_path):
    runs, path = fixtures.prediction_runs(fixtures.events(spark, sf_dir)), str(tmp_path / "current")
    days = sorted(r[0] for r in runs.select(F.substring("predicted_at", 1, 10)).distinct().collect())
    for day in days[:5]:
        tables.merge_predictions(runs.filter(F.col("predicted_at").startswith(day)), path)
    wanted = tables.latest_predictions(runs.filter(F.substring("predicted_at", 1, 10).isin(*days[:5])))
    found = tables.current_predictions(spark, path).select(wanted.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


PREDICTION = "zone_lat double, zone_lon double, ml_risk_score double, ml_risk_label string, predicted_at string"


def globe_of(spark, score, stamp, where="true"):
    """A prediction for every zone of the globe for which ``where`` holds."""
    zones = spark.range(180 * 360).selectExpr("CAST(id DIV 360 - 90 AS DOUBLE) AS zone_lat", "CAST(id % 360 - 180 AS DOUBLE) AS zone_lon")
    return zones.filter(where).selectExpr("*", f"CAST({score} AS DOUBLE) AS ml_risk_score", "'low' AS ml_risk_label", f"'{stamp}' AS predicted_at")


def test_a_run_of_one_region_rewrites_its_tiles_only(spark, tmp_path):
    path = str(tmp_path / "current")
    tables.merge_predictions(globe_of(spark, 0.1, "2024-01-01"), path)
    before = set(log.newest(spark, path).live)
    assert len(before) == 18 * 36
    region = "zone_lat BETWEEN 10 AND 34 AND zone_lon BETWEEN -20 AND 4"  # one in a hundred zones
    tables.merge_predictions(globe_of(spark, 0.9, "2024-01-02", region), path)
    after = set(log.newest(spark, path).live)
    assert len(after) == len(before) and len(after - before) == 9
    tables.merge_predictions(globe_of(spark, 0.5, "2024-01-01 12:00", region), path)  # late, and older
    got = tables.current_predictions(spark, path)
    assert got.count() == 180 * 360 and got.filter("ml_risk_score = 0.9").count() == got.filter(region).count() == 25 * 25
    assert got.select(*ZONE).distinct().count() == 180 * 360
    tables.merge_predictions(got.filter("false"), path)
    assert tables.current_predictions(spark, path).count() == 180 * 360


def test_a_merge_that_stops_or_is_overtaken_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "current")
    one = lambda score, stamp, lon=0.5: spark.createDataFrame([(0.5, lon, score, "low", stamp)], PREDICTION)
    tables.merge_predictions(one(0.1, "2024-01-01"), path)
    tables.merge_predictions(spark.createDataFrame([(None, 1.0, 0.2, "low", "2024-01-01")], PREDICTION), path)
    real = log.put

    def stopped(*args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(log, "put", stopped)
    with pytest.raises(RuntimeError):
        tables.merge_predictions(one(0.9, "2024-01-03"), path)
    monkeypatch.setattr(log, "put", real)
    assert sorted(r["ml_risk_score"] for r in tables.current_predictions(spark, path).collect()) == [0.1, 0.2]

    overtaken = []

    def late(*args):
        if not overtaken:
            overtaken.append(True)
            tables.merge_predictions(one(0.7, "2024-01-05", 1.5), path)
        return real(*args)

    monkeypatch.setattr(log, "put", late)
    tables.merge_predictions(one(0.8, "2024-01-04"), path)
    assert sorted(r["ml_risk_score"] for r in tables.current_predictions(spark, path).collect()) == [0.2, 0.7, 0.8]
    log.sweep(spark, path, "tile=*/write=*")
    assert sorted(r["ml_risk_score"] for r in tables.current_predictions(spark, path).collect()) == [0.2, 0.7, 0.8]
