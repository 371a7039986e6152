"""Parsers on small landing files, flaws included."""

import json

import pytest
from pyspark.sql import functions as F

from hazgrid.operators import normalize
from hazgrid.plans.ingest import ingest, judged
from hazgrid.sinks.tables import read_table
from hazgrid.sources import landing

STAMP = "2024-05-01T00:00:00+00:00"


def feature(id="q1", mag=4.5, coordinates=(10.5, -3.2, 12.0), **properties):
    base = {"mag": mag, "time": 1714500000123, "place": "here", "alert": None, "tsunami": 1, "sig": 300,
            "status": "reviewed", "magType": "mb", "net": "ak"}
    base.update(properties)
    base = {k: v for k, v in base.items() if v != "absent"}
    return {"type": "Feature", "id": id, "properties": base, "geometry": {"type": "Point", "coordinates": list(coordinates)}}


@pytest.fixture
def quake_dir(tmp_path):
    features = [
        feature(),
        feature(),  # exact duplicate
        feature("q2", place="absent", status="absent", magType="absent", net="absent", tsunami="absent", sig="absent"),
        feature("q3", place=None, net=None),
        feature("q4", mag=None),
        feature("q5", mag="strong"),
        feature("q6", mag="3.5"),
        feature("q7", coordinates=(1.0, 2.0)),
        feature("", mag=1.0),
        feature("q8", time="absent"),
        feature("q9", sig="lots"),
        feature("q10", mag=-0.4),
    ]
    (tmp_path / "a.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    (tmp_path / "b.json").write_text('{"type": "FeatureCollection", "features": [')
    (tmp_path / "c.json").write_text(json.dumps({"type": "FeatureCollection", "features": []}))
    return str(tmp_path)


def compact(value):
    return json.dumps(value, separators=(",", ":"))


def test_documents_cut_at_their_records(spark, quake_dir, tmp_path_factory):
    """The same rows as from whole documents, however these are written."""
    whole = landing.quake_files(spark, quake_dir)
    wanted = sorted(map(str, whole.filter("_corrupt_record IS NULL").collect()))
    features = json.loads(open(f"{quake_dir}/a.json").read())["features"]
    texts = {
        "close": compact({"type": "FeatureCollection", "features": features}),
        "tail": compact({"type": "FeatureCollection", "metadata": {"count": 12}, "features": features, "bbox": [1, [2]]}),
        "wide": json.dumps({"type": "FeatureCollection", "features": features}, indent=1),
        "lines": '{"features": [\n' + " ,\n".join(map(compact, features)) + "\n] }\n",
        # some features begin otherwise
        "mixed": '{"features":[' + ",".join((json.dumps if i % 3 else compact)(f) for i, f in enumerate(features)) + "]}",
        "late": '{"features":[' + ",".join((compact if i % 3 else json.dumps)(f) for i, f in enumerate(features)) + "]}",
    }
    for name, text in texts.items():
        path = tmp_path_factory.mktemp(name)
        (path / "a.json").write_text(text)
        (path / "b.json").write_text('{"type":"FeatureCollection","features":[]}')
        (path / "c.json").write_text("")
        got = landing.quake_files(spark, str(path), record_start=landing.QUAKE_START)
        assert got.columns == whole.columns
        assert sorted(map(str, got.collect())) == wanted, name


def test_cut_off_documents_keep_their_whole_records(spark, tmp_path):
    text = compact({"type": "FeatureCollection", "features": [feature(f"q{i}") for i in range(9)]})
    (tmp_path / "in-a-record.json").write_text(text[: text.rindex('"geometry"') - 4])
    (tmp_path / "at-a-comma.json").write_text(text[: text.rindex('"geometry"')])  # a corrupt record, and no end
    (tmp_path / "between.json").write_text(text[: text.rindex('{"type"')])
    (tmp_path / "envelope.json").write_text('{"type":"FeatureCollection","features":[')
    (tmp_path / "noise.json").write_text("not JSON at all")
    rows = landing.quake_files(spark, str(tmp_path), record_start=landing.QUAKE_START).collect()
    assert sorted(r["id"] for r in rows if r["_corrupt_record"] is None) == sorted([f"q{i}" for i in range(8)] * 3)
    assert len([r for r in rows if r["_corrupt_record"] is not None]) == 6


def test_one_document_is_read_by_many_tasks(spark, tmp_path):
    text = compact({"type": "FeatureCollection", "features": [feature(f"q{i}") for i in range(20_000)]})
    (tmp_path / "one.json").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(len(text) // 10))
    try:
        rows = landing.quake_files(spark, str(tmp_path), record_start=landing.QUAKE_START)
        tasks = rows.filter("id IS NOT NULL").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(tasks) >= 8 and sum(r["count"] for r in tasks) == 20_000 and max(r["count"] for r in tasks) < 4_000


def test_quakes(spark, quake_dir):
    rows = normalize.quake_candidates(landing.quake_files(spark, quake_dir), STAMP).collect()
    by_reason = {}
    for r in rows:
        by_reason.setdefault(r["reject_reason"], []).append(r["id"])
    assert sorted(by_reason[None]) == ["q1", "q1", "q10", "q2", "q3", "q6"]
    assert by_reason["no_magnitude"] == ["q4"]
    assert sorted(by_reason["unparsable"]) == ["q5", "q7", "q8", "q9"]
    assert by_reason["no_id"] == [""]
    assert len(by_reason["malformed"]) == 1
    bare = next(r for r in rows if r["id"] == "q2")
    assert (bare["place"], bare["status"], bare["mag_type"], bare["net"], bare["tsunami"], bare["sig"]) == (
        "", "automatic", "", "us", 0, 0)
    good = next(r for r in rows if r["id"] == "q1")
    assert (good["mag"], good["lon"], good["lat"], good["depth_km"], good["time_ms"]) == (4.5, 10.5, -3.2, 12.0, 1714500000123)
    assert good["alert"] is None and good["ingested_at"] == STAMP


HEADER = "latitude,longitude,bright_ti4,scan,track,acq_date,acq_time,satellite,instrument,confidence,version,frp,daynight"


def fire(confidence="nominal", acq_time="0048", latitude="1.5", frp="12.5"):
    return f"{latitude},2.5,330.1,0.4,0.5,2024-04-26,{acq_time},N,VIIRS,{confidence},2.0,{frp},D"


@pytest.fixture
def fire_dir(tmp_path):
    rows = [
        fire(), fire(), fire("LOW"), fire("low"), fire("High", "48"), fire("", "7"), fire("nominal", "12345"),
        fire("nominal", "2570"), fire(latitude="north"), fire(frp=""), "1.0,2.0",
    ]
    (tmp_path / "f.csv").write_text("\n".join([HEADER, *rows]) + "\n")
    return str(tmp_path)


def test_fires(spark, fire_dir):
    rows = judged(spark, "wildfires", fire_dir, STAMP).collect()
    good = [r for r in rows if r["reject_reason"] is None]
    assert sorted((r["confidence"], r["acq_time"]) for r in good) == [
        ("high", "0048"), ("nominal", "0007"), ("nominal", "0048"), ("nominal", "0048")]
    reasons = [r["reject_reason"] for r in rows if r["reject_reason"]]
    assert sorted(reasons) == ["low_confidence"] * 2 + ["no_event_time"] * 2 + ["unparsable"] * 3
    # five characters are kept whole, not cut to a valid time
    assert "12345" in [r["acq_time"] for r in rows if r["reject_reason"] == "no_event_time"]
    assert next(r for r in good if r["confidence"] == "high")["event_time"].isoformat() == "2024-04-26T00:48:00"


def test_fires_are_read_by_each_files_own_header(spark, tmp_path):
    names, cells = HEADER.split(","), fire("high", frp="7.5").split(",")
    (tmp_path / "a.csv").write_text(HEADER + "\n" + fire() + "\n")
    (tmp_path / "b.csv").write_text(",".join(reversed(names)) + "\n" + ",".join(reversed(cells)) + "\n\n")
    (tmp_path / "c.csv").write_text(",".join(names[:-1]) + "\n" + ",".join(cells[:-1]) + "\n")
    (tmp_path / "d.csv").write_text(fire() + "\n")
    rows = {(r["frp"], r["daynight"], r["latitude"], r["_corrupt_record"]) for r in landing.fire_files(spark, str(tmp_path)).collect()}
    assert rows == {
        ("12.5", "D", "1.5", None), ("7.5", "D", "1.5", None), ("7.5", None, "1.5", None), (None, None, None, fire()),
    }


def result(value=10.0, utc="2024-04-26T10:00:00Z", sensor=7, place=(1.0, 2.0), **more):
    body = {"value": value, "sensorsId": sensor, "locationsId": 70, "datetime": {"utc": utc},
            "coordinates": {"latitude": place[0], "longitude": place[1]} if place else None}
    body.update(more)
    return {k: v for k, v in body.items() if v != "absent"}


@pytest.fixture
def air_dir(tmp_path):
    def put(country, parameter, results):
        folder = tmp_path / f"country_id={country}" / f"parameter_id={parameter}"
        folder.mkdir(parents=True)
        (folder / "page1.json").write_text(results if isinstance(results, str) else json.dumps({"results": results}))

    put(22, 2, [result(), result(), result(None), result(-1.0), result(0.0, sensor=8), result(place=None),
                result(place=(None, 2.0)), result(utc=""), result(datetime=None), result("much")])
    put(108, 3, [result(sensorsId="absent", locationsId="absent")])
    put(59, 5, "{not json")
    return str(tmp_path)


def test_air(spark, air_dir):
    rows = judged(spark, "pollution", air_dir, STAMP).collect()
    good = [r for r in rows if r["reject_reason"] is None]
    assert sorted((r["country"], r["parameter"], r["sensor_id"], r["location_id"], r["value"]) for r in good) == [
        ("France", "pm25", "7", "70", 10.0), ("France", "pm25", "7", "70", 10.0), ("France", "pm25", "8", "70", 0.0),
        ("Indonesia", "o3", "unknown", "", 10.0)]
    assert {r["unit"] for r in good} == {"µg/m³"}
    reasons = sorted(r["reject_reason"] for r in rows if r["reject_reason"])
    assert reasons == ["malformed", "negative_value", "no_position", "no_position", "no_time", "no_time", "no_value", "unparsable"]


def test_ingest_twice_lands_once(spark, quake_dir, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    table, rejects = str(out / "table"), str(out / "rejects")
    first = ingest(spark, "earthquakes", quake_dir, table, rejects, run=0, ingested_at=STAMP).first()
    assert (first["total_features"], first["sent"], first["rejected"], first["landed"]) == (13, 6, 7, 5)
    again = ingest(spark, "earthquakes", quake_dir, table, rejects, run=1, ingested_at=STAMP).first()
    assert (again["sent"], again["landed"]) == (6, 0)
    landed = read_table(spark, "earthquakes", table, batched=True)
    assert sorted(r["id"] for r in landed.collect()) == ["q1", "q10", "q2", "q3", "q6"]
    # repeating a run replaces its rows
    ingest(spark, "earthquakes", quake_dir, table, rejects, run=0, ingested_at=STAMP)
    assert read_table(spark, "earthquakes", table, batched=True).count() == 5
    assert spark.read.parquet(f"{rejects}/earthquakes").count() == 14
