"""Properties of the operators that a single SQL text does not show."""

import json
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from hazgrid import fixtures
from hazgrid.functions import clock, encode, grid
from hazgrid.operators import dedup, features, metrics, profile, rollup, serving, split, zones
from hazgrid.operators.ranking import running_totals
from hazgrid.plans import layers
from hazgrid.schemas import FEATURES, LABEL, NATURAL_KEY, ZONE
from hazgrid.sinks import exports, tables


@pytest.fixture(scope="module")
def t(spark, sf_dir):
    return fixtures.base_tables(spark, sf_dir)


def as_rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def rounded(df):
    return df.select(*(F.round(c, 6).alias(c) if d == "double" else c for c, d in df.dtypes))


def test_cells_round_half_to_even_without_negative_zero(spark):
    df = spark.createDataFrame([(x,) for x in (0.5, 1.5, 2.5, -0.5, -0.2, -1.5, 179.5)], "x double")
    got = [r[0] for r in df.select(grid.cell(F.col("x"))).collect()]
    assert got == [0.0, 2.0, 2.0, 0.0, 0.0, -2.0, 180.0]
    assert not any(np.signbit(v) for v in got if v == 0)


def test_hours_count_marks_not_elapsed_time(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 10:59:00' a, TIMESTAMP_NTZ'2024-01-01 11:01:00' b")
    assert df.select(clock.hours_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_fixed_decimals_follow_the_binary_value(spark):
    values = [0.95, 0.25, 1.005, -0.0000004, 1e20, 123456.7890625, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [tuple(r) for r in df.select(encode.fixed(F.col("x"), 1), encode.fixed(F.col("x"), 6)).collect()]
    want = [(None, None) if v is None else (f"{v:.1f}", f"{v:.6f}") for v in values]
    assert got == want


def test_tsv_cleans_text(spark, tmp_path):
    df = spark.createDataFrame([("a\tb\nc\rd", None, 1.5, 7)], "s string, n string, x double, i int")
    exports.write_tsv(df, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first()[0] == "a b cd\t\\N\t1.500000\t7"


def test_zone_forms_agree_and_zones_are_unique(t):
    staged = layers.staged(t.quakes, t.fires, t.air)
    one, two = (f(*staged, t.as_of) for f in (zones.active_zones, zones.active_zones_joined))
    assert as_rows(rounded(one)) == as_rows(rounded(two))
    assert one.select(*ZONE).distinct().count() == one.count()


def test_feature_forms_agree(t):
    for hours in (24, 7 * 24):
        args = (t.quakes, t.fires, t.air, t.as_of, hours)
        assert as_rows(rounded(features.training_set(*args))) == as_rows(rounded(features.training_set_joined(*args)))


def test_label_horizon_must_fit(t):
    with pytest.raises(ValueError):
        features.training_set(t.quakes, t.fires, t.air, t.as_of, label_hours=24 * 8)


def test_one_group_holding_most_rows(spark):
    """A hot zone, a hot key and a hot score give whole results."""
    n = 60_000
    hot = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("id"),
        F.lit(1.0).alias("mag"), F.lit("2024").alias("ingested_at"),
    )
    assert dedup.distinct_events(hot, "earthquakes").count() == n - n // 3 + 1
    landed = spark.createDataFrame([("hot",), ("k1",)], "id string")
    assert dedup.new_events(hot, landed, "earthquakes").count() == n - n // 3 - 1


def test_group_limit_runs_before_the_shuffle(t):
    plan = dedup.distinct_events(t.quakes, "earthquakes")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_new_events_shuffles_once(t):
    plan = dedup.new_events(t.quakes, t.quakes, "earthquakes")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("Partial")


def test_missing_key_parts_are_equal(spark):
    schema = "lat double, lon double, acq_date string, acq_time string, satellite string, ingested_at string"
    rows = spark.createDataFrame([(None, 1.0, "d", "t", "N", "1")], schema)
    assert dedup.new_events(rows, rows.select(*NATURAL_KEY["wildfires"]), "wildfires").count() == 0


def brute_auc(rows):
    pos, neg = [s for y, s in rows if y == 1], [s for y, s in rows if y == 0]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def brute_ap(rows):
    total, out = sum(y for y, _ in rows), 0.0
    seen_before = 0
    for cut in sorted({s for _, s in rows}, reverse=True):
        taken = [y for y, s in rows if s >= cut]
        out += (sum(taken) - seen_before) / total * (sum(taken) / len(taken))
        seen_before = sum(taken)
    return out


@pytest.mark.parametrize("spread", [1, 7, 1e9])
def test_auc_and_ap_equal_brute_force(spark, spread):
    rng = random.Random(5)
    rows = [(int(rng.random() < 0.3), round(rng.random() ** 4 * spread, 3)) for _ in range(900)]
    rows += [(i % 2, 0.5) for i in range(450)]  # a third of all rows at one score
    df = spark.createDataFrame(rows, "y int, s double").repartition(8)
    assert metrics.ranking(df, "y", "s").first()["roc_auc"] == pytest.approx(brute_auc(rows), abs=1e-12)
    assert metrics.ranking(df, "y", "s").first()["average_precision"] == pytest.approx(brute_ap(rows), abs=1e-12)
    judge = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0)
    assert judge.evaluate(df) == pytest.approx(brute_auc(rows), abs=1e-9)


@pytest.mark.parametrize("seed", range(4))
def test_measures_stay_in_range_with_gaps(spark, seed):
    rng = random.Random(seed)
    draw = lambda: rng.choice([None, float("nan"), 0.0, -0.0, 0.5, rng.random(), float("inf"), float("-inf")])
    rows = [(rng.choice([0, 1, 1, None]), draw()) for _ in range(120)]
    row = metrics.ranking(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()
    known = [(y, s) for y, s in rows if y is not None and s is not None and s == s]
    assert row["positives"] + row["negatives"] == len(known)
    assert row["unscored"] == sum(y is not None for y, _ in rows) - len(known)
    assert 0 <= row["average_precision"] <= 1 and row["roc_auc"] == pytest.approx(brute_auc(known), abs=1e-12)


def test_auc_needs_both_classes(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, s double")
    row = metrics.ranking(df, "y", "s").first()
    assert row["roc_auc"] is None and row["average_precision"] is None


def test_report_without_predictions_of_a_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, p int")
    got = {r["row"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert (got["1"]["precision"], got["1"]["recall"], got["1"]["f1"], got["1"]["support"]) == (0, 0, 0, 1)
    assert got["accuracy"]["f1"] == pytest.approx(2 / 3) and got["macro avg"]["recall"] == 0.5


def test_running_totals(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.randrange(5), i, rng.randrange(10)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, block int, i int, v int")
    got = {r["i"]: r["before"] for r in running_totals(df, "block", [F.col("i")], {"v": "before"}, within=["g"]).collect()}
    for g, block, i, _ in rows:
        assert got[i] == sum(v for g2, b2, i2, v in rows if g2 == g and (b2, i2) < (block, i))


def test_split_is_exact_stratified_and_repeatable(spark):
    rows = spark.range(1000).select(
        (F.col("id") % 100).cast("double").alias("zone_lat"), F.floor(F.col("id") / 100).cast("double").alias("zone_lon"),
        F.when(F.col("id") < 130, 1).otherwise(0).alias(LABEL),
    )
    marked = split.stratified_split(rows)
    got = {(r[LABEL], r["is_train"]): r["n"] for r in marked.groupBy(LABEL, "is_train").agg(F.count("*").alias("n")).collect()}
    assert got == {(1, True): 104, (1, False): 26, (0, True): 696, (0, False): 174}
    assert as_rows(marked) == as_rows(split.stratified_split(rows.repartition(5)))
    assert as_rows(marked) != as_rows(split.stratified_split(rows, seed=7))
    few = rows.withColumn(LABEL, F.when(F.col("zone_lat") + F.col("zone_lon") < 1, 1).otherwise(0))
    assert split.stratified_split(few).filter("is_train").count() == 800


@pytest.mark.parametrize("positives", [0, 3, 50])
def test_split_plans_no_product(spark, positives):
    rows = spark.range(200).select(
        F.col("id").cast("double").alias("zone_lat"), F.lit(0.0).alias("zone_lon"), (F.col("id") < positives).cast("int").alias(LABEL)
    )
    marked = split.stratified_split(rows)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert marked.filter("is_train").count() == 160


def test_class_weight_without_positives(spark):
    df = spark.createDataFrame([(0,), (0,)], f"{LABEL} int")
    assert features.class_weight(df).first()["scale_pos_weight"] == 1.0
    assert [tuple(r) for r in features.label_distribution(df).collect()] == [(0, 2, 0.0)]


def test_pull_walks_the_whole_table_in_steps(t):
    """The compound cursor visits every row once, also rows that share a time."""
    same = t.quakes.withColumn("event_time", F.date_trunc("DAY", "event_time").cast("timestamp_ntz"))
    cursor, seen = (datetime(1970, 1, 1), None), []
    while True:
        page = serving.pull_since(same, "earthquakes", cursor[0], limit=40, last_key=cursor[1])
        after = serving.next_cursor(page, "earthquakes", *cursor)
        if after == cursor:
            break
        seen += [r["id"] for r in page.collect()]
        cursor = after
    assert len(seen) == len(set(seen)) == same.count()


def test_pages_are_those_of_the_pulls(t):
    same = t.quakes.withColumn("event_time", F.date_trunc("DAY", "event_time").cast("timestamp_ntz"))
    got = {r["id"]: r["page"] for r in serving.pages(same, "earthquakes", 40).collect()}
    cursor, page = (datetime(1970, 1, 1), None), 0
    while page < 3:
        pulled = serving.pull_since(same, "earthquakes", cursor[0], limit=40, last_key=cursor[1])
        assert {got[r["id"]] for r in pulled.collect()} == {page}
        cursor, page = serving.next_cursor(pulled, "earthquakes", *cursor), page + 1
    assert len(got) == same.count() and max(got.values()) == (len(got) - 1) // 40


@pytest.mark.parametrize("hours", [0, 11.5, 24 * 9])
def test_rolled_days_equal_a_rebuild(spark, t, tmp_path, hours):
    staged, as_of = layers.staged(t.quakes, t.fires, t.air), t.as_of - timedelta(hours=hours)
    rollup.store_days(rollup.zone_days(*staged), str(tmp_path))
    rollup.store_days(rollup.zone_days(*staged).filter(F.col("day") == F.lit(as_of.date())), str(tmp_path))  # one day again
    days = rollup.read_days(spark, str(tmp_path))
    rolled = rollup.active_zones(days, *staged, as_of)
    assert as_rows(rounded(rolled)) == as_rows(rounded(zones.active_zones(*staged, as_of)))
    for horizon in (0.2, 1):
        short = rollup.active_zones(days, *staged, as_of, horizon)
        assert as_rows(rounded(short)) == as_rows(rounded(zones.active_zones(*staged, as_of, horizon)))


def test_rolled_days_read_few_rows(spark, t, tmp_path):
    staged = layers.staged(t.quakes, t.fires, t.air)
    rollup.store_days(rollup.zone_days(*staged), str(tmp_path))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = rollup.active_zones(rollup.read_days(spark, str(tmp_path)), *staged, t.as_of)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Or(LessThan(ts") == 3 and "PartitionFilters: [isnotnull(day" in plan


def test_cursor_stays_when_nothing_is_new(t):
    pulled = serving.pull_since(t.quakes, "earthquakes", t.as_of)
    assert serving.next_cursor(pulled, "earthquakes", t.as_of) == (t.as_of, None)
    before = t.as_of - timedelta(days=2)
    assert serving.next_cursor(serving.pull_since(t.quakes, "earthquakes", before), "earthquakes", before)[0] > before


def test_envelope_keeps_order(t):
    top = serving.recent_quakes(t.quakes, t.as_of, hours=24 * 30, limit=5)
    out = encode.envelope(top.withColumn("at", F.col("event_time").cast("timestamp_ntz")), -F.unix_timestamp("at"), F.col("id")).first()
    data = json.loads(out["data"])
    assert out["count"] == 5 == len(data)
    assert [d["id"] for d in data] == [r["id"] for r in top.collect()]
    assert "T" in data[0]["at"] and "alert" in data[0]


def test_horizon_reaches_the_scan(spark, t):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = layers.mart(t.quakes, t.fires, t.air, t.as_of)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(ts") == 3 and plan.count("Exchange") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_no_query_plans_a_product(spark, sf_dir):
    from hazgrid import catalog

    for name, query in catalog.queries().items():
        if name not in catalog.MODEL_QUERIES and not name.startswith("stream_"):
            plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_layers_as_views_and_stored_mart(spark, t):
    for name, df in zip(layers.SOURCES, (t.quakes, t.fires, t.air)):
        df.createOrReplaceTempView(name)
    layers.register_views(spark, t.as_of)
    assert spark.table("stg_earthquakes").count() <= t.quakes.count()
    for _ in range(2):
        layers.build_mart(spark, t.as_of)
    stored = spark.table("mart_risk_zones")
    assert as_rows(rounded(stored)) == as_rows(rounded(layers.mart(t.quakes, t.fires, t.air, t.as_of)))
    assert serving.top_risk_zones(stored, 3).count() == 3
    scores = [r[0] for r in spark.sql("SELECT raw_risk_score FROM mart_risk_zones").collect()]
    assert scores == sorted(scores, reverse=True)


def test_stored_tables_give_the_same_results(spark, t, tmp_path):
    """Tables on disk have zone-aware times and date folders; results do not depend on that."""
    for name, df in zip(layers.SOURCES, (t.quakes, t.fires, t.air)):
        tables.write_batch(df.withColumn("event_time", F.col("event_time").cast("timestamp")), name, f"{tmp_path}/{name}", 0)
    layers.open_sources(spark, str(tmp_path))
    stored = [spark.table(name) for name in layers.SOURCES]
    base = (t.quakes, t.fires, t.air)

    def same(a, b):
        zone_free = [F.col(c).cast("timestamp_ntz").alias(c) if d == "timestamp" else c for c, d in a.dtypes]
        assert as_rows(rounded(a.select(zone_free))) == as_rows(rounded(b))

    same(layers.mart(*stored, t.as_of), layers.mart(*base, t.as_of))
    same(zones.active_zones_joined(*layers.staged(*stored), t.as_of).drop("event_date"), zones.active_zones_joined(*layers.staged(*base), t.as_of))
    same(features.training_set(*stored, t.as_of), features.training_set(*base, t.as_of))
    same(serving.recent_quakes(stored[0], t.as_of), serving.recent_quakes(t.quakes, t.as_of))
    same(serving.global_stats(*stored, t.as_of), serving.global_stats(*base, t.as_of))
    same(serving.latest_air(stored[2], t.as_of), serving.latest_air(t.air, t.as_of))
    cursors = dict.fromkeys(layers.SOURCES, t.as_of - timedelta(days=3))
    same(serving.event_feed(*stored, cursors), serving.event_feed(*base, cursors))


def test_prediction_store_keeps_the_newest(spark, tmp_path):
    schema = "zone_lat double, zone_lon double, ml_risk_score double, ml_risk_label string, predicted_at string"
    path = str(tmp_path / "runs")
    tables.append_predictions(spark.createDataFrame([(1.0, 2.0, 0.3, "moderate", "2024-01-01")], schema), path, "a")
    newer = [(1.0, 2.0, 0.9, "critical", "2024-01-02"), (3.0, 4.0, 0.1, "low", "2024-01-02")]
    for _ in range(2):
        tables.append_predictions(spark.createDataFrame(newer, schema), path, "b")
    got = tables.read_predictions(spark, path).orderBy("zone_lat").collect()
    assert [(r["zone_lat"], r["ml_risk_score"]) for r in got] == [(1.0, 0.9), (3.0, 0.1)]


def test_profile(spark, t):
    rows = {r["column_name"]: r for r in profile.source_profile(t.quakes, "q").collect()}
    assert set(rows) == set(t.quakes.columns)
    assert rows["lat"]["nulls"] == t.quakes.filter("lat IS NULL").count()
    header, sample = profile.first_look(t.quakes, 2)
    assert header == t.quakes.columns and sample.count() == 2


def test_features_are_complete(t):
    rows = features.zone_features(t.quakes, t.fires, t.air, t.as_of)
    assert tuple(rows.columns) == FEATURES
    assert rows.filter(" OR ".join(f"{c} IS NULL" for c in FEATURES)).count() == 0
