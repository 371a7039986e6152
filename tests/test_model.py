"""Training, scoring, storing and explaining, with a small model."""

import itertools
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazgrid import fixtures
from hazgrid.functions.classify import risk_label
from hazgrid.ml import explain, model
from hazgrid.operators import features
from hazgrid.schemas import FEATURES, LABEL, ZONE
from hazgrid.sinks import exports


@pytest.fixture(scope="module")
def trained(spark):
    from conftest import TESTDATA

    t = fixtures.base_tables(spark, f"{TESTDATA}/sf0.01")
    rows = features.training_set(t.quakes, t.fires, t.air, t.as_of)
    return model.train(rows, model.BoostParams(trees=6, depth=3))


@pytest.fixture(scope="module")
def stored(trained, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model"))
    model.save(trained, path)
    return path


def test_defaults_are_the_fixed_ones():
    assert model.BoostParams() == model.BoostParams(200, 5, 0.05, 0.8, 0.8, 42)


def test_refuses_too_few_zones(spark, trained):
    with pytest.raises(model.TooFewZones):
        model.train(trained.zones.limit(9))


def test_split_sizes(trained):
    assert trained.zones.count() == trained.n_zones == 147
    assert trained.holdout.count() == 29


def test_every_zone_is_scored_and_labelled(trained):
    rows = sorted(model.predictions(trained.model, trained.zones).collect(), key=lambda r: r["ml_risk_score"])
    assert len(rows) == trained.n_zones
    assert 0 <= rows[0]["ml_risk_score"] and rows[-1]["ml_risk_score"] <= 1
    ladder = ["low", "moderate", "high", "critical"]
    steps = [ladder.index(r["ml_risk_label"]) for r in rows]
    assert steps == sorted(steps)


def test_label_bounds_belong_to_the_lower_label(spark):
    table = [
        (0.0, "low"), (0.2, "low"), (0.2000001, "moderate"), (0.4, "moderate"), (0.4000001, "high"), (0.7, "high"),
        (0.7000001, "critical"), (1.0, "critical"),
    ]
    rows = spark.createDataFrame(table, "score double, expected string").select("expected", risk_label(F.col("score")).alias("found"))
    assert [r["found"] for r in rows.collect()] == [expected for _, expected in table]


def test_score_is_the_logistic_of_twice_the_margin(trained):
    for r in model.scored(trained.model, trained.zones).limit(20).collect():
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-2 * r["margin"])), abs=1e-12)


def test_metadata_and_reload(spark, trained, stored):
    meta = json.loads(spark.read.text(f"{stored}/meta").first()[0])
    assert meta["n_zones"] == 147 and meta["n_features"] == 14 and meta["features"] == list(FEATURES)
    strengths = list(meta["feature_importance"].values())
    assert sum(strengths) == pytest.approx(1) and meta["positive_rate"] == pytest.approx(42 / 147)
    again = model.predictions(model.load(stored), trained.zones).select(F.sum("ml_risk_score")).first()[0]
    assert again == pytest.approx(model.predictions(trained.model, trained.zones).select(F.sum("ml_risk_score")).first()[0])


def test_importances_are_sorted(spark, trained):
    rows = model.importances(spark, trained.model).collect()
    assert {r["feature"] for r in rows} == set(FEATURES)
    assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)


def test_evaluation(trained):
    report, ranking = model.evaluation(trained.model, trained.holdout)
    assert report.filter("row = 'accuracy'").first()["support"] == 29
    row = ranking.first()
    assert 0 <= row["roc_auc"] <= 1 and 0 < row["average_precision"] <= 1


def test_contributions_add_up_to_the_margin(trained, stored):
    out = explain.explained(trained.zones, stored)
    total = F.col("base_value") + F.aggregate(F.map_values("shap_values"), F.lit(0.0), lambda a, b: a + b)
    assert out.count() == trained.n_zones
    assert out.select(F.max(F.abs(total - F.col("margin")))).first()[0] < 1e-9


def test_leaves_in_a_table_give_the_same(spark, trained, stored):
    held = lambda r: [r["shap_values"][f] for f in FEATURES]
    want = {(r[0], r[1]): r for r in explain.explained(trained.zones, stored).select(*ZONE, "base_value", "shap_values").collect()}
    larger = explain.explained(trained.zones, stored, most=10)  # as if the model had too many nodes to broadcast
    assert {(r["zone_lat"], r["zone_lon"]) for r in larger.collect()} == want.keys()
    # several blocks of rows and chunks of leaves
    leaves = explain.settled(explain.leaf_table(spark, stored, trained.model), "leaves")
    known = model.scored(trained.model, trained.zones.select(*FEATURES))
    dealt = explain.with_summed_contributions(known, leaves, per_block=20, per_chunk=300)
    assert dealt.columns == [*known.columns, "contribution"]
    for r in dealt.collect():
        assert r["contribution"] == pytest.approx(held(want[r["zone_lat"], r["zone_lon"]]), abs=1e-9)
    for r in larger.collect():
        assert r["base_value"] == pytest.approx(want[r["zone_lat"], r["zone_lon"]]["base_value"], abs=1e-9)
        assert held(r) == pytest.approx(held(want[r["zone_lat"], r["zone_lon"]]), abs=1e-9)


def test_every_leaf_meets_every_block(spark, trained, stored):
    """Also with fewer rows than blocks, and for a table without rows."""
    leaves = explain.settled(explain.leaf_table(spark, stored, trained.model), "leaves")
    boxes = explain.model_boxes(spark, stored, trained.model)
    assert leaves.count() == len(boxes.value)
    assert leaves.agg(F.sum("expected")).first()[0] == pytest.approx(boxes.base, abs=1e-9)
    one = model.scored(trained.model, trained.zones.select(*FEATURES)).limit(1)
    [row] = explain.with_summed_contributions(one, leaves, per_block=1, per_chunk=50).collect()
    assert boxes.base + sum(row["contribution"]) == pytest.approx(row["margin"], abs=1e-9)
    assert explain.with_summed_contributions(one.filter("false"), leaves).count() == 0


def conditional_value(nodes, weight, x, known):
    """Expected tree output when only the features in ``known`` are given: branches weighted elsewhere."""
    node = nodes[weight]
    if node["left"] < 0:
        return node["prediction"]
    if node["feature"] in known:
        return conditional_value(nodes, node["left"] if x[node["feature"]] <= node["cut"] else node["right"], x, known)
    left, right = nodes[node["left"]], nodes[node["right"]]
    return sum(n["weight"] / node["weight"] * conditional_value(nodes, i, x, known)
               for n, i in ((left, node["left"]), (right, node["right"])))


def test_contributions_equal_the_definition(spark, trained, stored):
    """Shapley values by enumerating all feature subsets of each tree."""
    data = spark.read.parquet(f"{stored}/model/data").collect()
    trees = {}
    for row in data:
        n = row["nodeData"]
        cut = n["split"]["leftCategoriesOrThreshold"]
        trees.setdefault(row["treeID"], {})[n["id"]] = {
            "left": n["leftChild"], "right": n["rightChild"], "feature": n["split"]["featureIndex"],
            "cut": cut[0] if cut else None, "prediction": n["prediction"], "weight": n["impurityStats"][0]}
    rows = explain.explained(trained.zones, stored).orderBy(*ZONE).limit(4).collect()
    for r in rows:
        x = [float(r[f]) for f in FEATURES]
        want = np.zeros(len(FEATURES))
        for tree, nodes in trees.items():
            used = sorted({n["feature"] for n in nodes.values() if n["left"] >= 0})
            values = {s: conditional_value(nodes, 0, x, set(s))
                      for k in range(len(used) + 1) for s in itertools.combinations(used, k)}
            for i in used:
                for s, v in values.items():
                    if i not in s:
                        share = math.factorial(len(s)) * math.factorial(len(used) - len(s) - 1) / math.factorial(len(used))
                        want[i] += trained.model.treeWeights[tree] * share * (values[tuple(sorted((*s, i)))] - v)
        got = [r["shap_values"][f] for f in FEATURES]
        assert got == pytest.approx(want, abs=1e-9)
        drivers = sorted(zip(FEATURES, got), key=lambda e: -abs(e[1]))[:3]
        assert [tuple(d) for d in r["top_drivers"]] == drivers


def test_long_and_mean_tables(trained, stored):
    long = explain.attribution_long(trained.zones, stored)
    assert long.count() == trained.n_zones * len(FEATURES)
    row = long.filter("feature = 'zone_lat'").first()
    assert row["feature_value"] == row["zone_lat"]
    top = explain.attribution_of_top(trained.zones, stored)
    assert top.select(*ZONE).distinct().count() == 3
    means = {r["feature"]: r["mean_abs_contribution"] for r in explain.attribution_importance(trained.zones, stored).collect()}
    want = long.filter("feature = 'avg_mag_7d'").agg(F.avg(F.abs("contribution"))).first()[0]
    assert set(means) == set(FEATURES) and means["avg_mag_7d"] == pytest.approx(want)


def test_export(spark, trained, stored, tmp_path):
    exports.write_json(explain.attributions(trained.zones, stored), str(tmp_path / "out"))
    record = json.loads(spark.read.text(str(tmp_path / "out")).first()[0])
    assert set(record) == {"zone_lat", "zone_lon", "score", "base_value", "shap_values", "top_drivers"}
    assert list(record["shap_values"]) == list(FEATURES) and len(record["top_drivers"]) == 3


def test_weight_favours_rare_positives(trained):
    rows = model.weighted(trained.zones, 2.5).groupBy(LABEL).agg(F.avg("weight").alias("w")).collect()
    assert {r[LABEL]: r["w"] for r in rows} == {0: 1.0, 1: 2.5}
