"""Held-out accuracy of the two classifiers, and what they make of odd rows."""

import zlib

import numpy as np
import pytest

from hazgrid.llm import common, quality, queries, toxicity


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/labels.parquet").collect()
    return {r.doc_id: r for r in rows}


def test_toxicity_on_held_out_documents(spark, sf_dir, labels):
    rows = queries.op2_toxicity(spark, sf_dir.replace("0.001", "0.01")).collect()
    assert len({r.doc_id for r in rows}) == len(rows) == 1000
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, labels[r.doc_id].toxic) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 40
    assert sum(p == t for p, t in held) >= 0.9 * len(held)
    assert not [1 for p, t in held if p and not t]


def test_quality_on_held_out_documents(spark, sf_dir, labels):
    rows = queries.op8_quality_classifier(spark, sf_dir.replace("0.001", "0.01")).collect()
    held = [(r.kept, labels[r.doc_id].quality) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(k == bool(q) for k, q in held) >= 0.95 * len(held)
    assert all(k for k, q in held if q)


def test_the_composed_machine_says_what_its_parts_say():
    classes = toxicity.Classes(frozenset({"idiot$", "moron$"}))
    name = lambda text: [toxicity.KINDS[i] for i, n in enumerate(toxicity.matches(text, classes)) for _ in range(n)]
    assert name("you are an idiot") == [("insult", "aimed", "", "")]
    assert name("an idiot and a moron. nothing") == [("insults", "", "", "")]
    assert name("you are not an idiot") == [("insult", "aimed", "denied", "")]
    assert name("an idiot is not here") == [("insult", "", "", "")]
    assert name("she said idiot") == [("insult", "aimed", "", "reported")]
    assert name("I will kill you; the kill") == [("threat", "aimed", "", "")]
    assert name("") == name("clean words. only") == []


def test_models_without_labels(spark, sf_dir):
    docs = spark.createDataFrame([(1, None, 5), (None, "some text", 6), (2, "", 7)], "doc_id int, text string, score int")
    none = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("false")
    model = toxicity.fit(docs, none)
    assert [r.score < 0.5 for r in toxicity.scored(docs, model).collect()] == [True] * 3
    plain = quality.fit(docs, none)
    assert [r.tails for r in quality.scored(docs, plain).collect()] == [[0.5]] * 3
    assert quality.selected(docs, plain).columns == docs.columns
    assert quality.scored(docs.filter("false"), plain).count() == 0


def test_ordinal_fit_orders_grades():
    draw = np.random.default_rng(5)
    grades = draw.integers(0, 3, 600)
    words = [["bad"], ["fair"], ["good"]]
    texts = [" ".join(draw.choice(words[g] * 3 + ["the", "of"], 20)) for g in grades]
    model = quality.fit_counts([quality.counts(t) for t in texts], grades)
    assert list(model.thresholds) == sorted(model.thresholds)
    values = [quality.Weigher(model).value(w) for w in ("bad", "fair", "good")]
    assert values == sorted(values)
    found = [np.searchsorted(model.thresholds, quality.Weigher(model).value(t)) for t in texts]
    assert np.mean(found == grades) > 0.97


def test_labels_repeated_or_missing(spark):
    docs = spark.createDataFrame([(i, "good text here" if i % 2 else "$$ %%% ###") for i in range(60)], "doc_id int, text string")
    rows = [(i, i % 2, 0) for i in range(60)] + [(1, 1, 0), (None, 1, 1), (3, None, None), (999, 0, 1)]
    labels = spark.createDataFrame(rows, "doc_id int, quality int, toxic int")
    model = quality.fit(docs, labels)
    kept = {r.doc_id for r in quality.selected(docs, model).collect()}
    assert kept == set(range(1, 60, 2))


def test_held_out_labels_change_no_model(spark):
    texts = ["you are an idiot", "a calm day", "$$ %%% ###", "good text here"]
    docs = spark.createDataFrame([(i, f"{texts[i % 4]} {i}") for i in range(400)], "doc_id int, text string")
    models = []
    for held in (None, (0, 1), (1, 0)):
        rows = [(i, int(i % 4 != 2), int(i % 4 == 0)) for i in range(400)]
        rows = [(i, *held) if held and zlib.crc32(str(i).encode()) % 5 == 0 else (i, q, t) for i, q, t in rows]
        labels = spark.createDataFrame(rows, "doc_id int, quality int, toxic int")
        plain = quality.fit(docs, labels, sample=40)
        models.append((toxicity.fit(docs, labels, sample=60), plain.weights.tolist(), plain.thresholds))
    assert models[0] == models[1] == models[2]


def test_sample_has_one_row_for_each_document(spark):
    rows = [(i, f"text {i}") for i in range(50)] + [(7, f"copy {i:03d}") for i in range(500)] + [(8, None), (9, "text 9")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    labels = spark.createDataFrame(
        [(i, None if i == 3 else i % 2, int(i % 4 == 1)) for i in range(50)], "doc_id int, quality int, toxic int"
    )
    out = common.labelled_sample(docs.select("doc_id", common.whole_text().alias("text")), labels, quality.GRADE, 1000)
    found = {r.doc_id: (r.text, r.grade) for r in out.collect()}
    assert out.columns == ["doc_id", "text", "grade"] and out.count() == len(found) == 49
    assert 3 not in found
    assert found[7] == ("copy 000", 2) and found[8] == ("", 0) and found[9] == ("text 9", 1)
