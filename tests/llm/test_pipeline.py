"""Every stage of the pipeline against a plain version run on what the stage before it kept."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from test_linededup import walk
from test_mixing import by_hand
from test_simhash import by_bits, by_pairs
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from hazgrid.llm import mixing, quality
from hazgrid.llm.common import DOCUMENT_COLUMNS, stored, table


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """The rows before the first stage and after each."""
    docs = table(spark, sf_dir, "documents")
    found = [docs.collect()]
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "step")
        found.append(docs.collect())
    return found


def test_quality(spark, sf_dir, steps):
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    value = quality.Weigher(model).value
    kept = {r.doc_id for r in steps[0] if value(r.text) >= model.thresholds[0]}
    assert {r.doc_id for r in steps[1]} == kept
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    assert not [i for i in set(labels) - kept if labels[i] == 1]


def test_line_dedup(steps):
    expected = walk(sorted((r.doc_id, r.text) for r in steps[1]))
    left = {i: text for i, (text, gone) in expected.items() if text or not gone}
    assert {r.doc_id: r.text for r in steps[2]} == left
    assert all(r.n_chars == len(r.text) for r in steps[2] if expected[r.doc_id][1])


def test_simhash(steps):
    groups = by_pairs({r.doc_id: by_bits(r.text) for r in steps[2]})
    assert sorted(r.doc_id for r in steps[3]) == sorted(set(groups.values()))


def test_mixing(spark, steps):
    rows = spark.createDataFrame([tuple(r) for r in steps[3]], "doc_id long, text string, lang string, source string, n_chars long")
    named = rows.withColumn("topic", mixing.topic()).collect()
    size = lambda r: max(1, len(r.text.encode()) // 4)
    each = by_hand([(r.doc_id, (r.source, r.lang, r.topic), size(r)) for r in named], mixing.TARGETS)
    draw = lambda i: int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:13], 16) / (1 << 52)
    kept = [r.doc_id for r in named if draw(r.doc_id) < each[r.source, r.lang, r.topic]]
    assert sorted(r.doc_id for r in steps[4]) == sorted(kept)


def test_bpe(steps):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in steps[4]}
    assert {r.doc_id for r in steps[5]} == set(texts)
    for r in steps[5]:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.n_tokens == len(ids) and r.round_trip


def test_bpe_holds_one_python_worker_a_task(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    plan = pipeline.token_ids(spark, docs, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EvalPython") == 1


def test_columns_and_empty_tables(spark, sf_dir, steps):
    assert all(list(rows[0].asDict()) == DOCUMENT_COLUMNS for rows in steps[1:5])
    none = table(spark, sf_dir, "documents").filter("false").withColumn("gone", mixing.F.lit(1))
    for name, stage in pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0, name


def test_odd_rows_pass_every_stage(spark, sf_dir):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "w " * 50_000, "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() <= 4, name
