"""Statistics against regular expressions, trees against a walk from node to node, verdicts against held-out labels."""

import re
import zlib

import numpy as np
import pytest

from hazgrid.llm import queries, rules

WORD = r"[^\x20\x09-\x0D]+"


def by_hand(text):
    words = re.findall(WORD, text)
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return [
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(line in lines[:i] for i, line in enumerate(lines)), len(inside),
    ]


TEXTS = [
    "", " \t\n\x0b\x0c\r ", "one", "a b", "a b c", "a b c a b c", "x x x x x", "a b c\nd\na b c\n \n \n", "é\x85ö \x1c ü　x", "# * $ <|> 100%",
    "LOUD!! WORDS!!", "tab\tsplit\x0bhere\x0cand\rthere", "the same line\n" * 4, "end a b c d a b c d", "\U0001f600 \U0001f600 \U0001f600 \U0001f600",
]


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    counts, shares = rules.counted(text)
    assert counts == by_hand(text)
    assert len(shares) == len(rules.FEATURES) and np.isfinite(shares).all()


def walked(model, row):
    total = model.base
    for feature, cut, value in zip(model.feature, model.cut, model.value):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
        total += value[node - len(feature)]
    return 1 / (1 + np.exp(-total))


def sample_rows(seed=0, n=600):
    rng = np.random.default_rng(seed)
    rows = rng.random((n, 4))
    good = (rows[:, 0] + 0.3 * np.sin(9 * rows[:, 1]) + 0.2 * rng.standard_normal(n) < 0.6).astype("i8")
    return rows, good


def test_flat_arrays_equal_a_walk():
    rows, good = sample_rows()
    model = rules.fit_trees(rows, good, np.zeros(4, int), trees=20)
    assert np.allclose(model.score(rows), [walked(model, row) for row in rows], atol=1e-12)
    assert ((model.score(rows) > 0.5) == good).mean() > 0.85
    assert len(model.score(rows[:0])) == 0


@pytest.mark.parametrize("seed", range(3))
def test_monotonic_where_asked(seed):
    rows, good = sample_rows(seed)
    free = rules.fit_trees(rows, good, np.array([0, 0, 0, 0]), trees=30)
    model = rules.fit_trees(rows, good, np.array([-1, -1, 1, 0]), trees=30)
    grid = np.linspace(-0.1, 1.1, 60)
    broken = 0
    for row in rows[:60]:
        for feature, sign in ((0, -1), (1, -1), (2, 1)):
            line = np.repeat(row[None], len(grid), axis=0)
            line[:, feature] = grid
            assert (sign * np.diff(model.score(line)) >= -1e-12).all()
            broken += (sign * np.diff(free.score(line)) < -1e-12).any()
    assert broken  # without the constraint it is not monotonic by itself


def test_one_label_knows_nothing():
    rows, _ = sample_rows()
    assert (rules.fit_trees(rows, np.ones(len(rows), "i8"), np.zeros(4, int)).score(rows) == 0.5).all()


def test_odd_rows(spark, sf_dir):
    schema = "doc_id bigint, text string, lang string, kept string, score string, one string, grade string"
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(None, None), (1, ""), (2, long), (2, long), (3, "a b c " * 40), (4, "# " * 60)]
    docs = spark.createDataFrame([(*r, "x", "y", "z", "u", "v") for r in rows], schema)
    labels = spark.createDataFrame([(1, 0, None), (2, 1, 0), (2, 1, 1), (None, 0, 0), (3, None, 1)], "doc_id bigint, quality int, toxic int")
    found = rules.judged(docs, rules.fit(docs, labels), keep=("doc_id", "lang", "kept")).collect()
    assert {r.lang for r in found} == {"x"}
    by_id = sorted((r.doc_id or 0, [r[c] for c in rules.COUNTS], r.base_failed) for r in found)
    assert by_id == [
        (0, [0] * 5, True), (1, [0] * 5, True), (2, [200_000, len(long) - 199_999, 0, 0, 0], False),
        (2, [200_000, len(long) - 199_999, 0, 0, 0], False), (3, [120, 120, 0, 0, 120], True), (4, [60, 60, 60, 0, 60], True),
    ]


def test_empty_tables(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    assert rules.judged(docs.filter("false"), rules.fit(docs, labels.filter("false"))).count() == 0
    unknown = rules.judged(docs, rules.fit(docs, labels.filter("false")))
    assert unknown.filter("kept = base_failed").count() == 0  # without labels only the fixed rules reject


def test_query_on_held_out_labels(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = {r.doc_id: r for r in queries.op11_quality_rules(spark, folder).collect()}
    assert found.keys() == docs.keys()
    for doc_id, text in docs.items():
        row = found[doc_id]
        if len(text) < 4_000:
            assert [row[c] for c in rules.COUNTS] == by_hand(text)
        assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
        assert row.kept == (not row.base_failed and row.score >= 0.5)
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    judged = [(r.quality, found[r.doc_id]) for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id in found]
    right = [quality == (row.score >= 0.5) for quality, row in judged]
    assert len(right) > 40 and np.mean(right) > 0.95
