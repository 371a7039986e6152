"""Raked weights and drawn documents against the same in plain Python."""

import hashlib
from collections import defaultdict

import pytest

from hazgrid.llm import mixing, queries


def by_hand(rows, targets, sweeps=200):
    """rows: (doc_id, values by margin, tokens); the chance of each row."""
    cells = defaultdict(float)
    for _, values, size in rows:
        cells[values] += size
    weights = dict(cells)
    for _ in range(sweeps):
        for m, target in enumerate(targets.values()):
            own = defaultdict(float)
            for values, size in cells.items():
                own[values[m]] += size
            if isinstance(target, dict):
                rest = sum(n for v, n in own.items() if v not in target)
                left = max(0.0, 1 - sum(target[v] for v in own if v in target)) if rest else 0.0
                aim = {v: target[v] if v in target else n * left / rest for v, n in own.items()}
            else:
                aim = {v: n**target for v, n in own.items()}
            whole, sums = sum(aim.values()), defaultdict(float)
            for values, weight in weights.items():
                sums[values[m]] += weight
            weights = {v: w * aim[v[m]] / whole / sums[v[m]] for v, w in weights.items()}
    ratio = {v: weights[v] / cells[v] for v in cells}
    return {v: r / max(ratio.values()) for v, r in ratio.items()}


def test_query_against_plain_python(spark, sf_dir):
    rows = queries.op6_source_mixing(spark, sf_dir).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    assert all(r.tokens == max(1, len(docs[r.doc_id].text.encode()) // 4) for r in rows)
    each = by_hand([(r.doc_id, (r.source, r.lang, r.topic), r.tokens) for r in rows], mixing.TARGETS)
    for r in rows:
        assert r.chance == pytest.approx(each[r.source, r.lang, r.topic], abs=1e-5)
        drawn = int(hashlib.md5(f"mix:{r.doc_id}".encode()).hexdigest()[:13], 16) / (1 << 52)
        assert r.kept == (drawn < each[r.source, r.lang, r.topic])
    assert len({r.topic for r in rows}) > 1


def test_margins_are_met(spark):
    rows = [(i, "abcd" * (1 + i % 7), f"s{i % 3 if i % 2 else 0}", "en" if i % 5 else "de") for i in range(3000)]
    rows += [(None, None, None, None), (9000, "", "s1", None), (1, "abcd" * 2, "s1", "en")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string, lang string")
    targets = {"source": {"s0": 0.2, "s1": 0.5}, "lang": {"de": 0.4, "absent": 0.1}}
    out = mixing.chances(docs.withColumn("tokens", mixing.F.lit("own")), targets).collect()
    assert len(out) == len(rows) and out[0].tokens == "own"
    weight = defaultdict(float)
    for r in out:
        size = max(1, len((r.text or "").encode()) // 4) * r.chance
        weight["all"] += size
        weight["source", r.source] += size
        weight["lang", r.lang] += size
    assert weight["lang", "de"] / weight["all"] == pytest.approx(0.4, abs=1e-4)
    assert weight["source", "s0"] / weight["all"] == pytest.approx(0.2, abs=1e-3)
    assert weight["source", "s1"] / weight["all"] == pytest.approx(0.5, abs=1e-3)
    assert max(r.chance for r in out) == pytest.approx(1.0)


def test_sample_keeps_columns_and_is_repeatable(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("chance", mixing.F.lit("own"))
    first = mixing.sample(docs, {"lang": {"en": 0.3}})
    assert first.columns == docs.columns
    ids = sorted(r.doc_id for r in first.collect())
    assert ids == sorted(r.doc_id for r in mixing.sample(docs, {"lang": {"en": 0.3}}).collect())
    assert 0 < len(ids) < docs.count()
    assert mixing.sample(docs.filter("false")).count() == 0
