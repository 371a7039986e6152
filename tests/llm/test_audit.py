"""Counts of all orders of the filters against a plain application of each order, and against SQL."""

import re
from itertools import permutations

import pytest

from checks import compare
from hazgrid.llm import audit, queries

SCHEMA = "doc_id bigint, text string, lang string, source string, part string, mask string, h0 string"
LABELS = "doc_id bigint, quality int, toxic int"


def failing(text, doc_id, docs):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    fails = set()
    if len(words) < 100:
        fails.add("A")
    if 100 * len(set(words)) < 80 * len(words):
        fails.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
        fails.add("C")
    if re.search("[#$%&*|]", text):
        fails.add("D")
    if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, *_ in docs):
        fails.add("E")
    return fails


def by_hand(docs, labels):
    rows, out = {}, set()
    for doc_id, text, lang, *_ in docs:
        said = [(q, t) for i, q, t in labels if i is not None and i == doc_id]
        row = (failing(text or "", doc_id, docs), any(q == 1 for q, _ in said), any(t == 1 for _, t in said))
        rows.setdefault(lang or "", []).append(row)
    for part, each in rows.items():
        steps, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = each
            for step, name in enumerate(order, 1):
                removed = [r for r in left if name in r[0]]
                left = [r for r in left if name not in r[0]]
                shapley[name] += len(removed)
                steps.append((
                    part, "".join(order), step, len(left), len(removed), sum(name in r[0] for r in each) - len(removed),
                    sum(r[0] == {name} for r in each), sum(r[1] for r in removed), sum(r[2] for r in removed), name,
                ))
        out |= {(*s[:-1], shapley[s[-1]]) for s in steps}
    return out


def word_list(n, spread):
    return " ".join(f"w{i % spread}" for i in range(n))


DOCS = [
    (1, word_list(120, 120), "en"), (2, word_list(120, 120), "en"), (3, word_list(120, 120), "fr"),
    (4, word_list(100, 80), "en"), (5, word_list(100, 79), "en"), (6, word_list(99, 99), "en"),
    (7, "A" + "b" * 9, "en"), (8, "AB" + "b" * 9, "fr"), (9, "ÀÉ" * 50, None), (10, "a|b", "de"),
    (11, None, "en"), (12, "", "en"), (13, " \t\x0b\n ", "en"), (None, "", "en"), (None, "a|b", "en"),
    (20, word_list(50_000, 50_000), "en"), (20, word_list(50_000, 50_000), "en"), (19, word_list(50_000, 50_000), "en"),
    (21, "ab\x1cc\x85d e " * 120, ""), (12, "twice the id", "en"), (4, "", "en"), (22, "W" + word_list(101, 101), "en"),
    (23, "$ " + word_list(101, 101).upper(), "fr"), (24, "$ " + word_list(101, 101).upper(), "fr"),
]
SAID = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (5, None, 1), (None, 1, 1), (10, 0, None), (23, 1, 0), (99, 1, 1), (12, 1, 0)]


@pytest.mark.parametrize("cells", [None, audit.BITMAP])
def test_against_every_order(spark, cells):
    docs = spark.createDataFrame([(*d, "s", "x", "y", "z") for d in DOCS], SCHEMA)
    found = audit.audited(docs, spark.createDataFrame(SAID, LABELS), cells)
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == by_hand(DOCS, SAID)


def test_a_full_sketch_changes_nothing(spark, sf_dir):
    """With far more texts than cells nothing is cleared by the sketch, and results stay."""
    rows = [(i, f"text {i // 3 if i % 2 else i}", "en") for i in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    few = docs.selectExpr("*", "0 AS h0", "0 AS h1")  # replaced by hashes of the text
    copies = {r.doc_id for r in audit.masks(few).collect() if r["mask"] & audit.bit("E")}
    first = {}
    for i, text, _ in rows:
        first.setdefault(text, i)
    assert copies == {i for i, text, _ in rows if first[text] != i}


def test_the_sketch_clears_unique_texts(spark):
    docs = spark.createDataFrame([(i, f"text {min(i, 900)}", "en") for i in range(1_000)], "doc_id bigint, text string, lang string")
    flags = audit.text_mask(docs)
    cells = audit.cells_for(1_000)
    left = audit.possible_repeats(flags, audit.crowded_cells(flags, cells), cells)
    ids = {r.doc_id for r in left.collect()}
    assert set(range(900, 1_000)) <= ids and len(ids) < 200
    plan = audit.possible_repeats(flags, audit.crowded_cells(flags, cells), cells)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_cells_are_bounded():
    assert audit.cells_for(0) == audit.BITMAP and audit.cells_for(10**12) == audit.MOST_CELLS


def test_empty_table(spark, sf_dir):
    none = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("false")
    assert audit.audited(none, spark.createDataFrame([], LABELS)).count() == 0


def test_query_equals_sql(spark, sf_dir):
    found = compare.difference(queries.op12_filter_audit(spark, sf_dir), compare.connect(sf_dir), queries.OP12_SQL)
    assert found is None
