"""Search and near-duplicates of vectors against brute force."""

import math

import numpy as np
import pytest

from checks import compare
from hazgrid.llm import bitslice, gridjoin, queries

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, class string"
NAN, INF = float("nan"), float("inf")


def brute_links(rows, least=0.98):
    """(n_links, component) of each row, pair by pair."""
    sound = [
        r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])
        for r in rows
    ]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if sound[i] and sound[j] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], "f8"), np.array(b[1], "f8")
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= least:
                    links[i] += 1
                    links[j] += 1
                    parent[root(i)] = root(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(root(i), []).append(r[0])
    return [(r[0], links[i], min(groups[root(i)])) for i, r in enumerate(rows)]


def clustered(draw, n, width=12):
    centres = draw.normal(size=(25, width))
    rows = []
    for i in range(n):
        vector = centres[draw.integers(25)] + draw.normal(size=width) * draw.choice([0.0, 0.05, 0.15, 1.0])
        rows.append((i * 3 + 1, [float(np.float32(x)) for x in vector], int(draw.integers(3)), "v", "c"))
    return rows


@pytest.mark.parametrize("block", [40, 4096])
def test_grid_join_against_brute_force(spark, block):
    rows = clustered(np.random.default_rng(11), 500)
    # each odd row shares its label with other sound rows; ids stay distinct
    rows += [
        (2001, None, 1, "v", "c"), (2002, [0.0] * 12, 1, "v", "c"), (2003, [NAN] + [1.0] * 11, 1, "v", "c"),
        (2004, [None] + [1.0] * 11, 1, "v", "c"), (2005, [1.0] * 12, None, "v", "c"), (2006, [1.0] * 12, None, "v", "c"),
        (2007, [1.0] * 3, 1, "v", "c"), (2008, [2.0] * 3, 1, "v", "c"), (2009, [INF] * 12, 1, "v", "c"), (2010, [], 1, "v", "c"),
    ]
    rows += [(3000 + i, [0.5, *[0.25] * 11], 2, "v", "c") for i in range(40)]
    out = gridjoin.near_vectors(spark.createDataFrame(rows, SCHEMA), block=block).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == sorted(brute_links(rows))
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)


def test_grid_join_query_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    out = queries.op7_embedding_near_dedup(spark, sf_dir).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == sorted(brute_links(rows))


def test_intervals_that_are_far_apart_are_not_compared():
    draw = np.random.default_rng(2)
    vectors = draw.normal(size=(4000, 3))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = vectors[np.lexsort(np.floor(vectors.T[::-1] / 0.2))]
    compared = []
    side = (vectors, vectors, np.ones(4000))
    gridjoin.interval_join(side, side, 0.2, 0.98, True, lambda a, c, hits: compared.append(hits.size))
    assert 0 < sum(compared) < 4000 * 4000 / 4


def brute_top(rows, k=20):
    held = [
        (i, [math.floor(64 * float(np.float32(x))) for x in vector])
        for i, vector, *_ in rows
        if i is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    out = []
    for own, (q, asked) in enumerate(held):
        if q % 20 == 0:
            others = ((i, v) for n, (i, v) in enumerate(held) if n != own)
            scores = sorted((-sum(a * b for a, b in zip(asked, v)), i) for i, v in others)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return out


def test_search_against_brute_force(spark):
    draw = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in np.round(draw.normal(size=9) / 4, 2)], 1, "v", "c") for i in range(-60, 300)]
    rows += [(400 + i, [0.1] * 9, 1, "v", "c") for i in range(60)]
    rows += [(None, [1.0] * 9, 1, "v", "c"), (500, None, 1, "v", "c"), (520, [NAN] * 9, 1, "v", "c"), (540, [1.0], 1, "v", "c")]
    rows += [(560, [None] * 9, 1, "v", "c"), (580, [50.0, -75.5] * 4, 1, "v", "c"), (20, [0.2] * 9, 1, "v", "c"), (600, [], 1, "v", "c")]
    table = spark.createDataFrame(rows, SCHEMA)
    for blocks in ({"rows": 100, "asked": 7}, {}):
        out = bitslice.top_k(table, "vec_id % 20 = 0", **blocks).collect()
        assert sorted(tuple(r) for r in out) == sorted(brute_top(rows))


def test_search_keeps_every_row_of_an_id(spark, tmp_path):
    rows = [(1, [0.9], 1, "v", "c"), (1, [0.1], 1, "v", "c"), (20, [1.0], 1, "v", "c"), (20, [1.0], 1, "v", "c"), (20, [2.0], 1, "v", "c")]
    table = spark.createDataFrame(rows, SCHEMA)
    out = bitslice.top_k(table, "vec_id % 20 = 0")
    assert sorted(tuple(r) for r in out.collect()) == sorted(brute_top(rows))
    table.write.parquet(str(tmp_path / "embeddings.parquet"))
    assert compare.difference(out, compare.connect(str(tmp_path)), queries.OP3_SQL) is None


def test_scores_beyond_a_long_stop_at_its_ends(spark):
    rows = [(20, [1e16, -1e16]), (1, [1e16, 1.0]), (2, [-1e16, 3.0]), (3, [0.02])]
    out = bitslice.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), "vec_id = 20")
    assert [(r.vec_id, r.score) for r in out.orderBy("rank").collect()] == [(1, 2**63 - 1), (3, 64 * 10**16), (2, -(2**63))]


def test_vectors_of_any_size_link_by_cosine_alone(spark):
    rows = [(1, [1e-200, 0.0]), (2, [1.0, 1.0]), (3, [1e200, 1e200]), (4, [5e-324, 5e-324]), (5, [0.0, 1e308]), (6, [3.0, 0.0])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<double>, label int")
    out = gridjoin.near_vectors(table).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == [(1, 1, 1), (2, 2, 2), (3, 2, 2), (4, 2, 2), (5, 0, 5), (6, 1, 1)]


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0], 1, "v", "c"), (1, [0.5, 0.0], 1, "v", "c")]
    table = spark.createDataFrame(rows, SCHEMA)
    assert [tuple(r) for r in bitslice.top_k(table, "vec_id % 20 = 0").collect()] == [(0, 1, 1, 64 * 32)]
    none = table.filter("false")
    assert bitslice.top_k(none, "vec_id % 20 = 0").count() == 0
    assert gridjoin.near_vectors(none).count() == 0


def test_search_query_equals_sql(spark, sf_dir):
    found = compare.difference(queries.op3_top_k_search(spark, sf_dir), compare.connect(sf_dir), queries.OP3_SQL)
    assert found is None
