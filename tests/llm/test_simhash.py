"""Fingerprints and groups against bit-by-bit and pair-by-pair versions."""

import random
import re

import numpy as np
import pytest
import xxhash

from hazgrid.llm import queries, simhash
from hazgrid.llm.common import components


def by_bits(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def by_pairs(prints):
    """The smallest id of each id's group; prints: id -> fingerprint."""
    ids, parent = sorted(prints), {}
    values = np.array([prints[i] for i in ids], "u8")

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for n, i in enumerate(ids):
        for m in np.flatnonzero(np.bitwise_count(values[:n] ^ values[n]) <= 2):
            a, b = root(ids[m]), root(i)
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


TEXTS = [
    "", " \t\n\x0b", "One", "one TWO", "one two three", "Ä É ß Kelvin", "a b c a b c a b c " * 50, "no\x85break\xa0here two three",
    "tab\tand\x1cfile separators in\x0cit", "x" * 100_000,
]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_fingerprint_bit_by_bit(text):
    assert simhash.fingerprint(text) == by_bits(text)


def test_long_texts_are_counted_in_chunks(monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 7)
    text = "some words that go on and on " * 40
    assert simhash.fingerprint(text) == by_bits(text)


def test_linked_pairs_share_two_families_of_the_pivot_table():
    draw = random.Random(1)
    for _ in range(300):
        a = draw.getrandbits(64)
        b = a ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64))
        table = simhash.pivot_table(np.array([a, b], "u8")).reshape(2, simhash.BLOCKS, simhash.BLOCK)
        assert (table[0] == table[1]).all(axis=1).sum() >= 2


@pytest.mark.parametrize("crowd", [2, 64])
def test_links_connect_what_is_near(spark, crowd):
    draw = random.Random(8)
    values = {draw.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1}
    for base in list(values)[:20]:  # chains and clouds around some
        at = base
        for _ in range(40):
            at ^= 1 << draw.randrange(64)
            values.add(at if draw.random() < 0.5 else base ^ (1 << draw.randrange(64)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    pairs = simhash.links(fps, crowd)
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 2 for r in pairs.collect())
    found = {r.node: r.component for r in components(pairs).collect()}
    expected = by_pairs({v: v & (1 << 64) - 1 for v in signed})
    assert {v: found.get(v, v) for v in signed} == expected


def test_query_against_brute_force(spark, sf_dir):
    sf_dir = sf_dir.replace("0.001", "0.01")
    rows = queries.op1_simhash_near_dedup(spark, sf_dir).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in random.Random(3).sample(rows, 60):
        assert r.fingerprint == f"{by_bits(docs[r.doc_id]):016x}"
    groups = by_pairs({r.doc_id: int(r.fingerprint, 16) for r in rows})
    assert {r.doc_id: r.component_id for r in rows} == groups
    assert len(set(groups.values())) < len(rows)


def test_odd_rows(spark):
    rows = [(None, "same words here now"), (4, "same words here now"), (2, "Same WORDS here now"), (2, "same words here now")]
    rows += [(7, None), (6, ""), (9, "other words that differ from those")]
    docs = spark.createDataFrame([(*r, "kept", 1) for r in rows], "doc_id bigint, text string, fingerprint string, first int")
    out = simhash.near_copies(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in out) == [(0, 2), (2, 2), (2, 2), (4, 2), (6, 6), (7, 6), (9, 9)]
    assert [r.fingerprint for r in out if r.doc_id in (6, 7)] == ["0" * 16] * 2
    first = simhash.first_of_each_group(docs)
    assert first.columns == docs.columns
    assert sorted((r.doc_id, r.fingerprint, r.first) for r in first.collect()) == [(i, "kept", 1) for i in (2, 6, 9)]
    assert simhash.near_copies(docs.filter("false")).count() == 0
    assert simhash.first_of_each_group(docs.filter("false")).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)}
