"""Ids and texts must equal the tokenizers library's, whatever the text."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from hazgrid.llm import bpe, pretoken, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = [
    "", " ", "a", "<|endoftext|>a<|endoftext|><|endoftext", "a  b\x1cc \x85d  e\xa0 ", "日本語 テスト½ ²", "x" * 3000,
    "a b" * 200 + "'s''ll ", " \n\n  x", "'S it's we'LL", "👍🏽 ok\x00", "a\n b.c\n.d , e ,f. g\x0b.h", "x\0.y", ". a",
    "a\t.b", "\na", "a\n", "..., ,.", "no end", "ab" * 100_000,
]


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


@pytest.mark.parametrize("text", ODD, ids=range(len(ODD)))
def test_odd_texts(text):
    vocabulary = bpe.vocabulary(PATH)
    packed = vocabulary.encode(text)
    assert ids(packed) == library(text)
    assert vocabulary.decode(packed) == LIBRARY.decode(library(text), skip_special_tokens=False)


def test_random_texts_of_awkward_letters():
    draw, vocabulary = random.Random(7), bpe.vocabulary(PATH)
    for _ in range(1500):
        text = "".join(draw.choice(" \n\t.,'stmdlvre0½aéß!?。日\x1c\xa0 \0") for _ in range(draw.randint(0, 30)))
        assert ids(vocabulary.encode(text)) == library(text), repr(text)
        assert "".join(pretoken.pieces(text)) == text


def test_both_trees_merge_alike():
    vocabulary, draw = bpe.vocabulary(PATH), random.Random(3)
    words = [bytes(draw.choices(b"theraningo s", k=draw.randint(1, 64))) for _ in range(300)]
    for word, packed in zip(words, vocabulary.merge_many(words, 64)):
        assert ids(packed) == vocabulary.merge([vocabulary.first[byte] for byte in word])


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(pretoken, "REMEMBERED", 5)
    monkeypatch.setattr(pretoken, "FRESH", 2)
    monkeypatch.setattr(pretoken, "AT_ONCE", 10)
    vocabulary = bpe.Vocabulary(PATH)
    texts = ["one two three. four five six, seven", "two eight nine ten eleven", "one two"] * 3
    found, sizes = vocabulary.memory.encode(texts)
    assert sizes.tolist() == [len(library(t)) for t in texts]
    assert found.tolist() == [i for t in texts for i in library(t)]


def test_units_are_told_apart_without_strings_of_them(monkeypatch):
    """Units that share beginnings, ends or zero bytes differ in their marks, and known ones are never made strings."""
    draw = random.Random(5)
    units = {"", "a", "a\0", "\0", "\0\0", "12345678", "12345678\0", "x" * 15, "x" * 16, "x" * 17, "é" * 7, "é" * 8, " 日本語テ"}
    units |= {" begins" + "".join(draw.choices("abé", k=n)) for n in range(12) for _ in range(40)}
    units |= {"".join(draw.choices("ab", k=n)) + " ends in this" for n in range(6) for _ in range(20)}
    units = sorted(units)
    key, check = pretoken.marks(pa.array(units, pa.string()))
    assert len(set(key.tolist())) == len(set(zip(key.tolist(), check.tolist()))) == len(units)
    again = pretoken.marks(pa.array(["left out", *units], pa.string()).slice(1))
    assert (again[0] == key).all() and (again[1] == check).all()
    assert [len(part) for part in pretoken.marks(pa.array([], pa.string()))] == [0, 0]

    asked = []
    memory = pretoken.Memory(lambda some: asked.append(some) or [unit.encode("utf-32-le") for unit in some], {})
    texts = ["one two, three three." * 3, "two one"]
    first = memory.encode(texts)
    seen = sum(asked, [])
    assert len(seen) == len(set(seen)) and "".join(map(chr, first[0].tolist())) == "".join(texts)
    asked.clear()
    second = memory.encode(texts)
    assert not any(asked) and second[0].tolist() == first[0].tolist()


def test_ids_without_meaning_in_utf8_decode_to_replacements():
    vocabulary = bpe.vocabulary(PATH)
    lone = [vocabulary.first[0xC3], vocabulary.first[0x41], vocabulary.first[0xE2], vocabulary.first[0x82]]
    assert vocabulary.decode(np.array(lone, "<u4").tobytes()) == LIBRARY.decode(lone, skip_special_tokens=False)


def test_encoded_keeps_rows_and_clashing_columns(spark):
    rows = [(1, None, "x", "d1"), (1, None, "x", "d1"), (None, "a b", None, "d2"), (3, "", "y", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, doc string")
    out = bpe.decoded(bpe.encoded(docs, PATH), PATH)
    assert out.columns == ["doc_id", "text", "doc", "ids", "decoded"]
    found = sorted((r.doc_id or 0, ids(r.ids), r.decoded, r.doc) for r in out.collect())
    assert found == [(0, library("a b"), "a b", "d2"), (1, [], "", "d1"), (1, [], "", "d1"), (3, [], "", None)]


def test_query_equals_the_library(spark, sf_dir):
    import hashlib

    out = {r.doc_id: r for r in queries.op5_bpe_encoding(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(out) == len(docs)
    for doc in docs:
        expected = library(doc.text)
        row = out[doc.doc_id]
        assert row.n_tokens == len(expected)
        assert row.ids_sha256 == hashlib.sha256(np.array(expected, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(doc.text.encode()).hexdigest()


def test_empty_table(spark, sf_dir):
    none = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("false")
    assert bpe.decoded(bpe.encoded(none, PATH), PATH).count() == 0
