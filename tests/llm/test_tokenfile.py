"""Token files read back must hold the library's ids in order, and skip what is not asked for."""

import glob
import os
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from hazgrid.llm import queries, tokenfile

PATH = public_tokenizers.path("byte_bpe_50k.json")
ROOT = Path(__file__).resolve().parents[2]
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


def test_query_equals_the_library(spark, sf_dir):
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r.doc_id)
    rows = {r.doc_id: r for r in queries.op10_token_files(spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    start = 0
    for doc in docs:
        ids = library(doc.text)
        row = rows[doc.doc_id]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_the_library_starts_no_threads_in_a_worker():
    code = (
        "import os, sys; from hazgrid.llm import tokenfile; before = len(os.listdir('/proc/self/task'));"
        "tokenfile.library(sys.argv[1]).encode([f'some text of thread {i}' for i in range(5000)]);"
        "sys.exit(len(os.listdir('/proc/self/task')) - before)"
    )
    # Arrow's own threads do not count: it is given one
    env = {k: v for k, v in os.environ.items() if k not in ("TOKENIZERS_PARALLELISM", "RAYON_NUM_THREADS")} | {"OMP_NUM_THREADS": "1"}
    assert subprocess.run([sys.executable, "-c", code, PATH], env=env, cwd=ROOT, timeout=120).returncode == 0


def test_layout_and_odd_rows(spark, tmp_path):
    rows = [(i * 7 % 40, f"text {i} <|endoftext|> on\n", "x") for i in range(40)]
    rows += [(None, "no id", "x"), (3, None, None), (5, "", "x"), (6, "long " * 30_000, "x"), (9, "text", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard string")
    out = str(tmp_path / "files")
    tokenfile.write(docs, out, PATH, shard_rows=10)
    read = tokenfile.read(spark, out)
    expected = sorted((-1 if i is None else i, library(text)) for i, text, _ in rows)
    found = tokenfile.starts(read, read.select("shard", "n_tokens")).orderBy("start").collect()
    assert [(-1 if r.doc_id is None else r.doc_id, r.tokens) for r in found] == expected
    assert [r.start for r in found] == [0, *np.cumsum([len(t) for _, t in expected])[:-1]]
    assert len({r.shard for r in found}) >= 4
    assert [r.doc_id for r in tokenfile.document_ids(spark, out, 5, 6).orderBy("doc_id").collect()] == [5, 5, 6, 6]
    for name in glob.glob(f"{out}/shard=*/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        for group in range(meta.num_row_groups):
            for column in range(meta.num_columns):
                assert meta.row_group(group).column(column).has_offset_index
        tokens = meta.row_group(0).column(2)
        assert {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"} & set(tokens.encodings)


def test_empty_table(spark, sf_dir, tmp_path):
    none = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("false")
    tokenfile.write(none, str(tmp_path / "none"), PATH)
    assert tokenfile.read(spark, str(tmp_path / "none")).count() == 0
