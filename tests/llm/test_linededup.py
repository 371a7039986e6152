"""Cut passages against a plain walk over all lines, and against SQL."""

from hazgrid.llm import linededup, queries
from checks import compare


def walk(docs):
    """The same by hand: documents in order, windows seen so far in a set."""
    seen, out = set(), {}
    for key, text in docs:
        lines = (text or "").split("\n")
        gone = set()
        for i in range(len(lines) - 2):
            window = "\n".join(lines[i : i + 3])
            if window.strip(" \t\n\x0b\f\r"):
                gone |= {i, i + 1, i + 2} if window in seen else set()
                seen.add(window)
        kept = "\n".join(line for i, line in enumerate(lines) if i not in gone)
        out[key] = (text if not gone else kept, len(gone))
    return out


def test_against_a_walk(spark):
    docs = [
        (1, "a\nb\nc\nd\ne"), (2, "x\nb\nc\nd\ny"), (3, "a\nb\nc"), (4, None), (5, ""), (6, "k\nk\nk\nk\nk"),
        (7, "\n\n\n\n"), (8, "\n\n\n\n"), (9, "q\nc\nd\ne\nr\na\nb\nc"), (10, "b\nc"), (11, "l\n" * 5000 + "a\nb\nc"),
        (12, "tail\n\n\n"), (13, "tail\n\n\n"),
    ]
    rows = [(i, t, "own", "kept") for i, t in docs]
    table = spark.createDataFrame(rows, "doc_id int, text string, doc string, lines string")
    out = linededup.without_repeats(table)
    assert out.columns == ["doc_id", "text", "doc", "lines", "n_removed"]
    rows = out.collect()
    assert {r.doc_id: (r.text, r.n_removed) for r in rows} == walk(docs)
    assert {(r.doc, r.lines) for r in rows} == {("own", "kept")}


def test_missing_ids_and_repeated_rows(spark):
    rows = [(None, "a\nb\nc"), (1, "a\nb\nc"), (1, "a\nb\nc"), (None, "d\ne\nf")]
    out = linededup.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(((r.doc_id or 0, r.text) for r in out)) == [
        (0, ""), (0, "d\ne\nf"), (1, "a\nb\nc"), (1, "a\nb\nc")
    ]


def test_repeated_rows_equal_sql(spark, tmp_path):
    texts = ["a\nb\nc", "a\nb\nc", "x\na\nb\nc\ny", "x\na\nb\nc\ny", None, "", "d\ne\nf"]
    rows = [(i, t) for i in (None, 3, 3, 5) for t in texts]
    rows += [(9, "k\nk\nk\nk")] * 50
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    table.write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.op9_line_dedup(spark, str(tmp_path))
    found = sorted(map(tuple, out.select("doc_id", "n_removed", "text_sha256").collect()), key=repr)
    assert len(found) == len(rows)
    assert found == sorted(compare.connect(str(tmp_path)).execute(queries.OP9_SQL).fetchall(), key=repr)


def test_empty_table(spark, sf_dir):
    none = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("false")
    assert linededup.without_repeats(none).count() == 0


def test_query_equals_sql(spark, sf_dir):
    found = compare.difference(queries.op9_line_dedup(spark, sf_dir), compare.connect(sf_dir), queries.OP9_SQL)
    assert found is None
