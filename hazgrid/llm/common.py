"""What the operators of this folder share: tables, stored steps, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

DOCUMENT = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Lineage ends at the files, so a lost executor costs a read and not the work before it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows and bytes of an Arrow batch at most: texts differ in length by orders of magnitude.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20


def with_text_result(
    docs: DataFrame, to: str, source: Column, kind: str, begin: Callable[[], Callable[[pa.Array], pa.Array]]
) -> DataFrame:
    """All columns of ``docs`` with ``to``, what a function makes of ``source``; a column of that name is replaced.

    Only ``source`` goes to the Python workers and only the result comes back: rows stay where
    they are. ``begin`` makes the function, once in each task; it gets a few rows at a time.
    """
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        docs.sparkSession.conf.set(f"spark.sql.execution.arrow.{key}", str(most))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        function = begin()
        for batch in batches:
            parts = [function(batch.slice(at, 256)) for at in range(0, len(batch), 256)]
            yield pa.concat_arrays(parts) if len(parts) != 1 else parts[0]

    # not to be evaluated once more by a filter on the result
    made = F.arrow_udf(run, kind).asNondeterministic()
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != to.lower()]
    return docs.select(*kept, made(source).alias(to))


def slices(batches, rows: int = 512):
    """Arrow batches in slices, so that a worker holds the results of a few rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def whole_text(name: str = "text") -> Column:
    """The text, a missing one being empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def in_fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``folds``; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, component) for each node that has an edge.

    ``component`` is the smallest node reachable. Each round maps every node to the smallest
    of itself and its neighbours and contracts the edges by that map, which at least halves
    the nodes left, so rounds follow the logarithm of the longest chain. A hub is summed
    map-side before it is shuffled; contracted copies of an edge fold into one. The maps are
    stored and applied backwards at the end. Empty edges give an empty table.
    """
    spark = edges.sparkSession

    def contracted(pairs: DataFrame) -> DataFrame:
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return stored(ordered.filter("a <> b").distinct(), f"{name}-edges")

    left, maps = contracted(edges.select("a", "b")), []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        step = stored(step.select("node", F.least("node", "b").alias("component")), f"{name}-map")
        maps.append(step)
        for end in ("a", "b"):
            # the map has one row for each node, so a hub is hot on one side only, which adaptive execution splits
            to = step.select(F.col("node").alias(end), F.col("component").alias("to"))
            left = left.join(to, end).withColumn(end, F.col("to")).select("a", "b")
        left = contracted(left)
    if not maps:
        return spark.createDataFrame([], edges.select(F.col("a").alias("node"), F.col("a").alias("component")).schema)
    reached = maps.pop()
    while maps:
        later = reached.select(F.col("node").alias("component"), F.col("component").alias("last"))
        reached = maps.pop().join(later, "component", "left").select(
            "node", F.coalesce("last", "component").alias("component")
        )
    return reached


def labelled_sample(docs: DataFrame, labels: DataFrame, by: str, bound: int) -> DataFrame:
    """Documents with their labels, about ``bound`` at most for each value of the SQL expression ``by``.

    A document is taken by a hash of its id, so the sample is the same in every run. Of labels
    repeated for one document the largest holds; documents and labels without id, and values
    that are null, take no part. Of rows repeated for one document the smallest is taken. The result
    has the document's columns and ``grade``, the value. Only sampled labels are broadcast, and their number is bounded.
    """
    names = [c for c in labels.columns if c != "doc_id"]
    once = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(*[F.max(c).alias(c) for c in names])
    graded = once.select(F.col("doc_id"), F.expr(by).alias("grade")).filter("grade IS NOT NULL")
    counts = {row["grade"]: row["count"] for row in graded.groupBy("grade").count().collect()}
    share = F.lit(1.0)
    for grade, count in counts.items():
        share = F.when(F.col("grade") == grade, min(1.0, bound / count)).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "doc_id"]).alias("rest")
    rows = docs.join(F.broadcast(graded.filter(place < share)), "doc_id").select("doc_id", rest, "grade")
    return rows.groupBy("doc_id", "grade").agg(F.min("rest").alias("rest")).select("doc_id", "rest.*", "grade")
