"""Token ids as Parquet files of list columns, for reading any stretch of a corpus on its own.

Documents are laid out by ascending doc_id in shards, each a contiguous range of ids and one
sorted file or more: bounds are quantiles of doc_id, so a shard holds a like number of
documents, and a task writes one shard. A row is a document: ``tokens`` (list of ids, end id
included) and ``n_tokens``; ``starts`` adds the ids of all documents before it. The second format version of
Parquet gives dictionary pages where values repeat and delta packing where they do not;
row groups and pages are small, and the page indexes that the writer adds let a reader that
asks for a range of ids or of one column skip all other pages.
"""

from __future__ import annotations

import math
import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices, whole_text
from .pretoken import Memory

END_ID = 2
#: Documents in a shard at least (in larger tables shards and their documents both grow, see ``shards_for``),
#: bytes in a row group and in a page.
SHARD_ROWS, GROUP_BYTES, PAGE_BYTES = 8_192, 8 << 20, 128 << 10
#: Units in a text that the library encodes, and texts in one call.
IN_A_TEXT, AT_A_TIME = 512, 16
WRITER = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.block.size": str(GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "compression": "zstd",
}
COLUMNS = ["doc_id", "n_tokens", "tokens"]


@lru_cache(maxsize=1)
def library(path: str) -> Memory:
    """The tokenizers library's encoder for one file, with a memory of units; once in each worker process."""
    # tasks share the cores out; threads of the library's own would spin beside them and hold memory each
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def ids_of(texts: list[str]):
        for at in range(0, len(texts), AT_A_TIME):  # the library's results are large objects
            for encoding in tokenizer.encode_batch_fast(texts[at : at + AT_A_TIME], add_special_tokens=False):
                yield np.array(encoding.ids, "<u4")

    line_end = int(next(ids_of(["\n"]))[0])

    def encode_units(units):
        """Units that begin and end with a mark or letter, but for one blank in front, go line by line in one text.

        No piece of a text reaches over a line end that is followed by such a unit, so the ids
        between line ends are those of the unit alone. Other units are texts of their own.
        """
        alone = [_is_tangled(unit) for unit in units]
        lines = [unit for unit, is_alone in zip(units, alone) if not is_alone]
        joined = ("\n".join([*lines[at : at + IN_A_TEXT], ""]) for at in range(0, len(lines), IN_A_TEXT))
        found = []
        for ids in ids_of(list(joined)):
            ends = np.flatnonzero(ids == line_end)
            packed = ids.tobytes()
            found += [packed[4 * a + 4 : 4 * b] for a, b in zip([-1, *ends.tolist()], ends.tolist())]
        of_lines, of_others = iter(found), ids_of([unit for unit, is_alone in zip(units, alone) if is_alone])
        return [next(of_others).tobytes() if is_alone else next(of_lines) for is_alone in alone]

    added = {token.content: i for i, token in tokenizer.get_added_tokens_decoder().items()}
    return Memory(encode_units, added)


def _is_tangled(unit: str) -> bool:
    body = unit[1:] if unit[:1] == " " else unit
    return not body or "\n" in body or body[0].isspace() or body[-1].isspace()


def shards_for(documents: int, shard_rows: int = SHARD_ROWS) -> int:
    """As many as make ``shard_rows`` documents each, in larger tables as many as twice the root of the documents make."""
    return -(-documents // max(shard_rows, 2 * math.isqrt(documents))) or 1


def tokenized(rows: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``rows`` (doc_id, text, ...) with ``tokens`` instead of the text: its ids and the end id."""
    rest = [c for c in rows.columns if c != "text"]
    schema = rows.select(*rest, F.array(F.lit(0)).alias("tokens")).schema

    def run(batches):
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            ids, sizes = library(path).encode(texts)
            closed = np.insert(ids, np.cumsum(sizes), end_id).view("<i4")
            ends = np.concatenate([[0], np.cumsum(sizes + 1)])
            tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(closed))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), tokens], names=[*rest, "tokens"])

    return rows.mapInArrow(run, schema)


def write(docs: DataFrame, out: str, path: str, end_id: int = END_ID, shard_rows: int = SHARD_ROWS) -> None:
    """Write the ids of ``docs`` (doc_id, text) to ``out``.

    A missing text is empty; documents without doc_id come first. Every row is written,
    repeated ones too (of one doc_id, in the order of their ids). Other columns are not part
    of the format.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    shards = shards_for(rows.count(), shard_rows)
    shares = [i / shards for i in range(1, shards)]
    # each bound right to a twentieth of a shard; this reads doc_id alone
    cuts = rows.agg(F.percentile_approx("doc_id", shares, max(1_000, 20 * shards))).first()[0] if shares else []
    bounds = [-math.inf, *sorted({float(cut) for cut in cuts or [0]}), math.inf]
    keyed = rows.withColumn("at", F.coalesce(F.col("doc_id").cast("double"), F.lit(-math.inf)))
    dealt = Bucketizer(splits=bounds, inputCol="at", outputCol="bucket").transform(keyed)
    # the shard is the partition, so no two shards meet in a task
    dealt = dealt.select(F.col("bucket").cast("int").alias("shard"), "doc_id", "text").repartitionById(len(bounds) - 1, F.col("shard"))
    ids = tokenized(dealt, path, end_id).select("shard", "doc_id", F.size("tokens").alias("n_tokens"), "tokens")
    ordered = ids.sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "tokens")
    ordered.write.options(**WRITER).partitionBy("shard").parquet(out)


def read(spark: SparkSession, out: str) -> DataFrame:
    """All rows as written; select the columns needed and filter on doc_id, and only their pages are read."""
    return spark.read.schema("doc_id bigint, n_tokens int, tokens array<int>, shard int").parquet(out)


def starts(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rows`` (shard, doc_id, n_tokens, ...) of ``read`` with ``start``: the ids of all documents before each.

    ``sizes`` is (shard, n_tokens) of all documents. These are summed for each shard, and
    shards (a row each) in order; a shard's documents, which are bounded, in order within it.
    """
    totals = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("shard", F.coalesce(before, F.lit(0)).alias("offset"))
    order = Window.partitionBy("shard").orderBy(F.asc_nulls_first("doc_id"), "nth")
    within = F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1))
    numbered = rows.withColumn("nth", F.monotonically_increasing_id())
    summed = numbered.withColumn("start", F.coalesce(within, F.lit(0))).drop("nth")
    return summed.join(offsets, "shard").withColumn("start", F.col("start") + F.col("offset")).drop("offset")


def checksums(rows: DataFrame) -> DataFrame:
    """``rows`` with ``ids_crc32`` in place of ``tokens``: crc32 of the ids as little-endian unsigned 32-bit integers."""
    rest = [c for c in rows.columns if c != "tokens"]
    schema = rows.select(*rest, F.lit(0).cast("bigint").alias("ids_crc32")).schema

    def run(batches):
        for batch in batches:
            tokens = batch.column("tokens")
            values = tokens.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            ends = tokens.offsets.to_numpy()
            sums = pa.array([zlib.crc32(values[a:b]) for a, b in zip(ends, ends[1:])], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), sums], names=[*rest, "ids_crc32"])

    return rows.mapInArrow(run, schema)


def document_ids(spark: SparkSession, out: str, first: int, last: int) -> DataFrame:
    """Documents with doc_id from ``first`` to ``last``: the filter reaches the page indexes."""
    return read(spark, out).filter(F.col("doc_id").between(first, last)).select(*COLUMNS)
