"""Near-duplicate documents by SimHash fingerprints, linked through pivot distance tables.

A fingerprint is linked to every other at ``DISTANCE`` or fewer differing bits. The pivot
table of a fingerprint holds its Hamming distances to 64 reference fingerprints besides the
origin: for each of four blocks of 16 bits, the 16 Walsh patterns of that block. By the
triangle inequality the coordinates of a linked pair differ by two at most. Taken relative
to the origin, the coordinates of one family change only with a bit of the family's block,
so a pair with two differing bits has equal coordinates in two of the four families at
least: these equal coordinates are join keys, six for each fingerprint, and no pair is
missed. Random references alone could not drive an equi-join: at a radius of two out of 64
each drops two thirds of the pairs, and to look them up takes five copies per coordinate.
Pairs that meet are discarded by the largest difference over eight more, random,
references, and survivors verified by their bits.

Keys with more than ``CROWD`` fingerprints are never paired off. Their fingerprints become
references themselves: two fingerprints within two bits share one at distance one or less
from both, so each is listed under all 65 such references, and everything listed under one
(65 at most) is linked to the smallest there. This gives the same components.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stored, whole_text, with_text_result

SHINGLE = 3
SEED = 42
DISTANCE = 2
CROWD = 64
BLOCK, BLOCKS = 16, 4
CHUNK = 1 << 16

#: Walsh pattern j has the bits i of which i & j has an even number of ones.
WALSH = np.array([sum(1 << i for i in range(BLOCK) if (i & j).bit_count() % 2 == 0) for j in range(BLOCK)], "u8")
REFERENCES = np.concatenate([WALSH << np.uint64(BLOCK * b) for b in range(BLOCKS)])
#: Eight more references for the check of coordinates, from a fixed rule.
SCATTERED = np.array([xxhash.xxh64_intdigest(bytes([i]), SEED) for i in range(8)], "u8")


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of a whole text; 0 for a text without words.

    Bytes of A-Z are lower-cased; words end at space and the ASCII control blanks, which is
    what ``bytes.lower`` and ``bytes.split`` do. A bit is set if more than half of the
    shingles' hashes have it. Shingles are counted in chunks, so a very long text takes the
    memory of its words and no more.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    ones = np.zeros(64, "i8")
    for at in range(0, len(shingles), CHUNK):
        part = shingles[at : at + CHUNK]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(seed)), "<u8", len(part))
        ones += np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="i8")
    return int(np.packbits(2 * ones > len(shingles), bitorder="little").view("<u8")[0])


def fingerprinted(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", to: str = "fingerprint") -> DataFrame:
    """All rows and columns of ``docs`` with the fingerprint as a signed 64-bit integer in column ``to``.

    A missing text counts as empty and has fingerprint 0. A column of that name in ``docs``
    is replaced.
    """

    def run(texts: pa.Array) -> pa.Array:
        found = [fingerprint(t, shingle) for t in texts.to_pylist()]
        return pa.array(np.array(found, "u8").view("i8"), pa.int64())

    return with_text_result(docs, to, whole_text(text), "bigint", lambda: run)


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Distances to the references, less the distance to the origin: one row per fingerprint."""
    origin = np.bitwise_count(fps).astype("i1")
    return np.bitwise_count(fps[:, None] ^ REFERENCES[None, :]).astype("i1") - origin[:, None]


def _keyed(fps: DataFrame) -> DataFrame:
    """Six rows for each fingerprint: a key of equal coordinates, the fingerprint and its check coordinates."""
    pairs = list(combinations(range(BLOCKS), BLOCKS - DISTANCE))

    def run(frames):
        for frame in frames:
            values = frame["fp"].to_numpy("i8").view("u8")
            for at in range(0, len(values), CHUNK):
                part = values[at : at + CHUNK]
                coordinates = pivot_table(part).reshape(len(part), BLOCKS, BLOCK)
                check = np.bitwise_count(part[:, None] ^ SCATTERED[None, :]).astype("u1")
                for k, families in enumerate(pairs):
                    rows = np.ascontiguousarray(coordinates[:, families, :]).reshape(len(part), -1)
                    keys = [xxhash.xxh64_intdigest(row, k) for row in rows]
                    yield pd.DataFrame(
                        {
                            "key": np.array(keys, "u8").view("i8"),
                            "fp": part.view("i8"),
                            "near": np.ascontiguousarray(check).view("i8").ravel(),
                        }
                    )

    return fps.select("fp").mapInPandas(run, "key bigint, fp bigint, near bigint")


def _largest_difference(a: str, b: str):
    """Of the eight packed check coordinates of two rows."""
    each = [
        F.abs(F.shiftright(a, 8 * i).bitwiseAND(F.lit(255)) - F.shiftright(b, 8 * i).bitwiseAND(F.lit(255)))
        for i in range(len(SCATTERED))
    ]
    return F.greatest(*each)


def links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints of ``fps`` (fp) that connect all that are linked."""
    keyed = stored(_keyed(fps), "simhash-keys")
    counts = stored(keyed.groupBy("key").count().filter("count > 1"), "simhash-counts")
    few = keyed.join(counts.filter(F.col("count") <= crowd).select("key"), "key")
    one = few.select("key", F.col("fp").alias("a"), F.col("near").alias("near_a"))
    two = few.select("key", F.col("fp").alias("b"), F.col("near").alias("near_b"))
    met = one.join(two, "key").filter("a < b").filter(_largest_difference("near_a", "near_b") <= DISTANCE)
    paired = met.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE).select("a", "b").distinct()

    many = keyed.join(counts.filter(F.col("count") > crowd).select("key"), "key").select("fp").distinct()
    around = F.concat(F.array(F.lit(0).cast("bigint")), F.expr("transform(sequence(0, 63), i -> shiftleft(1L, i))"))
    listed = many.select("fp", F.explode(around).alias("bit")).select(
        F.col("fp").bitwiseXOR(F.col("bit")).alias("reference"), "fp"
    )
    # 65 fingerprints at most have a reference in common
    hubs = listed.groupBy("reference").agg(F.collect_list("fp").alias("fps")).filter("size(fps) > 1")
    crowded = hubs.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a < b").distinct()
    return paired.unionByName(crowded)


def grouped(prints: DataFrame, row: str, fingerprint: str = "fingerprint") -> DataFrame:
    """``prints`` with ``first``, the smallest ``row`` value of each row's group of linked fingerprints.

    ``row`` is any orderable column; a row without it is in its group, but never its first.
    Copies are one fingerprint, summed before the shuffle, so a text that makes up a third
    of the rows is paired once.
    ``prints`` must be a stored table, as it is read twice.
    """
    packed = prints.select(
        F.struct(*[F.col(f"`{c}`") for c in prints.columns if c.lower() != "first"]).alias("doc"),
        F.col(row).alias("own"),
        F.col(fingerprint).alias("fp"),
    )
    fps = stored(packed.groupBy("fp").agg(F.min("own").alias("own")), "simhash-distinct")
    linked = components(links(fps), "simhash")
    labelled = fps.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "own", F.coalesce("component", "fp").alias("component")
    )
    first = labelled.groupBy("component").agg(F.min("own").alias("first"))
    by_print = labelled.join(first, "component").select("fp", "first")
    return packed.join(by_print, "fp").select("doc.*", "first")


def hexadecimal(name: str = "fingerprint"):
    return F.lower(F.lpad(F.hex(name), 16, "0"))


def near_copies(docs: DataFrame) -> DataFrame:
    """One row (doc_id, fingerprint, component_id) for each row of ``docs`` (doc_id, text).

    Missing and empty texts have fingerprint zero and link like any other. Repeated rows
    each get a row. A row without doc_id has a group, named by the smallest id in it, or
    null where no row of the group has one. An empty table gives an empty result.
    """
    prints = stored(fingerprinted(docs.select("doc_id", "text")).select("doc_id", "fingerprint"), "simhash-prints")
    return grouped(prints, "doc_id").select(
        "doc_id", hexadecimal().alias("fingerprint"), F.col("first").alias("component_id")
    )


def first_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` of which no near copy comes earlier; all columns as they are.

    Earlier means the smaller doc_id, a missing one last, and of repeated rows the one
    stored first: exactly one row of each group stays.
    """
    columns = docs.columns
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
        F.struct(
            F.col("doc_id").isNull().alias("missing"),
            F.col("doc_id").alias("id"),
            F.monotonically_increasing_id().alias("nth"),
        ).alias("row"),
    )
    prints = stored(fingerprinted(packed, text="doc.text"), "simhash-documents")
    return grouped(prints, "row").filter("row = first").select("doc.*")
