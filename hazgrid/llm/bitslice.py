"""Exact search for the highest inner products with a bit-sliced index.

Vectors are quantised to integers and dealt into blocks of bounded size. In a block each
component is stored as bit slices: bitmaps over the rows, one for each binary digit, sorted by
id. A query adds up the slices of all components, each as often as the digits of its own
component say: slices of one weight go through full adders (three slices in, their sum and a
carry out) until one slice of each weight is left, which are the digits of all rows' scores.
The best rows are then read off from the most significant slice down, and rows that tie at
the boundary are taken in the order of their ids.

The index of a block is built once and stored; it holds all that a score needs, so vectors stay
behind. Piles of queries are met with all indexes; a task holds one pile and one index. Every query
sends ``k`` rows per block to the last step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SCALE, K = 64, 20
#: Rows and queries in a block, on average.
ROWS, QUERIES = 32_768, 512


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): components as ``floor(scale * x)``, one row for each vector.

    Rows without id take no part, nor do vectors that are null or hold null or non-finite
    components. Rows that repeat an id are rows like all others. A shorter vector has zeros
    behind its end, as inner products see it.
    """
    finite = "x IS NOT NULL AND NOT isnan(x) AND abs(x) < DOUBLE('Infinity')"
    whole = vectors.filter(f"vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> {finite})")
    v = F.expr(f"transform(embedding, x -> floor({scale} * CAST(x AS DOUBLE)))")
    return whole.select("vec_id", v.alias("v"))


def matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), "i8")
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


@dataclass
class Slices:
    """The bit slices of a block of rows: ``plain`` holds bitmaps, one for each component and digit.

    Components are stored as their distance from ``low``, the smallest in the block.
    """

    count: int
    low: np.ndarray  # (width,)
    digits: int
    plain: np.ndarray  # (width * digits, words)

    @classmethod
    def of(cls, values: np.ndarray) -> Slices:
        count, width = values.shape
        low = values.min(axis=0) if count else np.zeros(width, "i8")
        above = (values - low).astype("u8")
        digits = max(1, int(above.max(initial=0)).bit_length())
        words = -(-count // 64)
        bits = np.zeros((width, digits, words * 64), "u1")
        for digit in range(digits):
            bits[:, digit, :count] = (above >> np.uint64(digit)).T & np.uint64(1)
        return cls(count, low, digits, np.packbits(bits, axis=2, bitorder="little").view("u8").reshape(-1, words))

    def __post_init__(self):
        self.width, words = len(self.low), self.plain.shape[1]
        self.slices = np.concatenate([self.plain, ~self.plain])
        full = np.zeros(words * 64, "u1")
        full[: self.count] = 1
        self.all = np.packbits(full, bitorder="little").view("u8")

    def scores(self, query: np.ndarray) -> list[np.ndarray]:
        """The digits of all rows' inner products, up to a constant, least significant first.

        A negative component takes the complements, so that only additions are left.
        """
        size = np.abs(query)
        column = np.arange(self.width) + np.where(query < 0, self.width, 0)
        weights: list[list[np.ndarray]] = []
        for digit in range(int(size.max(initial=0)).bit_length()):
            chosen = column[(size >> digit) & 1 == 1]
            for own in range(self.digits if len(chosen) else 0):
                while len(weights) <= digit + own:
                    weights.append([])
                weights[digit + own].append(self.slices[chosen * self.digits + own])
        out, weight = [], 0
        while weight < len(weights):
            parts = weights[weight]
            if weight + 1 == len(weights) and sum(map(len, parts)) > 1:
                weights.append([])
            pile = np.concatenate(parts) if parts else np.zeros((0, len(self.all)), "u8")
            while len(pile) > 1:
                third = max(1, len(pile) // 3)
                a, b = pile[:third], pile[third : 2 * third]
                either = a ^ b
                if len(pile) == 2:
                    weights[weight + 1].append(a & b)
                    pile = either
                    continue
                c = pile[2 * third : 3 * third]
                weights[weight + 1].append((a & b) | (c & either))
                pile = np.concatenate([either ^ c, pile[3 * third :]])
            out.append(pile[0] if len(pile) else np.zeros_like(self.all))
            weight += 1
        return out

    def best(self, query: np.ndarray, k: int, own: int | None = None) -> tuple[np.ndarray, list[int]]:
        """Places and scores of the ``k`` rows with the highest inner products, ties to the first; never ``own``."""
        digits = self.scores(query)
        open_, sure = self.all.copy(), np.zeros_like(self.all)
        if own is not None:
            open_[own // 64] &= ~np.uint64(1 << (own % 64))
        left = k
        for digit in reversed(digits):
            ones = open_ & digit
            count = int(np.bitwise_count(ones).sum())
            if count > left:
                open_ = ones
            else:
                sure |= ones
                left -= count
                open_ &= ~digit
                if not left:
                    break
        places = lambda bitmap: np.flatnonzero(np.unpackbits(bitmap.view("u1"), bitorder="little"))
        found = np.concatenate([places(sure), places(open_)[:left]])
        return found, self._totals(digits, query, found)

    def _totals(self, digits: list[np.ndarray], query: np.ndarray, places: np.ndarray) -> list[int]:
        """Whole scores from their digits; what a long can't hold stops at its ends."""
        sizes = query.tolist()
        # what the smallest values add, less what complements of negative components add to all rows
        constant = sum(q * low for q, low in zip(sizes, self.low.tolist()))
        constant += sum(q for q in sizes if q < 0) * ((1 << self.digits) - 1)
        out = []
        for place in places.tolist():
            word, bit = divmod(place, 64)
            total = constant + sum((int(digit[word]) >> bit & 1) << n for n, digit in enumerate(digits))
            out.append(min(max(total, -(1 << 63)), (1 << 63) - 1))
        return out


INDEX = "block int, count int, digits int, ids binary, rows binary, low binary, plain binary"


def _indexed(key, rows: pd.DataFrame) -> pd.DataFrame:
    """One row: the index of a block, in the order of ids."""
    rows = rows.sort_values(["vec_id", "row"])
    index = Slices.of(matrix(rows["v"], max(map(len, rows["v"]))))
    parts = [rows["vec_id"].to_numpy("i8"), rows["row"].to_numpy("i8"), index.low, index.plain]
    return pd.DataFrame([[key[0], index.count, index.digits, *(np.ascontiguousarray(p).tobytes() for p in parts)]])


def _search(k: int):
    def search(queries: pd.DataFrame, indexes: pd.DataFrame) -> pd.DataFrame:
        found = [np.zeros((0, 4), "i8")]
        for held in indexes.itertuples():
            ids, rows, low = (np.frombuffer(part, "i8") for part in (held.ids, held.rows, held.low))
            plain = np.frombuffer(held.plain, "u8").reshape(len(low) * held.digits, -(-held.count // 64))
            index, place = Slices(held.count, low, held.digits, plain), {row: i for i, row in enumerate(rows.tolist())}
            for query_id, row, v in zip(queries["vec_id"], queries["row"], queries["v"]):
                # components that only one side has add nothing
                query = np.zeros(len(low), "i8")
                query[: len(v)] = v[: len(low)]
                best, scores = index.best(query, k, place.get(row))
                found.append(np.array([np.full(len(best), query_id), np.full(len(best), row), ids[best], scores], "i8").T)
        return pd.DataFrame(np.concatenate(found), columns=["query_id", "row", "vec_id", "score"])

    return search


def top_k(vectors: DataFrame, queries: str, k: int = K, rows: int = ROWS, asked: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for each row that the SQL condition ``queries`` holds for.

    A row is no candidate of its own query; other rows with its id are, and ask for themselves.
    Fewer rows than ``k`` are all returned; without queries or rows there is no result. Other
    columns of ``vectors`` (vec_id, embedding) are not looked at.
    """
    whole = quantised(vectors.select("vec_id", "embedding"))
    base = stored(whole.withColumn("row", F.monotonically_increasing_id()), "slices-vectors")
    wanted = base.filter(queries)
    blocks, piles = max(1, -(-base.count() // rows)), max(1, -(-wanted.count() // asked))
    of = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = stored(base.withColumn("block", of(blocks)).groupBy("block").applyInPandas(_indexed, INDEX), "slices-index")
    left = wanted.withColumns({"pile": of(piles), "block": each(blocks)}).groupBy("block", "pile")
    right = index.withColumn("pile", each(piles)).groupBy("block", "pile")
    found = left.cogroup(right).applyInPandas(_search(k), "query_id long, row long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
