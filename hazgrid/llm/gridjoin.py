"""Near-duplicate vectors by the epsilon grid order join.

Unit vectors within cosine ``LEAST`` lie within epsilon = sqrt(2 - 2 * LEAST) of each other. They are
turned to their principal axes, cut into a grid of epsilon on the leading ones, and sorted by
label and grid cell, first axis first: the epsilon grid order. Ranges of this order are
blocks. Two blocks can hold a pair only if their bounding boxes come within epsilon; such pairs
of blocks are joined, each by halving the longer of two sequence intervals again and again
and leaving out intervals that are provably too far apart. What remains is compared by cosine
in double precision.

Vectors that are equal are one class with a number of members, so a vector that makes up a
third of the rows is one row here. A task sends links counted per class, and as many edges
as connect what it found, never all pairs of a dense group.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stored

LEAST = 0.98
#: Axes of the grid, axes that blocks meet by, classes in a block on average, rows of an interval that is compared as it is.
AXES, MEETING, BLOCK, LEAF = 8, 2, 4_096, 128
#: Classes that the principal axes are computed from at most; any axes give the same result.
SAMPLE = 20_000
#: Added to epsilon when boxes are compared, far above rounding and far below epsilon.
SLACK = 1e-6


def _matrix(vectors, width: int | None = None) -> np.ndarray:
    rows = [np.asarray(v, "f8") for v in vectors]
    width = width or max((len(v) for v in rows), default=1) or 1
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _units(rows: np.ndarray) -> np.ndarray:
    largest = np.abs(rows).max(axis=1, keepdims=True)
    scaled = rows / largest  # so that squares neither vanish nor overflow
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, which rounds nothing, so that squares neither vanish nor overflow."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True, initial=0.0))[1])


def axes_of(classes: DataFrame, width: int, sample: int = SAMPLE) -> np.ndarray:
    """Principal axes of about ``sample`` unit vectors at most, one per column, leading ones first."""
    count = classes.count()
    place = F.pmod(F.xxhash64("h1", F.lit("sample")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    some = classes.filter(place < min(1.0, sample / max(1, count))).select("embedding", F.lit("all").alias("one"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        units = _units(_matrix(frame["embedding"], width))
        _, axes = np.linalg.eigh(units.T @ units)
        return pd.DataFrame({"axis": range(width), "at": list(axes[:, ::-1].T)})

    rows = some.groupBy("one").applyInPandas(run, "axis int, at array<double>").collect()
    return np.array([row["at"] for row in sorted(rows)]).T if rows else np.eye(width)


def _in_grid(classes: DataFrame, axes: np.ndarray, epsilon: float) -> DataFrame:
    """Classes with their place on the leading axes and their grid cells."""
    leading = axes[:, :AXES]

    def run(frames):
        for frame in frames:
            if len(frame):
                places = _units(_matrix(frame["embedding"], len(axes))) @ leading
                cells = np.floor(places / epsilon).astype("i4")
                yield frame.assign(place=list(places), cell=list(cells))

    schema = "class long, part string, embedding array<double>, members long, place array<double>, cell array<int>"
    doubled = F.col("embedding").cast("array<double>").alias("embedding")
    return classes.select("class", "part", doubled, "members").mapInPandas(run, schema)


def _near_blocks(points: DataFrame, epsilon: float) -> DataFrame:
    """Pairs (one, two) of blocks of a part, one <= two, whose boxes come within epsilon.

    Blocks meet by the cells of the first ``MEETING`` axes that their boxes reach: a block is a short
    range of the grid order, so its box is narrow on one of them at least.
    """
    width = points.select(F.max(F.size("place"))).first()[0] or 1
    ends = [f(F.col("place")[i]).alias(f"{n}{i}") for i in range(width) for f, n in ((F.min, "low"), (F.max, "high"))]
    boxes = stored(points.groupBy("part", "block").agg(*ends), "grid-blocks")
    named = lambda side: [F.col(c).alias(f"{side}_{c}") for c in boxes.columns if c != "part"]
    left, right = boxes.select("part", *named("l")), boxes.select("part", *named("r"))
    meeting = [f"at{i}" for i in range(min(MEETING, width))]
    cell = lambda column, by: F.floor((F.col(column) + by) / epsilon)
    for i, at in enumerate(meeting):
        left = left.withColumn(at, F.explode(F.sequence(cell(f"l_low{i}", 0.0), cell(f"l_high{i}", 0.0))))
        near = F.sequence(cell(f"r_low{i}", -epsilon - SLACK), cell(f"r_high{i}", epsilon + SLACK))
        right = right.withColumn(at, F.explode(near))
    gap = lambda i: F.greatest(
        F.col(f"l_low{i}") - F.col(f"r_high{i}"), F.col(f"r_low{i}") - F.col(f"l_high{i}"), F.lit(0.0)
    )
    distance = sum((gap(i) * gap(i) for i in range(width)), F.lit(0.0))
    met = left.join(right, ["part", *meeting]).filter("l_block <= r_block").filter(distance <= (epsilon + SLACK) ** 2)
    return met.select(F.col("l_block").alias("one"), F.col("r_block").alias("two")).distinct()


def interval_join(left, right, epsilon: float, least: float, same: bool, report) -> None:
    """Compare two sequences (places, vectors, norms), both in grid order, interval by interval.

    ``report(i, j, hits)`` gets the starts of two compared intervals and which of their pairs
    reach ``least``. ``same``: both are one block, of which each pair is looked at once.
    """
    bound = (epsilon + SLACK) ** 2
    stack = [(0, len(left[0]), 0, len(right[0]))]
    while stack:
        a, b, c, d = stack.pop()
        if a >= b or c >= d or same and a >= d - 1:  # of one block, later rows meet earlier ones elsewhere
            continue
        p, q = left[0][a:b], right[0][c:d]
        gap = np.maximum(np.maximum(p.min(axis=0) - q.max(axis=0), q.min(axis=0) - p.max(axis=0)), 0.0)
        if gap @ gap > bound:
            continue
        if max(b - a, d - c) <= LEAF:
            hits = left[1][a:b] @ right[1][c:d].T / (left[2][a:b, None] * right[2][None, c:d]) >= least
            if same:
                hits &= np.arange(a, b)[:, None] < np.arange(c, d)[None, :]
            if hits.any():
                report(a, c, hits)
        elif b - a >= d - c:
            half = (a + b) // 2
            stack += [(a, half, c, d), (half, b, c, d)]
        else:
            half = (c + d) // 2
            stack += [(a, b, c, half), (a, b, half, d)]


def _connected(hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows and columns of a table of links, the first row or column (numbered on) that each hangs on."""
    rows, columns = hits.shape
    r, c = np.arange(rows), np.arange(rows, rows + columns)
    far = rows + columns
    while True:
        nr = np.minimum(r, np.where(hits, c[None, :], far).min(axis=1))
        nc = np.minimum(c, np.where(hits, nr[:, None], far).min(axis=0))
        if (nr == r).all() and (nc == c).all():
            return r, c
        r, c = nr, nc


def _join(epsilon: float, least: float):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        same = key[0] == key[1]
        both = []
        for frame in (rows[~rows["second"]], rows if same else rows[rows["second"]]):
            cells = np.array(frame["cell"].tolist(), "i4").reshape(len(frame), -1)
            frame = frame.iloc[np.lexsort([frame["class"].to_numpy("i8"), *cells.T[::-1]])]
            vectors = _scaled(_matrix(frame["embedding"]))
            norms = np.sqrt((vectors * vectors).sum(axis=1))
            numbers = [frame[c].to_numpy("i8") for c in ("class", "members")]
            both.append((_matrix(frame["place"]), vectors, norms, *numbers))
        one, two = both
        links = [np.zeros(len(one[3]), "i8"), np.zeros(len(two[3]), "i8")]
        ids = np.concatenate([one[3], two[3]])
        parent = list(range(len(ids)))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        def report(a, c, hits):
            n, m = hits.shape
            links[0][a : a + n] += hits @ two[4][c : c + m]
            links[1][c : c + m] += one[4][a : a + n] @ hits
            shift = 0 if same else len(one[3])
            number = np.concatenate([np.arange(a, a + n), shift + np.arange(c, c + m)])
            for i, to in enumerate(np.concatenate(_connected(hits)).tolist()):
                if to != i:
                    x, y = root(int(number[i])), root(int(number[to]))
                    if x != y:
                        parent[max(x, y)] = min(x, y)

        interval_join(one[:3], two[:3], epsilon, least, same, report)
        total = links[0] + links[1] if same else np.concatenate(links)
        to = [int(ids[root(i)]) for i in range(len(total))]
        out = pd.DataFrame({"class": ids[: len(total)], "links": total, "to": to})
        return out[out["links"] > 0]

    return run


def near_vectors(vectors: DataFrame, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """One row (vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding, label).

    Vectors link when their labels are equal and not null, they are of one length, and their
    cosine is ``least`` or more. Vectors that are null or zero or hold null or non-finite components
    link with nothing. ``component_id`` is the smallest id reachable; a row without id is in
    its component, but never names it. Repeated rows are other vectors that link.
    """
    epsilon = math.sqrt(2 - 2 * least)
    finite = "x IS NOT NULL AND NOT isnan(x) AND abs(x) < DOUBLE('Infinity')"
    sound = f"label IS NOT NULL AND forall(embedding, x -> {finite}) AND exists(embedding, x -> x <> 0)"
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        "embedding",
        F.concat_ws("/", F.size("embedding"), F.col("label")).alias("part"),
        F.coalesce(F.expr(sound), F.lit(False)).alias("sound"),
        # 128 bits that stand for the vector
        F.xxhash64("embedding").alias("h1"),
        F.xxhash64(F.lit(1), "embedding").alias("h2"),
    )
    keys = ["part", "h1", "h2"]
    classes = rows.filter("sound").groupBy(*keys).agg(
        F.min("vec_id").alias("first"), F.count("*").alias("members"), F.first("embedding").alias("embedding")
    )
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "grid-classes")
    size = classes.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("width")).first()
    axes = axes_of(classes, size["width"] or 1)
    order = ["part", *[F.col("cell")[i] for i in range(min(AXES, size["width"] or 1))], "class"]
    ranged = _in_grid(classes, axes, epsilon).repartitionByRange(max(1, -(-size["n"] // block)), *order)
    points = stored(ranged.withColumn("block", F.concat_ws("/", "part", F.spark_partition_id())), "grid-points")

    pairs = stored(_near_blocks(points, epsilon), "grid-pairs")
    needed = ["class", "embedding", "members", "place", "cell"]
    sides = pairs.select(F.col("one").alias("block"), "one", "two", F.lit(False).alias("second")).unionByName(
        pairs.filter("one <> two").select(F.col("two").alias("block"), "one", "two", F.lit(True).alias("second"))
    )
    met = points.join(sides, "block").select("one", "two", "second", "class", "embedding", "members", "place", "cell")
    joined = met.groupBy("one", "two").applyInPandas(_join(epsilon, least), "class long, links long, to long")
    found = stored(joined, "grid-links")

    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    edges = found.filter("class <> to").select(F.col("class").alias("a"), F.col("to").alias("b"))
    linked = components(edges, "grid").withColumnRenamed("node", "class")
    labelled = classes.join(linked, "class", "left").join(links, "class", "left").select(
        *keys, "first", "members", "links", F.coalesce("component", "class").alias("component")
    )
    smallest = labelled.groupBy("component").agg(F.min("first").alias("smallest"))
    by_class = labelled.join(smallest, "component").select(
        *keys, (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "smallest"
    )
    by_class = by_class.withColumn("sound", F.lit(True))
    out = rows.drop("embedding").join(by_class, [*keys, "sound"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("smallest")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
