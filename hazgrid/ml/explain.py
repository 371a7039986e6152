"""Additive feature contributions of a boosted-tree model (path-dependent tree Shapley values).

Every leaf is a box: per feature on its path an interval, and the share ``z`` of
training weight that passes that feature's splits. For a row, feature j passes
(o=1) or not (o=0), and the Shapley value of feature i in that leaf is

    value * (o_i - z_i) * integral over t in [0, 1] of prod_{j != i} (t o_j + (1 - t) z_j)

The integrand is a polynomial in t, so Gauss-Legendre nodes give the exact integral.

Leaves of a model of bounded size are broadcast and rows stay where they are. A larger model's leaves
are a table: chunks of leaves meet blocks of rows, and the partial contributions of each row are
added up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import attribution
from ..schemas import FEATURES, ZONE
from ..session import settled
from .model import load, scored

#: Nodes of a model whose leaves are broadcast, at most; rows in a block and leaves in a chunk, on average.
MAX_NODES, ROWS, LEAVES = 1_000_000, 8_192, 16_384


@dataclass
class Boxes:
    """All leaves of all trees; paths are padded with a feature that always passes."""

    value: np.ndarray    # (leaves,)
    feature: np.ndarray  # (leaves, depth)
    low: np.ndarray      # (leaves, depth), exclusive
    high: np.ndarray     # (leaves, depth), inclusive
    share: np.ndarray    # (leaves, depth)

    @property
    def base(self) -> float:
        """Expected margin when nothing is known about a row."""
        return float(np.sum(self.value * self.share.prod(axis=1)))


def is_small(model: GBTClassificationModel, most: int = MAX_NODES) -> bool:
    """Whether the model's trees and depth leave room for ``most`` nodes only."""
    return model.getNumTrees * (2 ** (model.getOrDefault("maxDepth") + 1) - 1) <= most


def _nodes(spark: SparkSession, path: str) -> DataFrame:
    node = "nodeData"
    return spark.read.parquet(f"{path.rstrip('/')}/model/data").select(
        "treeID",
        f"{node}.id",
        f"{node}.prediction",
        F.get(f"{node}.impurityStats", 0).alias("weight"),
        f"{node}.leftChild",
        f"{node}.rightChild",
        f"{node}.split.featureIndex",
        F.get(f"{node}.split.leftCategoriesOrThreshold", 0).alias("threshold"),
    )


def _leaves(by_id: dict, tree_weight: float) -> list[tuple[float, list[tuple]]]:
    """(value, path) of each leaf of a tree; a path has (feature, low, high, share) for each of its features."""
    leaves, pending = [], [(by_id[0], {})]
    while pending:
        here, box = pending.pop()
        if here["leftChild"] < 0:
            leaves.append((tree_weight * here["prediction"], [(f, *limits) for f, limits in box.items()]))
            continue
        f, cut = here["featureIndex"], here["threshold"]
        low, high, share = box.get(f, (-np.inf, np.inf, 1.0))
        left, right = by_id[here["leftChild"]], by_id[here["rightChild"]]
        pending.append((left, {**box, f: (low, min(high, cut), share * left["weight"] / here["weight"])}))
        pending.append((right, {**box, f: (max(low, cut), high, share * right["weight"] / here["weight"])}))
    return leaves


def _boxes(leaves: Sequence[tuple[float, list[tuple]]]) -> Boxes:
    depth = max((len(path) for _, path in leaves), default=1) or 1
    padding = (0, -np.inf, np.inf, 1.0)
    paths = [[tuple(part) for part in path] + [padding] * (depth - len(path)) for _, path in leaves]
    table = np.array(paths, dtype=float).reshape(len(paths), depth, 4)
    return Boxes(
        value=np.array([v for v, _ in leaves], dtype=float),
        feature=table[:, :, 0].astype(int),
        low=table[:, :, 1],
        high=table[:, :, 2],
        share=table[:, :, 3],
    )


def model_boxes(spark: SparkSession, path: str, model: GBTClassificationModel) -> Boxes:
    """All leaves from the stored node table, on the driver: for models that ``is_small`` finds bounded."""
    trees: dict[int, dict] = {}
    for row in _nodes(spark, path).collect():
        trees.setdefault(row["treeID"], {})[row["id"]] = row
    return _boxes([leaf for tree, by_id in trees.items() for leaf in _leaves(by_id, model.treeWeights[tree])])


def leaf_table(spark: SparkSession, path: str, model: GBTClassificationModel) -> DataFrame:
    """(value, expected, path) of each leaf, a tree at a time: Spark holds a whole tree in one place as well.

    ``expected`` is what the leaf adds to the margin when nothing is known about a row.
    """
    weights = spark.createDataFrame(list(enumerate(model.treeWeights)), "treeID int, tree_weight double")

    def walk(tree: pd.DataFrame) -> pd.DataFrame:
        by_id = {row["id"]: row for row in tree.to_dict("records")}
        leaves = _leaves(by_id, float(tree["tree_weight"].iloc[0]))
        expected = [value * float(np.prod([part[3] for part in path])) for value, path in leaves]
        return pd.DataFrame({"value": [v for v, _ in leaves], "expected": expected, "path": [p for _, p in leaves]})

    schema = "value double, expected double, path array<struct<feature: int, low: double, high: double, share: double>>"
    return _nodes(spark, path).join(weights, "treeID").groupBy("treeID").applyInPandas(walk, schema)


def _contributions(x: np.ndarray, boxes: Boxes, per_step: int = 64) -> np.ndarray:
    """What the leaves add to each feature's contribution: a row of ``x`` each."""
    nodes, weights = np.polynomial.legendre.leggauss(boxes.share.shape[1] // 2 + 1)
    times, total = (nodes + 1) / 2, np.zeros(x.shape)
    for start in range(0, len(boxes.value), per_step):
        part = slice(start, start + per_step)
        z, f = boxes.share[part], boxes.feature[part]
        seen = x[:, f]
        passes = ((seen > boxes.low[part]) & (seen <= boxes.high[part])).astype(float)
        integral = np.zeros_like(passes)
        for t, w in zip(times, weights / 2):
            factor = t * passes + (1 - t) * z
            integral += w * factor.prod(axis=2, keepdims=True) / factor
        share_of_leaf = boxes.value[part][:, None] * (passes - z) * integral
        place = (f.reshape(-1, 1) == np.arange(x.shape[1])).astype(float)
        total += share_of_leaf.reshape(len(x), -1) @ place
    return total


def with_contributions(rows: DataFrame, boxes: Boxes, features: Sequence[str] = FEATURES) -> DataFrame:
    """Add ``contribution``, one value per feature. Rows stay where they are: no shuffle."""
    sent, names = rows.sparkSession.sparkContext.broadcast(boxes), list(features)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(contribution=list(_contributions(batch[names].to_numpy(dtype=float), sent.value)))

    schema = T.StructType([*rows.schema.fields, T.StructField("contribution", T.ArrayType(T.DoubleType()))])
    return rows.mapInPandas(explain, schema)


def with_summed_contributions(
    rows: DataFrame, leaves: DataFrame, features: Sequence[str] = FEATURES, per_block: int = ROWS, per_chunk: int = LEAVES
) -> DataFrame:
    """The same from a table of leaves of any size (see ``leaf_table``): a task holds a block of rows and a chunk of leaves.

    ``leaves`` must be stored. A row's partial contributions, one for each chunk, are added up before and after the shuffle.
    """
    names = list(features)
    numbered = settled(rows.withColumn("_row", F.monotonically_increasing_id()), "explained-rows")
    blocks, chunks = max(1, -(-numbered.count() // per_block)), max(1, -(-leaves.count() // per_chunk))
    dealt = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = numbered.select("_row", *names, dealt("_row", blocks).alias("block"), each(chunks).alias("chunk"))
    placed = leaves.withColumn("chunk", dealt(F.monotonically_increasing_id(), chunks))
    right = placed.select("value", "path", "chunk", each(blocks).alias("block"))
    made = [f"_contribution{i}" for i in range(len(names))]

    def explain(block: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
        paths = [[tuple(part.values()) if isinstance(part, dict) else tuple(part) for part in path] for path in chunk["path"]]
        total = _contributions(block[names].to_numpy(dtype=float), _boxes(list(zip(chunk["value"], paths))))
        return pd.DataFrame(total, columns=made).assign(_row=block["_row"].to_numpy())

    schema = ", ".join(f"{c} double" for c in made) + ", _row long"
    met = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInPandas(explain, schema)
    summed = met.groupBy("_row").agg(*(F.sum(c).alias(c) for c in made))
    return numbered.join(summed, "_row").withColumn("contribution", F.array(*made)).drop("_row", *made)


def explained(rows: DataFrame, path: str, features: Sequence[str] = FEATURES, most: int = MAX_NODES) -> DataFrame:
    """Feature rows with score, margin, base value, contribution map and the strongest drivers.

    ``base_value`` plus all contributions is the margin, the weighted sum of the trees. Up to ``most``
    nodes are sent to every task; the leaves of a larger model stay a table. Both ways add up the same terms.
    """
    spark = rows.sparkSession
    model = load(path)
    known = scored(model, rows.select(*features))
    if is_small(model, most):
        boxes = model_boxes(spark, path, model)
        base, held = boxes.base, with_contributions(known, boxes, features)
    else:
        leaves = settled(leaf_table(spark, path, model), "leaves")
        base = leaves.agg(F.sum("expected")).first()[0]
        held = with_summed_contributions(known, leaves, features)
    names = F.array(*(F.lit(f) for f in features))
    mapped = held.withColumn("shap_values", F.map_from_arrays(names, F.col("contribution"))).drop("contribution")
    return mapped.withColumns(
        {"base_value": F.lit(base), "top_drivers": attribution.top_drivers(F.col("shap_values"))}
    )


def attributions(rows: DataFrame, path: str) -> DataFrame:
    """One record per zone, as exported."""
    return explained(rows, path).select(*ZONE, "score", "base_value", "shap_values", "top_drivers")


def attribution_long(rows: DataFrame, path: str) -> DataFrame:
    """(zone, feature, value, contribution): the table behind distribution plots."""
    return attribution.long_form(explained(rows, path), "shap_values", keep=ZONE)


def attribution_of_top(rows: DataFrame, path: str, n: int = 3) -> DataFrame:
    """The same for the ``n`` highest-scored zones: the table behind step-by-step plots."""
    top = explained(rows, path).orderBy(F.desc("score"), *ZONE).limit(n)
    return attribution.long_form(top, "shap_values", keep=(*ZONE, "score", "base_value"))


def attribution_importance(rows: DataFrame, path: str) -> DataFrame:
    """Mean absolute contribution per feature."""
    return attribution.mean_absolute(explained(rows, path), "shap_values")
