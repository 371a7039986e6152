"""Exact, repeatable train/test split per class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import LABEL, ZONE
from .ranking import running_totals

TRAIN_SHARE = 0.8
SEED = 42
MIN_POSITIVES = 5
_BLOCK_DIGITS = 4  # 65,536 blocks of like size


def split_by_order(
    rows: DataFrame, block: str, order: Sequence[Column], strata: Sequence[str], share: float = TRAIN_SHARE
) -> DataFrame:
    """Mark the first ``share`` of each stratum, in the given order, as training rows.

    Positions are running counts over blocks, so a stratum is never gathered into one
    task; stratum sizes come from one small grouping. Without ``strata`` all rows are one.
    """
    counted = running_totals(rows.withColumn("_one", F.lit(1)), block, order, {"_one": "_place"}, within=strata)
    if strata:
        sizes = rows.groupBy(*strata).agg(F.count("*").alias("_size"))
        counted = counted.join(F.broadcast(sizes), list(strata))  # one row per class
    else:
        counted = counted.withColumn("_size", F.lit(rows.count()))
    quota = F.floor(F.col("_size") * F.lit(share) + F.lit(0.5))
    return counted.withColumn("is_train", F.col("_place") < quota).select(*rows.columns, "is_train")


def stratified_split(
    rows: DataFrame,
    label: str = LABEL,
    keys: Sequence[str] = ZONE,
    share: float = TRAIN_SHARE,
    seed: int = SEED,
) -> DataFrame:
    """Seeded split: rows are ordered by a hash of their key, stratified when positives are not too few.

    The hash is the MD5 of key and seed as text, which other engines have too.
    """
    positives = rows.agg(F.count_if(F.col(label) == 1)).first()[0]
    text = F.concat_ws(",", *(F.col(k).cast("string") for k in keys), F.lit(str(seed)))
    mixed = rows.withColumn("_hash", F.md5(text)).withColumn("_block", F.substring("_hash", 1, _BLOCK_DIGITS))
    strata = [label] if positives > MIN_POSITIVES else []
    marked = split_by_order(mixed, "_block", [F.col("_hash"), *(F.col(k) for k in keys)], strata, share)
    return marked.select(*rows.columns, "is_train")
