"""One row per key, and only rows not landed before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import NATURAL_KEY


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key.

    A row-number filter of this form is run as a group limit before the shuffle
    as well as after it: each task sends at most ``n`` rows per key, so a key
    that holds most of the table does not end up in one task. Spark does this for ``n`` below
    ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000 unless set).
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_place", F.row_number().over(window))
    return ranked.filter(F.col("_place") <= n).drop("_place")


SALTS = 64


def first_per_key_salted(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, salts: int = SALTS) -> DataFrame:
    """``first_per_key`` for an ``n`` that is large or keys that are few.

    Rows of a key are first limited in ``salts`` parts by a hash of the whole row, and then
    together, so a key's last task gets ``n * salts`` rows at most, however many tasks read.
    """
    parted = df.withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    return first_per_key(first_per_key(parted, [*keys, "_part"], order, n).drop("_part"), keys, order, n)


def _delivery_order(events: DataFrame, kind: str) -> list[Column]:
    """Earliest delivery first; equal stamps are settled by the whole row."""
    rest = [c for c in events.columns if c not in NATURAL_KEY[kind] and c != "ingested_at"]
    return [F.asc_nulls_last(c) for c in ("ingested_at", *rest)]


def distinct_events(events: DataFrame, kind: str) -> DataFrame:
    """The earliest delivery of each observation."""
    return first_per_key(events, NATURAL_KEY[kind], _delivery_order(events, kind))


def new_events(incoming: DataFrame, landed: DataFrame, kind: str) -> DataFrame:
    """Accepted rows whose key has not landed yet, once each.

    An anti-join and a dedup in one shuffle: landed keys are stacked in front of the
    incoming rows, and a key whose first row is a landed one yields nothing. Missing
    key parts count as equal, and each task sends one row per key at most, so neither
    a key landed a thousand times nor one repeated in the batch becomes a hot group.
    """
    known = landed.select(*NATURAL_KEY[kind], F.lit(0).alias("_turn"))
    stacked = incoming.withColumn("_turn", F.lit(1)).unionByName(known, allowMissingColumns=True)
    order = [F.col("_turn"), *_delivery_order(incoming, kind)]
    return first_per_key(stacked, NATURAL_KEY[kind], order).filter(F.col("_turn") == 1).drop("_turn")


def latest_per_key(df: DataFrame, keys: Sequence[str], time: str, *ties: Column) -> DataFrame:
    """Replace-by-key semantics: the row with the newest ``time`` stands for its key."""
    return first_per_key(df, keys, [F.col(time).desc(), *ties])
