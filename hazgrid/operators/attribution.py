"""Shapes of per-row feature contributions: map, ordered drivers, long table, mean size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FEATURES

TOP_DRIVERS = 3


def contribution_map(features: Sequence[str]) -> Column:
    """feature -> value from columns of the same names, in the given order."""
    names = F.array(*(F.lit(f) for f in features))
    return F.map_from_arrays(names, F.array(*(F.col(f) for f in features)))


def top_drivers(contributions: Column, n: int = TOP_DRIVERS) -> Column:
    """The ``n`` strongest entries by absolute value; equal ones keep the model's order."""
    entries = F.transform(
        F.map_entries(contributions),
        lambda e, i: F.struct(
            (-F.abs(e["value"])).alias("weakness"), i.alias("place"), e["key"].alias("feature"), e["value"].alias("value")
        ),
    )
    strongest = F.slice(F.array_sort(entries), 1, n)
    return F.transform(strongest, lambda e: F.struct(e["feature"].alias("feature"), e["value"].alias("value")))


def long_form(rows: DataFrame, contributions: str, keep: Sequence[str], features: Sequence[str] = FEATURES) -> DataFrame:
    """One row per row and feature: contribution, and the feature's own value where it is a column."""
    unfolded = rows.select("*", F.explode(contributions).alias("feature", "contribution"))
    own = F.coalesce(*(F.when(F.col("feature") == f, F.col(f).cast("double")) for f in features if f in rows.columns))
    kept = [F.col(c).alias(c) for c in keep]
    return unfolded.select(*kept, "feature", own.alias("feature_value"), "contribution")


def mean_absolute(rows: DataFrame, contributions: str) -> DataFrame:
    """Average size of each feature's contribution over all rows."""
    unfolded = rows.select(F.explode(contributions).alias("feature", "contribution"))
    return unfolded.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
