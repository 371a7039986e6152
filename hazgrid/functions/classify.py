"""Named classes of a measure, as CASE expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Steps = Sequence[tuple[float, str]]

# Class bounds.
DEPTH_BELOW: Steps = ((20.0, "shallow"), (70.0, "intermediate"))
MAG_BELOW: Steps = ((2.0, "micro"), (4.0, "minor"), (6.0, "moderate"), (7.0, "strong"))
FRP_BELOW: Steps = ((10.0, "low"), (100.0, "moderate"), (1000.0, "high"))
RISK_ABOVE: Steps = ((100.0, "critical"), (50.0, "high"), (20.0, "moderate"))
SCORE_ABOVE: Steps = ((0.7, "critical"), (0.4, "high"), (0.2, "moderate"))


def _ladder(branches, otherwise: str) -> Column:
    chain = F
    for test, label in branches:
        chain = chain.when(test, label)
    return chain.otherwise(otherwise)


def below(value: Column, steps: Steps, otherwise: str) -> Column:
    """Label of the first bound that ``value`` is under."""
    return _ladder([(value < bound, label) for bound, label in steps], otherwise)


def above(value: Column, steps: Steps, otherwise: str) -> Column:
    """Label of the first bound that ``value`` is over."""
    return _ladder([(value > bound, label) for bound, label in steps], otherwise)


def depth_class(depth_km: Column) -> Column:
    return below(depth_km, DEPTH_BELOW, "deep")


def mag_class(mag: Column) -> Column:
    return below(mag, MAG_BELOW, "major")


def frp_class(frp: Column) -> Column:
    return below(frp, FRP_BELOW, "extreme")


def risk_level(raw_score: Column) -> Column:
    return above(raw_score, RISK_ABOVE, "low")


def risk_label(probability: Column) -> Column:
    return above(probability, SCORE_ABOVE, "low")
