"""What a source holds: rows, gaps, time span, a first look."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def source_profile(df: DataFrame, source: str, time: str = "event_time") -> DataFrame:
    """One row per column with its number of NULLs, from a single aggregate over the table."""
    columns = df.columns
    totals = df.agg(
        F.count("*").alias("rows"),
        F.min(time).alias("first_event"),
        F.max(time).alias("last_event"),
        *(F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(columns)),
    )
    gaps = F.array(
        *(
            F.struct(F.lit(c).alias("column_name"), F.col(f"nulls_{i}").alias("nulls"))
            for i, c in enumerate(columns)
        )
    )
    return totals.select(F.lit(source).alias("source"), "rows", "first_event", "last_event", F.inline(gaps))


def first_look(df: DataFrame, n: int = 3) -> tuple[list[str], DataFrame]:
    """The header and a few rows."""
    return df.columns, df.limit(n)
