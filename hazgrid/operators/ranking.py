"""Running totals and ranks over a whole table without gathering it into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

_IN_BLOCK = 33  # bits that monotonically_increasing_id leaves for the rows of a partition


def running_totals(
    df: DataFrame, block: str, order: Sequence[Column], sums: dict[str, str], within: Sequence[str] = ()
) -> DataFrame:
    """Add, for each ``value -> name`` in ``sums``, the total of ``value`` over all rows before this one.

    ``block`` is a column that cuts the order into consecutive pieces (all rows of a
    lower block come first). Windows run inside blocks; the totals of the blocks
    before are added from a table with one row per block. ``within`` restarts the
    totals per group.
    """
    groups = list(within)
    inside = Window.partitionBy(*groups, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    per_block = df.groupBy(*groups, block).agg(*(F.sum(v).alias(f"_sum_{n}") for v, n in sums.items()))
    earlier = Window.partitionBy(*groups).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(
        *groups,
        block,
        *(F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums.values()),
    )
    local = df.select(
        "*", *(F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_in_{n}") for v, n in sums.items())
    )
    joined = local.join(offsets, [*groups, block])
    return joined.select(
        *df.columns, *((F.col(f"_in_{n}") + F.col(f"_before_{n}")).alias(n) for n in sums.values())
    )


def positions(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Add the place of each row in the order of the whole table, from 0, in a fixed number of jobs.

    Rows are dealt to tasks by ranges of the order, however many share the first column, and
    sorted there; the rows of the ranges before, a row for each range, are added.
    """
    path = scratch_path(df.sparkSession, "positions")
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField("_at", T.LongType())])
    placed = df.sparkSession.read.schema(schema).parquet(path)
    placed = placed.withColumn("_block", F.shiftright("_at", _IN_BLOCK))
    sizes = placed.groupBy("_block").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_block", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    at = F.col("_at").bitwiseAND(F.lit((1 << _IN_BLOCK) - 1)) + F.col("_before")
    return placed.join(before, "_block").withColumn(name, at).select(*df.columns, name)
