"""Landing files -> base tables, as a batch: the orchestrated counterpart of the streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import utc_now, with_event_time
from ..operators import normalize
from ..session import settled, use_utc
from ..sinks.tables import append_new
from ..sources import landing

READERS = {"earthquakes": landing.quake_files, "wildfires": landing.fire_files, "pollution": landing.air_files}


def judged(spark: SparkSession, kind: str, path: str, ingested_at: str | None = None) -> DataFrame:
    """Every landed record, typed, with its event time and the reason it is rejected, if it is."""
    use_utc(spark)
    stamp = ingested_at or f"{utc_now().isoformat()}+00:00"
    rows = with_event_time(normalize.CANDIDATES[kind](READERS[kind](spark, path), stamp), kind)
    late_reason = F.when(F.col("event_time").isNull(), "no_event_time")
    return rows.withColumn(normalize.REASON, F.coalesce(normalize.REASON, late_reason))


def ingest(
    spark: SparkSession, kind: str, path: str, table: str, rejects: str, run: int, ingested_at: str | None = None
) -> DataFrame:
    """Append what is new to the table, the rejects beside it; returns the run's counts.

    ``run`` numbers the runs of a table upwards; repeating one replaces its rows.
    """
    rows = settled(judged(spark, kind, path, ingested_at), f"ingest-{kind}")
    good = rows.filter(F.col(normalize.REASON).isNull()).drop(normalize.REASON)
    landed = append_new(good, kind, table, run)
    normalize.rejected(rows).write.mode("overwrite").parquet(f"{rejects.rstrip('/')}/{kind}/run={run}")
    return normalize.ingest_stats({kind: rows}).withColumn("landed", F.lit(landed).cast("bigint"))
