"""The layered models: staging and zones as views, the risk table as a stored table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.mart import risk_zones
from ..operators.staging import stage_air, stage_fires, stage_quakes
from ..operators.zones import active_zones
from ..schemas import KINDS
from ..sinks.tables import read_table

SOURCES = KINDS


def staged(quakes: DataFrame, fires: DataFrame, air: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return stage_quakes(quakes), stage_fires(fires), stage_air(air)


def zones(quakes: DataFrame, fires: DataFrame, air: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return active_zones(*staged(quakes, fires, air), as_of)


def mart(quakes: DataFrame, fires: DataFrame, air: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Base tables to risk table as one plan."""
    return risk_zones(zones(quakes, fires, air, as_of), as_of)


def open_sources(spark: SparkSession, root: str, batched: bool = True) -> None:
    """The stored base tables below ``root`` under the names in ``SOURCES``."""
    for name in SOURCES:
        read_table(spark, name, f"{root.rstrip('/')}/{name}", batched=batched).createOrReplaceTempView(name)


def register_views(spark: SparkSession, as_of: datetime | None = None) -> None:
    """Staging and zone views over the views or tables named in ``SOURCES``."""
    tables = [spark.table(name) for name in SOURCES]
    views = dict(zip(("stg_earthquakes", "stg_wildfires", "stg_pollution"), staged(*tables)))
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    active_zones(*views.values(), as_of).createOrReplaceTempView("int_active_zones")


def build_mart(spark: SparkSession, as_of: datetime | None = None, table: str = "mart_risk_zones") -> None:
    """Store the risk table, highest raw score first."""
    rows = risk_zones(spark.table("int_active_zones"), as_of)
    rows.orderBy(F.desc("raw_risk_score"), "zone_lat", "zone_lon").write.mode("overwrite").saveAsTable(table)
