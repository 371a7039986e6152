"""The two fixed dimensions of the air feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import COUNTRIES, PARAMETERS


def _values(spark: SparkSession, rows: dict[int, str], key: str, name: str) -> DataFrame:
    listed = ", ".join(f"({i}, '{text}')" for i, text in rows.items())
    return spark.sql(f"SELECT * FROM VALUES {listed} AS dim({key}, {name})")


def parameters(spark: SparkSession) -> DataFrame:
    return _values(spark, PARAMETERS, "parameter_id", "parameter")


def countries(spark: SparkSession) -> DataFrame:
    return _values(spark, COUNTRIES, "country_id", "country")


def requests(spark: SparkSession) -> DataFrame:
    """Every country with every parameter: the requests one poll of the air service makes.

    Each country row unfolds the short fixed parameter list, so no join is planned.
    """
    wanted = F.array(
        *(F.struct(F.lit(i).alias("parameter_id"), F.lit(p).alias("parameter")) for i, p in PARAMETERS.items())
    )
    return countries(spark).select("country_id", "country", F.inline(wanted))


def name_ids(df: DataFrame) -> DataFrame:
    """Add ``country`` and ``parameter`` by id. Both dimensions are fixed: 7 and 3 rows, safe to broadcast."""
    spark = df.sparkSession
    return df.join(F.broadcast(countries(spark)), "country_id", "left").join(
        F.broadcast(parameters(spark)), "parameter_id", "left"
    )
