"""Tab-separated and JSON exports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.encode import tsv_line


def write_tsv(rows: DataFrame, path: str, mode: str = "error") -> None:
    rows.select(tsv_line(rows).alias("value")).write.mode(mode).text(path)


def write_json(rows: DataFrame, path: str, mode: str = "error") -> None:
    """One object per line, nested columns kept."""
    rows.write.mode(mode).option("ignoreNullFields", False).json(path)
