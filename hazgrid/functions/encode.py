"""Text forms of typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .clock import seconds_text

# Fixed values of the tab-separated format.
NULL_TEXT = r"\N"
TAB = "\t"


def evaluated_once(*columns: Column) -> Column:
    """Columns to select as one generator, so that each is computed once per row.

    A later filter on one of them (is the record acceptable?) stays above a generator;
    through a plain projection it would be pushed down with a copy of every parse and cast.
    """
    return F.inline(F.array(F.struct(*columns)))


def fixed(column: Column, digits: int) -> Column:
    """Plain decimal text, rounded from the exact binary value with ties to even.

    ``format_string`` would round the shortest decimal form half up instead: 0.95 -> 1.0.
    """
    return F.call_function("format_number", column, F.lit("0." + "0" * digits))


def tsv_field(column: Column, dtype: T.DataType) -> Column:
    """One field: six decimals for floats, whole seconds for times, no tabs or line breaks in text."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = fixed(column, 6)
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = seconds_text(column)
    else:
        # tab and newline become a space; a carriage return has no counterpart and is dropped
        text = F.translate(column.cast("string"), "\t\n\r", "  ")
    return F.coalesce(text, F.lit(NULL_TEXT))


def tsv_line(df: DataFrame) -> Column:
    return F.concat_ws(TAB, *(tsv_field(F.col(f.name), f.dataType) for f in df.schema))


def json_value(df: DataFrame) -> Column:
    """The whole row as one JSON object; missing values are written as null, not left out."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def envelope(rows: DataFrame, *order: Column) -> DataFrame:
    """``{count, data}`` of an already limited result, as one row with a JSON array in order.

    ``rows`` must be a top-k result: it is gathered into one value.
    """
    times = {f.name for f in rows.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    shown = [
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c) if c in times else F.col(c) for c in rows.columns
    ]
    pairs = rows.select(F.struct(*order).alias("place"), F.struct(*shown).alias("row"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("place", "row"))), lambda p: p["row"])
    return pairs.agg(
        F.count("*").alias("count"), F.to_json(listed, {"ignoreNullFields": "false"}).alias("data")
    )
