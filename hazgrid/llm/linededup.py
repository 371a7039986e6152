"""Repeated passages, by overlapping windows of three lines.

Every three consecutive lines of a document are a window, known by the MD5 of its text. Of
each window found more than once in the whole corpus, the occurrence first in order of
(document, line) stays and every later one is covered; covered lines, merged over all
windows, are removed. A line goes only with an earlier copy of the three lines around it, so
the first copy of any text stays, though not always in one place.

Windows are counted by partial sums, so one that stands in a third of all documents is a row
for each task; the table of repeated windows is then joined back, where adaptive execution
splits a hot window. Nothing holds all occurrences of a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, whole_text

WINDOW = 3


def _lines():
    return F.split("text", "\n", -1)


def windows(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row (hash, doc, nth) for each window of ``rows`` (doc, text) that is not blank throughout.

    ``doc`` is any orderable column, ``nth`` the first line's number from 0. A document of
    fewer lines than ``window`` has none.
    """
    cut = rows.select("doc", _lines().alias("lines")).filter(F.size("lines") >= window)
    texts = f"transform(sequence(0, size(lines) - {window}), i -> array_join(slice(lines, i + 1, {window}), '\n'))"
    each = cut.select("doc", F.posexplode(F.expr(texts)).alias("nth", "passage"))
    return each.filter(r"passage RLIKE '\\S'").select(F.unhex(F.md5("passage")).alias("hash"), "doc", "nth")


def covered(found: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row (doc, gone) for each document with covered lines: their numbers, each once.

    ``found`` is a stored table of windows, as it is read twice.
    """
    place = F.struct("doc", "nth")
    repeated = found.groupBy("hash").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
    later = found.join(repeated.select("hash", "first"), "hash").filter(place > F.col("first"))
    # one document's lines, each once though rows repeat: bounded by the document
    starts = later.select("doc", "nth").groupBy("doc").agg(F.collect_set("nth").alias("starts"))
    merged = f"array_distinct(flatten(transform(starts, s -> sequence(s, s + {window - 1}))))"
    return starts.select("doc", F.expr(merged).alias("gone"))


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """All rows and columns of ``docs`` with repeated passages cut from ``text``, and ``n_removed``, the lines cut.

    The order of documents is doc_id, a missing one last, then the MD5 of the text; rows alike in
    both are one document, which no copy of it cuts, and are cut alike. A text of which nothing is cut stays as it is, a missing one missing; one
    that is cut whole is empty. Blank passages are never cut. An empty table gives an empty
    result; columns named like those made here are replaced.
    """
    columns = [c for c in docs.columns if c.lower() != "n_removed"]
    order = F.struct(
        F.col("doc_id").isNull().alias("missing"),
        F.col("doc_id").alias("id"),
        F.coalesce(F.md5(F.col("text").cast("string")), F.lit("")).alias("text"),
    )
    every = F.struct(*[F.col(f"`{c}`") for c in columns])
    packed = docs.select(order.alias("doc"), whole_text().alias("text"), every.alias("all"))
    found = stored(windows(packed, window), "line-windows")
    rows = packed.join(covered(found, window), "doc", "left")
    lines, left = _lines(), "array_except(sequence(0, size(lines) - 1), gone)"
    kept = F.when(F.col("gone").isNull(), F.col("all.text")).otherwise(
        F.expr(f"array_join(transform({left}, i -> lines[i]), '\n')")
    )
    removed = F.coalesce(F.size("gone"), F.lit(0))
    out = rows.withColumn("lines", lines)
    rest = [kept.alias(c) if c.lower() == "text" else F.col(f"all.`{c}`") for c in columns]
    return out.select(*rest, F.when(F.col("gone").isNull(), 0).otherwise(removed).alias("n_removed"))
