"""Readers for the files the three feeds drop into landing folders.

Each returns raw records, one row per observation, all scalars as text. A file
or record that cannot be read at all becomes a row with ``_corrupt_record`` set,
so that the normalisers can route it to the rejects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import AIR_FILE, FIRE_COLUMNS, QUAKE_FILE

CORRUPT = "_corrupt_record"
#: How a record begins in the documents that the services send.
QUAKE_START, AIR_START = '{"type":"Feature",', '{"datetime":{"utc":'


def _unfold(files: DataFrame, items: str, keep: tuple[str, ...] = ()) -> DataFrame:
    rows = files.select(*keep, CORRUPT, F.explode_outer(items).alias("item"))
    # an empty but readable file has neither an item nor a corrupt text
    rows = rows.filter(F.col("item").isNotNull() | F.col(CORRUPT).isNotNull())
    return rows.select(*keep, "item.*", CORRUPT)


def _cut(
    spark: SparkSession, path: str, file: StructType, items: str, start: str, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Documents of any size, one to a file, cut where the text ``start`` begins a record: many tasks read one file.

    ``start`` is matched letter by letter and must not be followed by a brace. Every piece is completed
    to a document of its own, with the records in it: one as a rule, more where some begin otherwise, the whole
    document where all do. A record that is cut off is corrupt, the others of its file are read; a file that
    ends with a comma or an open list has one more, corrupt row, which names it.
    """
    pieces = spark.read.option("lineSep", start).text(path)
    pieces = pieces.select("value", *keep, F.col("_metadata.file_path").alias("file")).filter("trim(value) <> ''")
    goes_on = F.col("value").rlike(r"[,\[]\s*$")
    head = F.when(F.ltrim("value").startswith("{"), "").otherwise('{"%s":[%s' % (items, start))
    whole = F.when(goes_on, F.concat(F.regexp_replace("value", r",?\s*$", ""), F.lit("]}"))).otherwise(F.col("value"))
    documents = pieces.select(*keep, F.from_json(F.concat(head, whole), file).alias("document"))
    rows = _unfold(documents.select(*keep, "document.*"), items, keep)
    # a piece that ends its document does not go on
    ends = pieces.groupBy("file", *keep).agg(F.max(~goes_on).alias("ended")).filter("NOT ended")
    return rows.unionByName(ends.select(*keep, F.col("file").alias(CORRUPT)), allowMissingColumns=True)


def quake_files(
    spark: SparkSession, path: str, one_per_line: bool = False, record_start: str | None = None
) -> DataFrame:
    """Feature collections -> one row per feature.

    A file is one document, as the service sends it; with ``one_per_line`` every line is
    one, which lets Spark cut large files into tasks. So does ``record_start`` (``QUAKE_START`` for
    the service's own documents) with documents of any size, see ``_cut``.
    """
    if record_start:
        return _cut(spark, path, QUAKE_FILE, "features", record_start)
    files = spark.read.schema(QUAKE_FILE).option("multiLine", not one_per_line).json(path)
    return _unfold(files, "features")


def fire_files(spark: SparkSession, path: str) -> DataFrame:
    """Delimited text, each file with a header of its own -> rows by column name.

    Files may name their columns in any order and leave some out; as many cells of a line are
    looked at as the widest header has. A file is cut into tasks
    like any text; its header is found by its names and joined to its lines. Lines of a file
    without header, which no name says how to read, are corrupt.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).filter("trim(value) <> ''")
    parts = F.transform(F.split("value", ","), lambda name: F.trim(F.translate(name, '"', "")))
    is_header = F.array_contains(parts, "acq_date") & F.array_contains(parts, "latitude")
    widest = lines.filter(is_header).agg(F.max(F.size(parts))).first()[0] or 1
    cells = F.from_csv("value", ", ".join(f"c{i} string" for i in range(widest)))
    headers = lines.filter(is_header).groupBy("file").agg(F.min("value").alias("value"))
    headers = headers.select("file", parts.alias("names"))
    named = lines.filter(~is_header).join(headers, "file", "left")
    read = named.select("names", "value", cells.alias("cells")).select("names", "value", F.array("cells.*").alias("cells"))
    columns = [F.get("cells", (F.array_position("names", c) - 1).cast("int")).alias(c) for c in FIRE_COLUMNS]
    return read.select(*columns, F.when(F.col("names").isNull(), F.col("value")).alias(CORRUPT))


def air_files(
    spark: SparkSession, path: str, one_per_line: bool = False, record_start: str | None = None
) -> DataFrame:
    """Result pages below ``country_id=…/parameter_id=…`` -> rows tagged with both ids; read like ``quake_files``."""
    if record_start:
        return _cut(spark, path, AIR_FILE, "results", record_start, keep=("country_id", "parameter_id"))
    files = spark.read.schema(AIR_FILE).option("multiLine", not one_per_line).json(path)
    return _unfold(files, "results", keep=("country_id", "parameter_id"))
