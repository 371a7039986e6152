"""What each of five filters removes, in every order they can be applied in.

A document's verdicts are one mask, a bit for each filter it fails, so all 120 orders follow
from the number of documents with each mask: a filter removes those that have its bit and no
bit of a filter before it. Masks are counted once and 120 orders of five steps are read off
these counts, which are 32 for each part and label at most.

Four filters look at a text alone. The fifth, a copy of a text with a smaller id, goes through
a counting Bloom sketch: every text adds one to ``HASHES`` cells, tasks count their own cells,
and the counts are merged by summing. A text with a cell that nothing else counted is unique,
guaranteed. Only the others, possible repeats, are shuffled as whole texts and grouped, copies
folded before the shuffle, to find the smallest id of each text. Cells are as many as there are
documents times ``CELLS_PER_DOCUMENT``, and ``MOST_CELLS`` at most, so that the bitmap of cells
counted twice or more, which every task holds, has ``MOST_CELLS`` / 8 bytes (32 MB) at most;
beyond that more unique texts count as possible repeats, which costs time and changes no result.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, whole_text

FILTERS = "ABCDE"
#: The bounds of the filters.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, MARKS = 100, 80, 10, "#$%&*|"
CELLS_PER_DOCUMENT, MOST_CELLS, HASHES = 16, 1 << 28, 2
#: Cells in a bitmap of Spark's own bitmap functions.
BITMAP = 32_768

_BLANKS = " \t\n\x0b\x0c\r"
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def bit(name: str) -> int:
    return 1 << FILTERS.index(name)


def _flag(fails: Column, name: str) -> Column:
    return F.when(fails, bit(name)).otherwise(0)


def text_mask(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, hashes) of ``docs``: the verdicts of A to D on whole texts, a missing one being empty."""
    trimmed = docs.select(
        F.col("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        whole_text().alias("text"),
        F.btrim(whole_text(), F.lit(_BLANKS)).alias("trimmed"),
    )
    split = trimmed.select("doc_id", "part", "text", F.split("trimmed", r"[ \t-\r]+").alias("words"))
    # a text of blanks alone splits into one empty word
    blank = F.element_at("words", 1) == ""
    n_words = F.when(blank, 0).otherwise(F.size("words"))
    n_distinct = F.when(blank, 0).otherwise(F.size(F.array_distinct("words")))
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    sized = split.select("doc_id", "part", "text", n_words.alias("n"), n_distinct.alias("distinct"), capitals.alias("capitals"))
    mask = (
        _flag(F.col("n") < LEAST_WORDS, "A")
        + _flag(100 * F.col("distinct") < LEAST_DISTINCT * F.col("n"), "B")
        + _flag(100 * F.col("capitals").cast("bigint") > MOST_CAPITALS * F.length("text").cast("bigint"), "C")
        + _flag(F.col("text").rlike(f"[{MARKS}]"), "D")
    )
    return sized.select("doc_id", "part", mask.alias("mask"), *_hashes())


def _hashes() -> list[Column]:
    return [F.xxhash64(F.col("text"), F.lit(i)).alias(f"h{i}") for i in range(HASHES)]


def _cells(cells: int) -> list[Column]:
    return [F.pmod(F.col(f"h{i}"), F.lit(cells)) for i in range(HASHES)]


def cells_for(documents: int) -> int:
    """A power of two, a whole bitmap at least."""
    wanted = max(BITMAP, CELLS_PER_DOCUMENT * documents)
    return min(MOST_CELLS, 1 << (wanted - 1).bit_length())


def crowded_cells(hashes: DataFrame, cells: int) -> DataFrame:
    """The cells counted more than once, as (bucket, bits): a row for each ``BITMAP`` cells at most."""
    each = hashes.select(F.explode(F.array_distinct(F.array(*_cells(cells)))).alias("cell"))
    crowded = each.groupBy("cell").count().filter("count > 1")
    return crowded.groupBy((F.col("cell") / BITMAP).cast("bigint").alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("cell") % BITMAP).alias("bits")
    )


def possible_repeats(rows: DataFrame, crowded: DataFrame, cells: int) -> DataFrame:
    """``rows`` (with hashes) of which every cell is crowded; the bitmap goes to every task, rows stay where they are."""
    for i, cell in enumerate(_cells(cells)):
        rows = rows.withColumn(f"_cell{i}", cell)
        bitmap = F.broadcast(crowded.select(F.col("bucket").alias(f"_bucket{i}"), F.col("bits").alias(f"_bits{i}")))
        place = F.col(f"_cell{i}") % BITMAP
        byte = F.conv(F.hex(F.substring(F.col(f"_bits{i}"), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        met = rows.join(bitmap, (F.col(f"_cell{i}") / BITMAP).cast("bigint") == F.col(f"_bucket{i}"))
        rows = met.filter(F.getbit(byte, (place % 8).cast("int")) == 1)
        rows = rows.drop(f"_cell{i}", f"_bucket{i}", f"_bits{i}")
    return rows


def masks(docs: DataFrame, sketch_cells: int | None = None) -> DataFrame:
    """(doc_id, part, mask) for every row of ``docs``, with the verdict of E, whether its text has a smaller id elsewhere.

    Rows with the same id and text are not copies of each other. A row without id is never a
    copy, as no id is smaller, and makes no other row one.
    """
    flags = stored(text_mask(docs), "audit-flags")
    cells = sketch_cells or cells_for(flags.count())
    few = max(1, cells // (32 * BITMAP))  # tasks and files by the size of the bitmap
    crowded = stored(crowded_cells(flags, cells).coalesce(few), "audit-crowded")
    texts = docs.select("doc_id", whole_text().alias("text")).select("doc_id", "text", *_hashes())
    names = [f"h{i}" for i in range(HASHES)]
    groups = possible_repeats(texts, crowded, cells).groupBy("text").agg(
        F.min("doc_id").alias("doc_id"), *[F.min(h).alias(h) for h in names]
    )
    # grouped by whole texts; hashes only tell rows apart that share an id
    first = groups.drop("text").filter("doc_id IS NOT NULL")
    repeats = possible_repeats(flags, crowded, cells).select("doc_id", *names).distinct()
    copies = repeats.filter("doc_id IS NOT NULL").join(first, ["doc_id", *names], "left_anti").withColumn("copy", F.lit(True))
    joined = flags.join(copies, ["doc_id", *names], "left")
    return joined.select("doc_id", "part", (F.col("mask") + _flag(F.col("copy"), "E")).alias("mask"))


def _steps() -> Column:
    """The 600 steps of all orders as one constant."""
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for at, name in enumerate(order, 1):
            steps.append({"filter_order": "".join(order), "step": at, "own": bit(name), "before": before})
            before |= bit(name)
    kind = "array<struct<filter_order: string, step: int, own: int, before: int>>"
    return F.inline(F.from_json(F.lit(json.dumps(steps)), kind))


def audited(docs: DataFrame, labels: DataFrame, sketch_cells: int | None = None) -> DataFrame:
    """A row for each part (language), order of the filters and step, with document counts; zeros included.

    ``docs`` has doc_id, text and lang, other columns do not matter. Missing and empty texts
    have no words and are copies of each other; a missing language is the part ''. Every row
    counts, repeated ones too. A document is good or toxic if any of its label rows says so;
    labels without id or value say nothing. An empty table has no parts and gives no rows.
    """
    said = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    known = masks(docs, sketch_cells).join(said, "doc_id", "left").na.fill(0, ["good", "toxic"])
    counts = known.groupBy("part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    own, before = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda held, of="n": F.sum(F.when(held, F.expr(of)).otherwise(0)).cast("bigint")
    return (
        counts.select("*", _steps())
        .groupBy("part", "filter_order", "step")
        .agg(
            total(~own & ~before).alias("kept"),
            total(own & ~before).alias("removed"),
            total(own & before).alias("redundant"),
            total(F.col("mask") == F.col("own")).alias("unique_fails"),
            total(own & ~before, "n * good").alias("good_lost"),
            total(own & ~before, "n * toxic").alias("toxic_lost"),
            # of all orders, as many have this filter before the others a document fails
            total(own, "n * (120 DIV bit_count(mask))").alias("shapley"),
        )
        .select("part", "filter_order", "step", *_COUNTS)
    )
