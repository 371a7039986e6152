"""Sampling documents so that their tokens meet target weights of several margins at once.

Tokens are counted for each cell, a combination of the margins' values (source, language,
topic). Iterative proportional fitting rakes the cells' weights: each sweep scales them to the
targets of one margin after the other until all hold. What a cell should weigh over what it
weighs gives its documents' chance to be kept, the largest being ``most``; a document is kept by
a hash of its id, so a run repeated after a lost executor draws the same documents.

DataFrame functions only. Cells are few against documents, but their number follows the data:
they stay a table, whose margins are summed by grouping. Each sweep is stored, which cuts the
plan; it ends when the largest error is below ``tolerance``. Documents read their chance by a
join with the cells, whose hot cells adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

SWEEPS, TOLERANCE = 50, 1e-6
Target = float | dict[str, float]
#: Production targets: each share raised to a power below one, so that small sources, languages and topics
#: gain on large ones. A dictionary of shares by value says them outright.
TARGETS: dict[str, Target] = {"source": 0.9, "lang": 0.95, "topic": 0.98}
NO_VALUE = "(none)"


def topic(text: str = "text") -> Column:
    """A coarse topic by marks in the text: licence terms, contact data, or general."""
    low = F.coalesce(F.col(text), F.lit(""))
    return (
        F.when(low.rlike(r"[Ll](?i:icen[cs]e)|[Cc](?i:opyright)|[Rr](?i:ights reserved)|[Ww](?i:arranty)"), "legal")
        .when(low.rlike(r"@[A-Za-z0-9-]+\.[A-Za-z]|\+\d[\d ()-]{7}|\(\d{3}\) ?\d{3}"), "contact")
        .otherwise("general")
    )


def tokens(text: str = "text") -> Column:
    """A document's weight: its tokens, taken as four bytes each, one at least."""
    size = F.coalesce(F.expr(f"octet_length(CAST(`{text}` AS STRING)) DIV 4"), F.lit(0))
    return F.greatest(F.lit(1), size).cast("bigint")


def targets_of(cells: DataFrame, margin: str, target: Target) -> DataFrame:
    """One row (margin value, target): the share of all tokens that each value shall have.

    A number is the power that the values' own shares are raised to. A dictionary gives shares
    as they are; the rest of the whole is divided among other values as their tokens are.
    Values that no document has are left out, and all shares scaled to add up to one.
    """
    sums = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("n"))
    if not isinstance(target, dict):
        sums = sums.select(margin, F.pow("n", F.lit(float(target))).alias("given"), F.lit(0.0).alias("n"))
    else:
        given = F.lit(None).cast("double")
        for value, share in target.items():
            given = F.when(F.col(margin) == value, F.lit(float(share))).otherwise(given)
        sums = sums.select(margin, given.alias("given"), F.when(given.isNull(), F.col("n")).otherwise(0.0).alias("n"))
    whole = sums.agg(F.sum("given").alias("given"), F.sum("n").alias("n")).first()
    stated, rest = whole["given"] or 0.0, whole["n"] or 0.0
    left = max(0.0, 1.0 - stated) if rest else 0.0
    free = F.col("n") * F.lit(left / rest if rest else 0.0)
    return sums.select(margin, (F.coalesce("given", free) / F.lit(stated + left or 1.0)).alias("target"))


def rake(
    cells: DataFrame, targets: dict[str, Target], sweeps: int = SWEEPS, tolerance: float = TOLERANCE
) -> DataFrame:
    """``cells`` (margins, tokens) with ``weight``, shares that meet every margin's targets.

    Margins that contradict each other (no weights can meet them) leave the last sweep's
    weights, which meet the last margin.
    """
    margins = {m: stored(targets_of(cells, m, target), f"mix-{m}") for m, target in targets.items()}
    weighted = cells.withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(sweeps):
        before = weighted
        for margin, target in margins.items():
            sums = weighted.groupBy(margin).agg(F.sum("weight").alias("sum"))
            factors = sums.join(target, margin).select(margin, (F.col("target") / F.col("sum")).alias("factor"))
            scaled = weighted.join(factors, margin).withColumn("weight", F.col("weight") * F.col("factor"))
            weighted = scaled.drop("factor")
        weighted = stored(weighted, "mix-sweep")
        keys = [c for c in cells.columns if c != "tokens"]
        last = before.select(*keys, F.col("weight").alias("last"))
        change = weighted.join(last, keys).agg(F.max(F.abs(F.col("weight") - F.col("last")))).first()[0]
        if change is None or change <= tolerance:
            break
    return weighted


def chances(
    docs: DataFrame, targets: dict[str, Target] | None = None, most: float = 1.0, text: str = "text", size: str | None = None
) -> DataFrame:
    """All rows and columns of ``docs`` with ``chance``, by which a document is kept.

    Values that are null are a category of their own. A column ``topic`` in ``docs`` is used
    where there is one, else derived. Missing and empty texts weigh one token. Repeated rows
    each weigh. ``size`` names a column with the tokens where it is known; then no text is
    needed. An empty table gives an empty result.
    """
    targets = TARGETS if targets is None else targets
    keys = list(targets)
    columns = [c for c in docs.columns if c.lower() != "chance"]
    named = {c.lower() for c in columns}
    value = lambda m: F.col(m).cast("string") if m in named or m != "topic" else topic(text)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
        *[F.coalesce(value(m), F.lit(NO_VALUE)).alias(m) for m in keys],
        (F.col(size).cast("bigint") if size else tokens(text)).alias("tokens"),
    )
    cells = stored(rows.groupBy(*keys).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    raked = rake(cells, targets)
    ratio = raked.withColumn("ratio", F.col("weight") / F.col("tokens"))
    largest = ratio.agg(F.max("ratio")).first()[0] or 1.0
    by_cell = ratio.select(*keys, F.least(F.lit(1.0), F.col("ratio") / F.lit(largest) * F.lit(most)).alias("chance"))
    return rows.join(by_cell, keys).select("doc.*", "chance")


def draw(doc_id: str = "doc_id", seed: str = "mix") -> Column:
    """A number from 0 to below 1 for each id: the first 52 bits of an MD5, which SQL engines share."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def sample(docs: DataFrame, targets: dict[str, Target] | None = None, most: float = 1.0) -> DataFrame:
    """The rows of ``docs`` drawn by their chances; columns as they are."""
    columns = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        *[F.col(c) for c in ("doc_id", "text", "source", "lang")],
    )
    return chances(rows, targets, most).filter(draw() < F.col("chance")).select("row.*")
