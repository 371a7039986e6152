"""Exact quality measures of a scored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settled
from .ranking import running_totals


def _by_score(rows: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score: a third of all rows at one score become one row.

    Rows without a score, or whose score is not a number, are one row with a NULL score.
    """
    value = F.col(score).cast("double")
    return rows.groupBy(F.when(~F.isnan(value), value).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def _ranked(rows: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score: its positives and negatives, and those of all higher scores.

    Distinct scores are dealt out by range, as many ranges as the session has shuffle
    partitions, and written with their range; what follows works on these. The row of NULL
    scores stays beside, above nothing.
    """
    ranged = _by_score(rows, label, score).repartitionByRange(F.desc_nulls_last("score"))
    scores = settled(ranged.withColumn("block", F.spark_partition_id()), "scores")
    above = {"pos": "pos_above", "neg": "neg_above"}
    ranked = running_totals(scores.filter("score IS NOT NULL"), "block", [F.desc("score")], above)
    zero = [F.lit(0).cast("bigint").alias(name) for name in above.values()]
    return ranked.unionByName(scores.filter("score IS NULL").select("*", *zero))


def ranking(rows: DataFrame, label: str, score: str) -> DataFrame:
    """Both ranking measures in one row, NULL where they are not defined.

    ``roc_auc``: share of positive-negative pairs in the right order, ties counting half.
    ``average_precision``: precision at each distinct score weighted by the recall gained there.
    ``unscored``: rows that take no part because their score is NULL or not a number.
    """
    has_score = F.col("score").isNotNull()
    pos, neg = (F.when(has_score, F.col(c)).otherwise(0).cast("double") for c in ("pos", "neg"))
    hits = F.col("pos_above") + F.col("pos")
    taken = hits + F.col("neg_above") + F.col("neg")
    return _ranked(rows, label, score).agg(
        F.sum(pos).cast("bigint").alias("positives"),
        F.sum(neg).cast("bigint").alias("negatives"),
        F.sum(F.when(has_score, 0).otherwise(F.col("pos") + F.col("neg"))).cast("bigint").alias("unscored"),
        F.try_divide(F.sum(neg * (F.col("pos_above") + pos / 2)), F.sum(pos) * F.sum(neg)).alias("roc_auc"),
        F.try_divide(F.sum(F.try_divide(pos * hits, taken)), F.sum(pos)).alias("average_precision"),
    )


def classification_report(rows: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, plain and weighted means.

    The table is reduced to its confusion counts first (classes squared rows at most);
    all that follows works on those. A ratio without a denominator is 0.
    """
    zero = F.lit(0.0)
    cells = rows.groupBy(F.col(label).cast("int").alias("truth"), F.col(prediction).cast("int").alias("guess")).agg(
        F.count("*").alias("n")
    )
    # a cell counts once for the class that was true and once for the class that was guessed
    sides = F.array(
        F.struct(
            F.col("truth").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("guessed"),
            F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(F.lit(0)).cast("bigint").alias("hits"),
        ),
        F.struct(
            F.col("guess").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("guessed"),
            F.lit(0).cast("bigint").alias("hits"),
        ),
    )
    per_class = (
        cells.select(F.inline(sides))
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hits").alias("hits"))
        .withColumn("precision", F.coalesce(F.try_divide("hits", "guessed"), zero))
        .withColumn("recall", F.coalesce(F.try_divide("hits", "support"), zero))
        .withColumn(
            "f1",
            F.coalesce(
                F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero
            ),
        )
    )
    measures = ("precision", "recall", "f1")
    classes = per_class.select(F.col("class").cast("string").alias("row"), *measures, "support")
    total = F.sum("support")
    mean = [F.avg(m).alias(m) for m in measures]
    weighted = [F.try_divide(F.sum(F.col(m) * F.col("support")), total).alias(m) for m in measures]
    overall = F.try_divide(F.sum("hits"), total)
    accuracy = [overall.alias(m) for m in measures]
    summaries = per_class.agg(
        F.struct(F.lit("accuracy").alias("row"), *accuracy, total.alias("support")).alias("a"),
        F.struct(F.lit("macro avg").alias("row"), *mean, total.alias("support")).alias("m"),
        F.struct(F.lit("weighted avg").alias("row"), *weighted, total.alias("support")).alias("w"),
    )
    return classes.unionAll(summaries.select(F.inline(F.array("a", "m", "w"))))
