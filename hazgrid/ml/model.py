"""Training, scoring and storing the zone risk model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import risk_label
from ..functions.clock import utc_now
from ..operators import metrics
from ..operators.features import class_weight, label_distribution
from ..operators.split import stratified_split
from ..schemas import FEATURES, LABEL, ZONE
from ..session import settled

MIN_ZONES = 10


@dataclass(frozen=True)
class BoostParams:
    """Fixed values of the model: trees, depth, rate, row and column sample, seed."""

    trees: int = 200
    depth: int = 5
    rate: float = 0.05
    row_sample: float = 0.8
    column_sample: float = 0.8
    seed: int = 42


@dataclass
class Trained:
    model: GBTClassificationModel
    zones: DataFrame
    holdout: DataFrame
    positive_rate: float
    n_zones: int


class TooFewZones(ValueError):
    pass


def assembled(rows: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Inputs as one vector, in the fixed order of the model."""
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(rows)


def weighted(rows: DataFrame, scale: float, label: str = LABEL) -> DataFrame:
    """Positives weigh as much as there are negatives per positive."""
    return rows.withColumn("weight", F.when(F.col(label) == 1, F.lit(float(scale))).otherwise(F.lit(1.0)))


def train(training_rows: DataFrame, params: BoostParams = BoostParams()) -> Trained:
    """Fit on four fifths of the zones, stratified; keep the rest for evaluation.

    The feature table is written to the shared folder once: boosting reads its input
    again for every tree, and a lost executor must not recompute the aggregates.
    """
    zones = settled(training_rows, "zones")
    counts = {r["label"]: r["zones"] for r in label_distribution(zones).collect()}
    n_zones = sum(counts.values())
    if n_zones < MIN_ZONES:
        raise TooFewZones(f"{n_zones} zones, at least {MIN_ZONES} are needed")

    marked = settled(stratified_split(zones), "split")
    fit_rows = marked.filter("is_train")
    scale = class_weight(fit_rows).first()["scale_pos_weight"]
    booster = GBTClassifier(
        labelCol=LABEL,
        featuresCol="features",
        weightCol="weight",
        maxIter=params.trees,
        maxDepth=params.depth,
        stepSize=params.rate,
        subsamplingRate=params.row_sample,
        featureSubsetStrategy=str(params.column_sample),
        seed=params.seed,
    )
    model = booster.fit(assembled(weighted(fit_rows, scale)).select("features", LABEL, "weight"))
    return Trained(
        model=model,
        zones=zones,
        holdout=marked.filter(~F.col("is_train")).drop("is_train"),
        positive_rate=counts.get(1, 0) / n_zones,
        n_zones=n_zones,
    )


def scored(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    """Rows with ``score`` (probability of an event), ``margin`` (sum of the trees) and ``prediction``."""
    out = model.transform(assembled(rows))
    return out.withColumns(
        {
            "score": vector_to_array("probability")[1],
            "margin": vector_to_array("rawPrediction")[1],
            "prediction": F.col("prediction").cast("int"),
        }
    ).drop("features", "rawPrediction", "probability")


def predictions(model: GBTClassificationModel, rows: DataFrame, at: datetime | None = None) -> DataFrame:
    """A score and a label for every zone, stamped with the time of the run."""
    stamp = (at or utc_now()).isoformat()
    return scored(model, rows).select(
        *ZONE,
        F.col("score").alias("ml_risk_score"),
        risk_label(F.col("score")).alias("ml_risk_label"),
        F.lit(stamp).alias("predicted_at"),
    )


def top_zones(scored_zones: DataFrame, n: int = 5, score: str = "ml_risk_score") -> DataFrame:
    return scored_zones.orderBy(F.desc(score), *ZONE).limit(n)


def importances(spark: SparkSession, model: GBTClassificationModel, features: Sequence[str] = FEATURES) -> DataFrame:
    """One row per model input, 14 in all, strongest first."""
    values = [float(v) for v in model.featureImportances.toArray()]
    table = spark.createDataFrame(list(zip(features, values)), "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def evaluation(model: GBTClassificationModel, holdout: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Report per class, and the two ranking measures in one row (NULL without positives)."""
    rows = scored(model, holdout).select(F.col(LABEL).alias("label"), "score", "prediction")
    report = metrics.classification_report(rows, "label", "prediction")
    ranking = metrics.ranking(rows, "label", "score").select("roc_auc", "average_precision")
    return report, ranking


def metadata(spark: SparkSession, trained: Trained, at: datetime | None = None) -> DataFrame:
    """One row describing the model."""
    strengths = {f: float(v) for f, v in zip(FEATURES, trained.model.featureImportances.toArray())}
    row = {
        "trained_at": (at or utc_now()).isoformat(),
        "n_zones": trained.n_zones,
        "n_features": len(FEATURES),
        "features": list(FEATURES),
        "feature_importance": dict(sorted(strengths.items(), key=lambda e: -e[1])),
        "positive_rate": float(trained.positive_rate),
    }
    schema = (
        "trained_at string, n_zones bigint, n_features int, features array<string>, "
        "feature_importance map<string,double>, positive_rate double"
    )
    return spark.createDataFrame([row], schema)


def save(trained: Trained, path: str, at: datetime | None = None) -> None:
    """The model and its metadata record side by side."""
    root = path.rstrip("/")
    trained.model.write().overwrite().save(f"{root}/model")
    metadata(trained.zones.sparkSession, trained, at).coalesce(1).write.mode("overwrite").json(f"{root}/meta")


def load(path: str) -> GBTClassificationModel:
    return GBTClassificationModel.load(f"{path.rstrip('/')}/model")
