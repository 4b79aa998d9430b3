"""Calibration of a score to a probability."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.operators import evaluate as EV
from txnlens.operators import monitor as MO

TYPES = ("isotonic", "logistic")
BIN_TYPES = ("uniform", "quantile")


def fit(scored: DataFrame, kind: str = "logistic") -> Model:
    """Fit on rows of (score, y).

    Isotonic: equal scores are averaged first (weights keep their number). Logistic: an L2 penalty of
    strength one on the sum of the losses; MLlib averages the losses, so the penalty is divided by the rows.
    """
    if kind not in TYPES:
        raise ValueError(f"kind must be one of {TYPES}, not {kind!r}")
    if kind == "isotonic":
        groups = scored.groupBy("score").agg(F.avg(F.col("y").cast("double")).alias("__y"),
                                             F.count(F.lit(1)).cast("double").alias("__n"))
        return IsotonicRegression(featuresCol="score", labelCol="__y", weightCol="__n",
                                  predictionCol="__cal").fit(groups)
    rows = _vector(scored).select("__v", F.col("y").cast("double").alias("__y"))
    est = LogisticRegression(featuresCol="__v", labelCol="__y", probabilityCol="__p", predictionCol="__cal",
                             rawPredictionCol="__raw", regParam=1.0 / rows.count(), standardization=False, tol=1e-9,
                             maxIter=200)
    return est.fit(rows)


def _vector(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=["score"], outputCol="__v").transform(df)


def apply(calibrator: Model, scored: DataFrame, name: str = "score_cal") -> DataFrame:
    """Add the calibrated score. Scores outside the fitted range take the value at its end."""
    if calibrator.hasParam("isotonic"):
        return calibrator.transform(scored).withColumn(
            name, F.least(F.greatest("__cal", F.lit(0.0)), F.lit(1.0))).drop("__cal")
    out = calibrator.transform(_vector(scored))
    return out.withColumn(name, F.get(vector_to_array("__p"), F.lit(1))).drop("__v", "__p", "__raw", "__cal")


def calibrated(calibrator: Model, scored: DataFrame, legacy: bool = False) -> DataFrame:
    """The scored rows with the calibrated score in place of the raw one, ready for evaluation.

    ``legacy`` calibrates twice, as published evaluations of calibrated scores did.
    """
    out = apply(calibrator, scored).drop("score").withColumnRenamed("score_cal", "score")
    return calibrated(calibrator, out) if legacy else out


def mapping_table(calibrator: Model, spark: SparkSession, increment: float = 0.0001) -> DataFrame:
    """(score, calibrated_score) for scores 0, increment, ... below 1."""
    n = round(1 / increment)
    scores = spark.range(n).select((F.col("id") * F.lit(increment)).alias("score"))
    return apply(calibrator, scores, "calibrated_score")


def reliability_curve(scored: DataFrame, bin_type: str = "uniform", n_bins: int = 5, by=("dataset",)) -> DataFrame:
    """(by..., bin, n, prob_score, prob_true) of the bins that hold any row.

    A score equal to an inner edge belongs to the lower bin.
    """
    if bin_type not in BIN_TYPES:
        raise ValueError(f"bin_type must be one of {BIN_TYPES}, not {bin_type!r}")
    if n_bins < 2:
        raise ValueError("n_bins must be greater than 1")
    if bin_type == "uniform":
        above = F.lit(0)
        for i in range(1, n_bins):
            above = above + (F.col("score") > F.lit(i * (1.0 / n_bins))).cast("int")
        binned = scored.withColumn("bin", above)
    else:
        found = MO.quantile_edges(scored.withColumnRenamed("score", "value"), list(by), n_bins)
        inner = {tuple(str(v) for v in k): e[1:-1] for k, e in found.items()}
        # one row per data set
        edges = MO.edge_table(scored.sparkSession, list(by), inner.items(), n_bins)
        above = F.lit(0)
        for i in range(n_bins + 1):
            above = above + (F.col("score") > F.col(f"e{i}")).cast("int")
        binned = scored.join(F.broadcast(edges), list(by)).withColumn("bin", above)
    return binned.groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg("score").alias("prob_score"),
        F.avg(F.col("y").cast("double")).alias("prob_true"))


def compare_curves(calibrator: Model, scored: DataFrame) -> DataFrame:
    """Precision/recall and ROC points of the raw and of the calibrated score, marked by ``which``."""
    parts = []
    for which, rows in (("raw", scored), ("calibrated", calibrated(calibrator, scored))):
        pr = EV.pr_curve(rows).select("dataset", "threshold", F.lit("pr").alias("curve"),
                                      F.col("recall").alias("x"), F.col("precision").alias("y"))
        roc = EV.roc_curve(rows).select("dataset", "threshold", F.lit("roc").alias("curve"),
                                        F.col("fpr").alias("x"), F.col("tpr").alias("y"))
        parts.append(pr.unionByName(roc).withColumn("which", F.lit(which)))
    return parts[0].unionByName(parts[1])
