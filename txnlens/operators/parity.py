"""Batch against online: line the two sides up by transaction and report where they differ."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlens import schemas
from txnlens.functions.arrays import element
from txnlens.functions.scalars import date_range, try_double

SEPARATOR = ", "
# Columns of the online side that the combined table does not repeat.
_NOT_REPEATED = ("fraudLabel", "uniqueId", "customerId", "sessionId", "timestamp", "action", "amount", "modelId")


def batch_scores(scores: DataFrame, features: DataFrame) -> DataFrame:
    """Batch scores with the features they were computed from."""
    return scores.select("uniqueId", "score").join(features, "uniqueId").select("score", *features.columns)


def latest_scores(online: DataFrame, start=None, end=None) -> DataFrame:
    """The newest score of each transaction in the time range.

    Each map task passes on one row per transaction at most, so many re-scores of one transaction do not
    meet in one task.
    """
    rows = online.where(date_range("timestamp", start, end)) if (start or end) else online
    w = Window.partitionBy("uniqueId").orderBy(F.desc("scoreTimestamp"), F.desc("score"))
    return rows.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def parse_features(latest: DataFrame, features=tuple(schemas.FEATURES)) -> DataFrame:
    """Value string to one ``<feature>_df`` double per feature; the score becomes ``score_df``.

    Values belong to the names that the event itself lists, in whatever order; a feature that it does not list is NULL. Events
    that list ``features`` as they are, or no names, are read by position.
    """
    keep = [c for c in latest.columns if c not in ("score", "featureNamesStr", "featureValuesStr")]
    split = latest.withColumn("__values", F.split("featureValuesStr", SEPARATOR))
    if "featureNamesStr" not in latest.columns:
        values = [element(F.col("__values"), i + 1) for i in range(len(features))]
    else:
        in_order = F.coalesce(F.col("featureNamesStr") == F.lit(SEPARATOR.join(features)), F.lit(True))
        split = split.withColumn("__names", F.when(~in_order, F.split("featureNamesStr", SEPARATOR)))
        # get() of position 0 - 1 is NULL: a name that is not listed
        values = [F.when(F.col("__names").isNull(), element(F.col("__values"), i + 1)).otherwise(
            F.get(F.col("__values"), (F.array_position("__names", f) - 1).cast("int"))) for i, f in enumerate(features)]
    return split.select(*keep, F.col("score").alias("score_df"),
                        *[try_double(v).alias(f"{f}_df") for f, v in zip(features, values)])


def full_join(batch: DataFrame, online: DataFrame) -> DataFrame:
    """Every transaction of either side; the other side's columns are NULL where it is absent."""
    keep = [c for c in online.columns if c not in _NOT_REPEATED]
    b = batch.withColumn("__key", F.col("uniqueId"))
    o = online.select(F.col("uniqueId").alias("__key"), *keep)
    return b.join(o, "__key", "full_outer").select(*batch.columns, *keep)


def join_rates(joined: DataFrame) -> DataFrame:
    """Share of each side's scores that the other side has too."""
    def rate(own, other):
        return 1 - F.try_divide(F.count_if(F.col(other).isNull()), F.count(own))

    return joined.agg(rate("score", "score_df").alias("batch_join_rate"),
                      rate("score_df", "score").alias("online_join_rate"))


def feature_mismatch(joined: DataFrame, features=tuple(schemas.FEATURES), tolerance: float = 0.01) -> DataFrame:
    """(feature, mismatch_rate), largest first. All features in one aggregate; a missing value never differs."""
    sums = joined.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(F.abs(F.col(f) - F.col(f"{f}_df")) > tolerance).alias(f) for f in features])
    long = sums.unpivot(["__n"], list(features), "feature", "differ")
    return long.select("feature", F.try_divide("differ", "__n").alias("mismatch_rate")).orderBy(
        F.desc("mismatch_rate"), "feature")


def feature_names(online: DataFrame) -> list:
    """Feature names as the online side lists them, read from one event."""
    row = online.select("featureNamesStr").limit(1).first()
    return row[0].split(SEPARATOR) if row else []


def score_diff_quantiles(joined: DataFrame, parts: int = 100, accuracy: int = 1_000_000) -> DataFrame:
    """``parts`` + 1 quantiles of the absolute score difference, by one mergeable sketch."""
    shares = [i / parts for i in range(parts + 1)]
    q = joined.agg(F.percentile_approx(F.abs(F.col("score") - F.col("score_df")), shares, accuracy).alias("q"))
    return q.select(F.posexplode("q").alias("position", "quantile"))
