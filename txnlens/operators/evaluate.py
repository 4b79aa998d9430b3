"""Evaluation of a binary score. Input: rows with ``y`` (0/1), ``score`` and grouping columns (``dataset``).

Order statistics come from one aggregation per distinct score and a cumulative sum along it, so nothing sorts
a whole data set in one task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlens.functions.scalars import grid_cell
from txnlens.operators import running as R

BY = ("dataset",)
MAX_GROUPS = 100_000  # tables with a row per data set are broadcast up to this many rows, which is checked
# Fixed value: probabilities are clipped at the machine epsilon of a double before taking logs.
EPSILON = 2.220446049250313e-16
HIGHER_IS_BETTER = {"average_precision": True, "aucpr": True, "auc": True, "log_loss": False, "brier_loss": False}


def score_groups(scored: DataFrame, by=BY) -> DataFrame:
    """Positives and negatives per distinct score."""
    return scored.groupBy(*by, "score").agg(
        F.sum(F.col("y").cast("long")).alias("pos"),
        F.sum((1 - F.col("y")).cast("long")).alias("neg"),
    )


def cumulative(scored: DataFrame, by=BY, hot_rows: int = R.HOT_ROWS) -> DataFrame:
    """Per distinct score, from the highest down: tp and fp at that threshold, and class totals P and N."""
    # the number of distinct scores is estimated on the rows, so that the grouping runs once
    return cumulative_groups(score_groups(scored, by), by, hot_rows, scored, F.approx_count_distinct("score"))


def cumulative_groups(groups: DataFrame, by=BY, hot_rows: int = R.HOT_ROWS, counted=None, size=None) -> DataFrame:
    """The same from (by..., score, pos, neg), one row per distinct score."""
    sums = {"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))}
    totals = {"P": ("sum", F.col("pos")), "N": ("sum", F.col("neg"))}
    return R.prefix_sums(groups.withColumn("__down", -F.col("score")), by, "__down", sums, totals, hot_rows, counted,
                         size).drop("__down")


def _precision(tp, fp):
    return F.try_divide(tp, tp + fp)


def pr_curve(scored, by=BY, hot_rows: int = R.HOT_ROWS, cum=None) -> DataFrame:
    """Precision and recall at every distinct score, and the closing point (1, 0) without a threshold."""
    c = cumulative(scored, by, hot_rows) if cum is None else cum
    points = c.select(*by, F.col("score").alias("threshold"),
                      _precision(F.col("tp"), F.col("fp")).alias("precision"),
                      F.try_divide("tp", "P").alias("recall"))
    last = c.select(*by).distinct().select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.unionByName(last)


def roc_curve(scored, by=BY, hot_rows: int = R.HOT_ROWS, cum=None) -> DataFrame:
    """False and true positive rate at every distinct score, and the opening point (0, 0)."""
    c = cumulative(scored, by, hot_rows) if cum is None else cum
    points = c.select(*by, F.col("score").alias("threshold"),
                      F.try_divide("fp", "N").alias("fpr"), F.try_divide("tp", "P").alias("tpr"))
    first = c.select(*by).distinct().select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(first)


def det_curve(scored, by=BY, hot_rows: int = R.HOT_ROWS, cum=None) -> DataFrame:
    """False positive and false negative rate per threshold.

    Thresholds run from the last one that keeps the lowest false positive count to the first one that
    catches every positive.
    """
    c = cumulative(scored, by, hot_rows) if cum is None else cum
    few = scored.select(*by).distinct().limit(MAX_GROUPS + 1).count() <= MAX_GROUPS

    def per_group(frame):
        return F.broadcast(frame) if few else frame

    lowest = c.groupBy(*by).agg(F.max_by("fp", "score").alias("__fp0"))
    tagged = c.join(per_group(lowest), [*by])
    ends = tagged.groupBy(*by).agg(
        F.min(F.when(F.col("fp") == F.col("__fp0"), F.col("score"))).alias("__hi"),
        F.max(F.when(F.col("tp") == F.col("P"), F.col("score"))).alias("__lo"),
    )
    kept = c.join(per_group(ends), [*by]).where(F.col("score").between(F.col("__lo"), F.col("__hi")))
    return kept.select(*by, F.col("score").alias("threshold"), F.try_divide("fp", "N").alias("fpr"),
                       F.try_divide(F.col("P") - F.col("tp"), F.col("P")).alias("fnr"))


def cap_curve(scored, by=BY, hot_rows: int = R.HOT_ROWS, cum=None) -> DataFrame:
    """Cumulative accuracy profile: events taken (x) against positives found (y).

    Within a tied score positives come first, so a tie adds two points.
    """
    c = cumulative(scored, by, hot_rows) if cum is None else cum
    before = F.col("fp") - F.col("neg")
    corners = F.array(
        F.struct((before + F.col("tp")).alias("events"), F.col("tp").alias("positives")),
        F.struct((F.col("fp") + F.col("tp")).alias("events"), F.col("tp").alias("positives")))
    points = c.select(*by, F.explode(corners).alias("p")).select(*by, "p.events", "p.positives")
    start = c.select(*by).distinct().select(*by, F.lit(0).cast("long").alias("events"),
                                            F.lit(0).cast("long").alias("positives"))
    return points.unionByName(start).distinct()


def curve_metrics(scored, by=BY, hot_rows: int = R.HOT_ROWS, cum=None) -> DataFrame:
    """Areas under the curves, one row per data set: roc_auc, pr_auc, average_precision, accuracy_ratio, ks."""
    c = cumulative(scored, by, hot_rows) if cum is None else cum
    pos, neg, tp, fp, P, N = (F.col(n).cast("double") for n in ("pos", "neg", "tp", "fp", "P", "N"))
    tp0, fp0 = tp - pos, fp - neg
    precision = _precision(tp, fp)
    before = F.coalesce(F.try_divide(tp0, tp0 + fp0), F.lit(1.0))
    sums = c.groupBy(*by).agg(
        F.max("P").alias("P"), F.max("N").alias("N"),
        F.sum(neg * (tp0 + tp) / 2).alias("roc"),
        F.sum(pos * (precision + before) / 2).alias("pr"),
        F.sum(pos * precision).alias("ap"),
        F.sum(pos * tp0 + pos * pos / 2 + neg * tp).alias("cap"),
        F.max(F.abs(F.try_divide(tp, P) - F.try_divide(fp, N))).alias("ks"),
    )
    total = (P + N)
    random = total * P / 2
    perfect = P * P / 2 + N * P
    return sums.select(
        *by, F.col("P").alias("positives"), F.col("N").alias("negatives"),
        F.try_divide(F.col("roc"), P * N).alias("roc_auc"),
        F.try_divide(F.col("pr"), P).alias("pr_auc"),
        F.try_divide(F.col("ap"), P).alias("average_precision"),
        F.try_divide(F.col("cap") - random, perfect - random).alias("accuracy_ratio"),
        "ks",
    )


def losses(scored: DataFrame, by=BY) -> DataFrame:
    """Log loss and Brier score, one row per data set."""
    p = F.least(F.greatest(F.col("score"), F.lit(EPSILON)), F.lit(1.0 - EPSILON))
    log_loss = -F.avg(F.when(F.col("y") == 1, F.ln(p)).otherwise(F.ln(1 - p)))
    return scored.groupBy(*by).agg(log_loss.alias("log_loss"),
                                   F.avg(F.pow(F.col("score") - F.col("y"), 2)).alias("brier_loss"))


def group_log_loss(groups: DataFrame, by=BY) -> DataFrame:
    """Log loss from (by..., score, ones, all): rows of class 1 and all rows of each distinct score."""
    p = F.least(F.greatest(F.col("score"), F.lit(EPSILON)), F.lit(1.0 - EPSILON))
    total = F.sum(F.col("ones") * F.ln(p) + (F.col("all") - F.col("ones")) * F.ln(1 - p))
    return groups.groupBy(*by).agg((-total / F.sum("all")).alias("log_loss"))


# Metric titles of the table and the columns they come from.
METRIC_TITLES = {
    "ROC AUC": "roc_auc",
    "Precision Recall AUC": "pr_auc",
    "Average Precision": "average_precision",
    "Accuracy Ratio": "accuracy_ratio",
    "Log Loss (Cross Entropy)": "log_loss",
    "Brier Score Loss": "brier_loss",
}


def wide_metrics(scored, by=BY, hot_rows: int = R.HOT_ROWS) -> DataFrame:
    """Every metric, one row per data set."""
    return curve_metrics(scored, by, hot_rows).join(losses(scored, by), [*by])


def metrics_table(scored, by=BY, hot_rows: int = R.HOT_ROWS) -> DataFrame:
    """(data set, Metric, Value) rows."""
    wide = wide_metrics(scored, by, hot_rows).select(
        *by, *[F.col(c).alias(title) for title, c in METRIC_TITLES.items()])
    return wide.unpivot(list(by), list(METRIC_TITLES), "Metric", "Value")


def metric(scored: DataFrame, name: str) -> float:
    """One tuning metric of all given rows: average_precision, aucpr, auc, log_loss or brier_loss."""
    if name not in HIGHER_IS_BETTER:
        raise ValueError(f"metric must be one of {sorted(HIGHER_IS_BETTER)}, not {name!r}")
    rows = scored.withColumn("dataset", F.lit("all"))
    if name in ("log_loss", "brier_loss"):
        return losses(rows).select(name).first()[0]
    column = {"average_precision": "average_precision", "aucpr": "pr_auc", "auc": "roc_auc"}[name]
    return curve_metrics(rows).select(column).first()[0]


def score_histogram(scored: DataFrame, by=BY, width: float = 0.02) -> DataFrame:
    """Share of each class per score bin of equal width over [0, 1]; the last bin is closed."""
    bins = round(1 / width)
    cell = grid_cell(F.col("score"), lambda i: i * F.lit(width), F.floor(F.col("score") / width))
    inside = scored.where(F.col("score").between(0, bins * width))
    counts = (inside.withColumn("bin", F.least(cell, F.lit(bins - 1)).cast("long"))
              .groupBy(*by, "y", "bin").agg(F.count(F.lit(1)).alias("n")))
    per_class = Window.partitionBy(*by, "y")  # at most 50 rows each
    return counts.select(*by, "y", "bin", (F.col("bin") * width).alias("lower"), "n",
                         (F.col("n") / F.sum("n").over(per_class)).alias("share"))


def threshold_table(scored: DataFrame, increment: float = 0.01, aux=(), by=BY) -> DataFrame:
    """Confusion counts and rates for thresholds 0, increment, ... below 1; positive means score >= threshold.

    ``aux`` columns add the sum over true positives and its share of the sum over all positives.
    """
    if not 0 < increment < 1:
        raise ValueError(f"increment must lie between 0 and 1, not {increment}")
    n = math.ceil(1 / increment)
    # The i-th threshold is compared as (i - 1) * increment + increment; for some i that differs from
    # i * increment in the last bit.
    cell = grid_cell(F.col("score"), lambda i: (i - 1) * F.lit(increment) + F.lit(increment),
                     F.floor(F.greatest(F.col("score"), F.lit(0.0)) / increment))
    counts = (
        scored.withColumn("i", F.least(F.greatest(cell, F.lit(0)), F.lit(n - 1)).cast("long"))
        .groupBy(*by, "i").agg(
            F.sum(F.col("y").cast("long")).alias("pos"), F.sum((1 - F.col("y")).cast("long")).alias("neg"),
            *[F.sum(F.when(F.col("y") == 1, F.col(a))).alias(f"__{a}") for a in aux])
    )
    grid = scored.select(*by).distinct().select(*by, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    grid = grid.withColumn("i", F.col("i").cast("long")).join(counts, [*by, "i"], "left")
    down = Window.partitionBy(*by).orderBy(F.desc("i"))  # n rows per data set
    whole = Window.partitionBy(*by)

    def tail(c):
        return F.coalesce(F.sum(c).over(down), F.lit(0))

    def both(c):
        return F.coalesce(F.sum(c).over(whole), F.lit(0))

    t = grid.select(
        *by, (F.col("i") * F.lit(increment)).alias("threshold"),
        tail("pos").alias("tp"), tail("neg").alias("fp"),
        (both("pos") - tail("pos")).alias("fn"), (both("neg") - tail("neg")).alias("tn"),
        *[F.coalesce(F.sum(f"__{a}").over(down), F.lit(0.0)).alias(f"{a}_tp_sum") for a in aux],
        *[F.sum(f"__{a}").over(whole).alias(f"__all_{a}") for a in aux],
    )
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    specificity = F.try_divide(tn, tn + fp)
    return t.select(
        *by, "threshold", "tp", "fp", "fn", "tn", *[f"{a}_tp_sum" for a in aux],
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.when((tp == 0) & (fp > 0), F.lit(float("inf"))).otherwise(F.try_divide(fp, tp)).alias("fp_to_tp"),
        ((tp + tn) / (tp + fp + fn + tn)).alias("accuracy"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("F1"),
        specificity.alias("specificity"), (1 - specificity).alias("fpr"),
        *[F.try_divide(f"{a}_tp_sum", f"__all_{a}").alias(f"{a}_weighted_recall") for a in aux],
    )


def ks_limit(d, n0, n1):
    """Column: the limiting two-sided p-value of the two-sample KS statistic, NaN where a class has no rows."""
    n0, n1 = n0.cast("double"), n1.cast("double")
    lam = d * F.sqrt(F.try_divide(n0 * n1, n0 + n1))
    terms = F.transform(F.sequence(F.lit(1), F.lit(100)), lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(
        -2.0 * k * k * lam * lam))
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    p = F.when(lam < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * total)))
    return F.when((n0 > 0) & (n1 > 0), p).otherwise(float("nan"))


def ks_exact(d: float, n0: int, n1: int) -> float:
    """The exact two-sided p-value of the two-sample KS statistic; its work grows with n0 * n1.

    Classes are drawn without replacement, and the probability that the two empirical distributions ever lie
    ``d`` apart is accumulated draw by draw, one diagonal of the (drawn from 0, drawn from 1) lattice at a time.
    """
    if not n0 or not n1:
        return float("nan")
    # distances are multiples of 1 / lcm, so compare in whole units
    unit = math.lcm(n0, n1)
    bound = round(d * unit)
    inside = np.array([1.0])  # probability of being at i draws from class 0, never yet out of bounds
    low, crossed = 0, 0.0
    for drawn in range(n0 + n1):
        i = np.arange(low, low + len(inside))
        left = n0 + n1 - drawn
        p0 = inside * (n0 - i) / left
        p1 = inside * (n1 - (drawn - i)) / left
        nxt = np.zeros(len(inside) + 1)
        nxt[1:] += p0
        nxt[:-1] += p1
        i = np.arange(low, low + len(nxt))
        j = drawn + 1 - i
        out = np.abs(i * (unit // n0) - j * (unit // n1)) >= bound
        crossed += float(nxt[out].sum())
        nxt[out] = 0.0
        alive = np.flatnonzero(nxt)
        if not len(alive):
            break
        inside, low = nxt[alive[0]: alive[-1] + 1], low + int(alive[0])
    return min(1.0, crossed)


def ks_statistic(scored, by=BY, hot_rows: int = R.HOT_ROWS, method: str = "limit") -> DataFrame:
    """KS statistic between the scores of the two classes, with its p-value.

    ``method``: "limit" (the limiting series) or "exact", whatever the number of rows.
    """
    def exact(d: pd.Series, n0: pd.Series, n1: pd.Series) -> pd.Series:
        return pd.Series([ks_exact(*row) for row in zip(d, n0, n1)], dtype=float)

    if method not in ("limit", "exact"):
        raise ValueError(f"method must be limit or exact, not {method!r}")
    p_value = ks_limit if method == "limit" else F.pandas_udf(exact, "double")  # one row per data set
    m = curve_metrics(scored, by, hot_rows)
    return m.select(*by, "ks", F.col("negatives").alias("n0"), F.col("positives").alias("n1")).withColumn(
        "p_value", p_value(F.col("ks"), F.col("n0"), F.col("n1")))
