"""Explanations of a fitted model: permutation importance, tree importance, partial dependence, Shapley values.

Each is one scoring job over rows that Spark multiplies and re-aggregates. A boosted model reads few of many features: of its rows
only those features are carried, the variants of a row are scored where the row is, and only sums leave the task.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.operators import evaluate as EV
from txnlens.operators import model as ML
from txnlens.operators import running as R
from txnlens.sources.writers import broadcast_if_small, materialize, scratch_root

# Importance metrics and the evaluation columns they are read from (sign: higher is better).
IMPORTANCE_METRICS = {"roc_auc": ("roc_auc", 1), "average_precision": ("average_precision", 1),
                      "neg_log_loss": ("log_loss", -1)}
MERGED = 1_000_000  # counted scores that a task holds before it adds them up


def hash_sample(df: DataFrame, n: int, id_column: str = "uniqueId", seed: int = 0) -> DataFrame:
    """``n`` rows in the order of a seeded hash of their id: random, yet the same every time."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_column)))).limit(n)


def _positions(rows: DataFrame, id_column: str, seed: int, name: str, hot_rows: int) -> DataFrame:
    """Number the rows of each data set 1, 2, ... in the order of a seeded hash."""
    hashed = rows.withColumn("__h", F.xxhash64(F.col(id_column), F.lit(seed)))
    s = R.split(hashed, ["dataset"], F.col("__h"), hot_rows)
    return R.running(s, ["__h", id_column], {name: ("sum", F.lit(1).cast("long"))}).done().drop("__h")


def _with_partner(rows: DataFrame, id_column: str, seeds, hot_rows: int) -> DataFrame:
    """Each row once per seed (``rep``), next to the feature array of another row of its data set (``other``).

    Per seed the pairing is a permutation of the data set: a row's position under one hash order meets the
    position of its partner under another.
    """
    numbered = _positions(rows, id_column, -1, "__p", hot_rows)
    for k, seed in enumerate(seeds):
        numbered = _positions(numbered, id_column, seed, f"__q{k}", hot_rows)
    numbered = materialize(numbered, "positions")
    reps = F.array(*[F.struct(F.lit(k).alias("rep"), F.col(f"__q{k}").alias("at")) for k in range(len(seeds))])
    partners = (numbered.select("dataset", F.col("__x").alias("other"), F.explode(reps).alias("r"))
                .select("dataset", "r.rep", F.col("r.at").alias("__p"), "other"))
    base = numbered.drop(*[f"__q{k}" for k in range(len(seeds))]).withColumn(
        "rep", F.explode(F.array(*[F.lit(k) for k in range(len(seeds))])))
    return base.join(partners, ["dataset", "rep", "__p"])


def _spread(df: DataFrame) -> DataFrame:
    """Even partitions ahead of a step that multiplies rows: few input rows can mean much scoring."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _score_arrays(model: Transformer, rows: DataFrame, array: str, features, keep, label: str | None = None):
    """Score rows whose features are one array column, in the order of ``features``."""
    stages = model.stages if isinstance(model, PipelineModel) else []
    if len(stages) == 2 and isinstance(stages[0], VectorAssembler) and stages[0].getInputCols() == list(features):
        kept = [*keep, *([label] if label else [])]
        vectors = rows.select(*kept, array_to_vector(array).alias(stages[0].getOutputCol()))
        return ML.score(stages[1], vectors, keep=keep, label=label)
    columns = [F.get(F.col(array), F.lit(i)).alias(f) for i, f in enumerate(features)]
    return ML.score(model, rows.select(*keep, *([label] if label else []), *columns), keep=keep, label=label)


def _feature_array(features):
    return F.array(*[F.col(f).cast("double") for f in features]).alias("__x")


class _Boosted:
    """A boosted model over rows that hold only the features it reads (``at``: their places among all)."""

    def __init__(self, model, trees: ML.Trees):
        reads = trees.reads()
        self.at, self.readers = [f for f, _ in reads], [of for _, of in reads]
        self.trees, self.regression = trees.narrowed(self.at), isinstance(model, GBTRegressionModel)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        return self.trees.leaves(x, range(len(self.trees.roots)))

    def changed(self, leaves: np.ndarray, x: np.ndarray, trees) -> np.ndarray:
        """``leaves`` with those of ``trees`` as ``x`` reaches them."""
        out = leaves.copy()
        out[:, trees] = self.trees.leaves(x, trees)
        return out

    def scores(self, leaves: np.ndarray) -> np.ndarray:
        margin = leaves.sum(axis=1)
        return margin if self.regression else 1 - 1 / (1 + np.exp(2 * margin))


def _boosted(model: Transformer, features, spark) -> _Boosted | None:
    """The trees of a boosted model that is fed ``features`` in their order; None for other models."""
    stages = model.stages if isinstance(model, PipelineModel) else []
    if len(stages) != 2 or not isinstance(stages[0], VectorAssembler) or stages[0].getInputCols() != list(features):
        return None
    if not isinstance(stages[1], GBTClassificationModel | GBTRegressionModel):
        return None
    return _Boosted(stages[1], ML.flat_trees(stages[1], spark))


def _matrix(column: pa.Array) -> np.ndarray:
    """Arrays of equal length, one row each."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _counted(batches, boosted, swaps):
    """(dataset, rep, swap, score, pos, neg, ones, all): of each batch and swap how many rows have a score; added up at ``MERGED`` rows."""
    by = ["dataset", "rep", "swap", "score"]
    waiting, rows = [], 0

    def merged():
        return pd.concat(waiting, ignore_index=True).groupby(by, dropna=False, as_index=False, sort=False).sum()

    for batch in batches:
        if not batch.num_rows:
            continue
        frame = batch.select(["dataset", "rep", "__y"]).to_pandas()
        y = frame.pop("__y")
        frame["pos"], frame["neg"], frame["ones"], frame["all"] = y.fillna(0).astype("int64"), (1 - y).fillna(0).astype("int64"), (y == 1).astype("int64"), 1
        x = _matrix(batch.column("__x")).copy()
        leaves, other = boosted.leaves(x), _matrix(batch.column("other")) if swaps else None
        for swap in swaps or [-1]:
            if swaps:
                own, x[:, swap] = x[:, swap].copy(), other[:, swap]
                score = boosted.scores(boosted.changed(leaves, x, boosted.readers[swap]))
                x[:, swap] = own
            else:
                score = boosted.scores(leaves)
            part = frame.assign(swap=swap, score=score).groupby(by, dropna=False, as_index=False, sort=False).sum()
            waiting.append(part)
            rows += len(part)
        if rows > MERGED:
            waiting = [merged()]
            rows = len(waiting[0])
            if rows > MERGED // 2:
                yield from pa.Table.from_pandas(waiting[0], preserve_index=False).select([*by, "pos", "neg", "ones", "all"]).to_batches()
                waiting, rows = [], 0
    if waiting:
        yield from pa.Table.from_pandas(merged(), preserve_index=False).select([*by, "pos", "neg", "ones", "all"]).to_batches()


def _counted_scores(boosted, rows: DataFrame, swaps) -> DataFrame:
    """(dataset, rep, swap, score, pos, neg, ones, all), one row per distinct score; stored. ``swaps``: places of the features that
    take the value of ``other`` in turn; without any the rows are scored as they are, under the swap -1."""
    shared = rows.sparkSession.sparkContext.broadcast(boosted)  # as large as the model
    kind = rows.schema["dataset"].dataType.simpleString()
    counts = ["pos", "neg", "ones", "all"]
    found = rows.mapInArrow(lambda batches: _counted(batches, shared.value, swaps),
                            f"dataset {kind}, rep long, swap long, score double, pos long, neg long, ones long, all long")
    return materialize(found.groupBy("dataset", "rep", "swap", "score").agg(*[F.sum(c).alias(c) for c in counts]), "permuted-scores")


def permutation_importance(model: Transformer, df: DataFrame, features, label: str, repeats: int = 10,
                           metrics=("neg_log_loss",), id_column: str = "uniqueId", seed: int = 1,
                           hot_rows: int = R.HOT_ROWS) -> DataFrame:
    """(dataset, feature, <metric>_mean, <metric>_std): drop of each metric when a feature is shuffled.

    A repeat shuffles whole rows once; each feature in turn then takes the shuffled row's value. A feature that a boosted model
    does not read changes no score, so its drops are zero without scoring.
    """
    features, metrics = list(features), [metrics] if isinstance(metrics, str) else list(metrics)
    seeds = [seed + k for k in range(repeats)]
    boosted = _boosted(model, features, df.sparkSession)
    read = range(len(features)) if boosted is None else boosted.at
    rows = df.select("dataset", F.col(id_column).alias("__id"), F.col(label).cast("int").alias("__y"),
                     _feature_array([features[i] for i in read]))
    by = ("dataset", "swap", "rep")
    if boosted is None:
        paired = _with_partner(rows, "__id", seeds, hot_rows)
        swap = F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1)))
        variants = _spread(paired).select("dataset", "rep", "__y", "__x", "other", swap.alias("swap"))
        mixed = F.transform("__x", lambda v, i: F.when(i == F.col("swap"), F.get(F.col("other"), i)).otherwise(v))
        variants = variants.select("dataset", "rep", "swap", "__y", mixed.alias("__m"))
        # scoring is the expensive part and feeds several aggregations, so its result is stored
        scored = materialize(_score_arrays(model, variants, "__m", features, by, "__y"), "permuted-scores")
        shuffled = EV.wide_metrics(scored, by, hot_rows)
        base = EV.wide_metrics(_score_arrays(model, rows, "__x", features, ("dataset",), "__y"), hot_rows=hot_rows)
    else:
        base = _group_metrics(_counted_scores(boosted, rows.withColumn("rep", F.lit(0).cast("long")), []), ("dataset",), hot_rows)
        shuffled = base.select("dataset", F.lit(0).cast("long").alias("swap"), F.lit(0).cast("long").alias("rep"), *base.columns[1:]).limit(0)
        if boosted.at:
            paired = _with_partner(rows, "__id", seeds, hot_rows).select("dataset", F.col("rep").cast("long").alias("rep"), "__y", "__x", "other")
            shuffled = _group_metrics(_counted_scores(boosted, paired, list(range(len(boosted.at)))), by, hot_rows)
            place = F.get(F.array(*[F.lit(i).cast("long") for i in boosted.at]), F.col("swap").cast("int"))
            shuffled = shuffled.withColumn("swap", place)
        still = [i for i in range(len(features)) if i not in boosted.at]
        if still:
            same = F.explode(F.array(*[F.lit(i).cast("long") for i in still])).alias("swap")
            shuffled = shuffled.unionByName(base.select("dataset", same, F.lit(0).cast("long").alias("rep"), *base.columns[1:]))
    drops, aggs = [], []
    for m in metrics:
        column, sign = IMPORTANCE_METRICS[m]
        drops.append((sign * (F.col(f"__b_{column}") - F.col(column))).alias(m))
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    base = base.select("dataset", *[F.col(c).alias(f"__b_{c}") for c in
                                    dict.fromkeys(IMPORTANCE_METRICS[m][0] for m in metrics)])
    name = F.get(F.array(*[F.lit(f) for f in features]), F.col("swap").cast("int")).alias("feature")
    out = shuffled.join(base, "dataset").select("dataset", name, *drops)
    return out.groupBy("dataset", "feature").agg(*aggs).orderBy("dataset", F.desc(f"{metrics[0]}_mean"), "feature")


def _group_metrics(groups: DataFrame, by, hot_rows: int) -> DataFrame:
    """The importance metrics from counts per distinct score."""
    curves = EV.curve_metrics(groups, by, hot_rows, EV.cumulative_groups(groups, by, hot_rows))
    return curves.join(EV.group_log_loss(groups, by), [*by]).select(*by, *[c for c, _ in IMPORTANCE_METRICS.values()])


def tree_importance(model: PipelineModel, features, spark, path: str | None = None) -> DataFrame:
    """(feature, gain, total_gain, weight, cover, total_cover), each summing to one; unused features are zero.

    Read from the node table of the saved model.
    """
    if path is None:
        path = f"{scratch_root(spark)}/txnlens/model-{uuid.uuid4().hex}"
        ML.save(model, path)
    uid = model.stages[-1].uid
    data = f"{path}/stages/{len(model.stages) - 1}_{uid}/data"
    nodes = spark.read.parquet(data)
    nodes = nodes.select("nodeData.*") if "nodeData" in nodes.columns else nodes
    inner = nodes.where("leftChild >= 0").groupBy(F.col("split.featureIndex").alias("i")).agg(
        F.avg("gain").alias("gain"), F.sum("gain").alias("total_gain"),
        F.count(F.lit(1)).cast("double").alias("weight"),
        F.avg(F.col("rawCount").cast("double")).alias("cover"),
        F.sum(F.col("rawCount").cast("double")).alias("total_cover"))
    kinds = ["gain", "total_gain", "weight", "cover", "total_cover"]
    totals = inner.agg(*[F.sum(k).alias(f"__{k}") for k in kinds])
    names = spark.createDataFrame([(i, f) for i, f in enumerate(features)], "i int, feature string")
    out = names.join(inner, "i", "left")
    for k in kinds:
        total = totals.select(f"__{k}").scalar()
        out = out.withColumn(k, F.coalesce(F.try_divide(F.col(k), total), F.lit(0.0)))
    return out.select("feature", *kinds).orderBy(F.desc("gain"), "feature")


def partial_dependence(model: Transformer, df: DataFrame, features, all_features, points: int = 100) -> DataFrame:
    """(dataset, feature, value, mean_score): mean prediction with one feature set to each grid value.

    ``points`` evenly spaced values from the feature's lowest to its highest value in the data set.
    """
    rows = df.select("dataset", *[F.col(f).cast("double").alias(f) for f in all_features])
    ends = rows.groupBy("dataset").agg(
        *[F.struct(F.min(f).alias("lo"), F.max(f).alias("hi")).alias(f) for f in features])
    ends = ends.unpivot(["dataset"], list(features), "feature", "ends")
    step = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("k")
    value = F.col("ends.lo") + (F.col("ends.hi") - F.col("ends.lo")) * F.col("k") / (points - 1)
    values = ends.select("dataset", "feature", "ends", step).select("dataset", "feature", value.alias("value"))
    spread = _spread(rows).join(broadcast_if_small(values.distinct(), 200_000), "dataset")
    spread = spread.select("dataset", "feature", "value", *[
        F.when(F.col("feature") == f, F.col("value")).otherwise(F.col(f)).alias(f) if f in features else F.col(f)
        for f in all_features])
    scored = ML.score(model, spread, keep=("dataset", "feature", "value"))
    return scored.groupBy("dataset", "feature", "value").agg(F.avg("score").alias("mean_score"))


def shapley_values(model: Transformer, df: DataFrame, features, permutations: int = 10, id_column: str = "uniqueId",
                   seed: int = 1, hot_rows: int = R.HOT_ROWS) -> DataFrame:
    """(dataset, id, feature, phi): Monte-Carlo Shapley values by random feature orders.

    Per row and order, features switch one by one from a random other row's values to the row's own; the
    change of the score at a switch is credited to the feature that switched, so each order costs one
    prediction per feature plus one.
    """
    features = list(features)
    boosted = _boosted(model, features, df.sparkSession)
    if boosted is not None:
        return _boosted_shapley(boosted, df, features, permutations, id_column, seed, hot_rows)
    rows = df.select("dataset", F.col(id_column).alias("id"), _feature_array(features))
    paired = _with_partner(rows, "id", [seed + k for k in range(permutations)], hot_rows)
    # A feature order is the order of one hash per feature: at a step, the features whose hash is at or below
    # that step's cut have switched.
    hashes = F.transform(F.sequence(F.lit(0), F.lit(len(features) - 1)),
                         lambda k: F.xxhash64(F.col("id"), F.col("rep"), F.lit(seed), k))
    drawn = paired.select("dataset", "id", "__x", "other", hashes.alias("h"))
    entries = F.array_sort(F.transform("h", lambda h, k: F.struct(h.alias("h"), k.alias("k"))))
    drawn = _spread(drawn.select("*", entries.alias("entries")))
    nothing = F.array(F.struct(F.lit(-(2 ** 63)).cast("long").alias("h"), F.lit(-1).alias("k")))
    steps = drawn.select("dataset", "id", "__x", "other", "h", "entries",
                         F.posexplode(F.concat(nothing, F.col("entries"))).alias("step", "at"))
    mixed = F.transform("__x", lambda v, i: F.when(
        (F.col("step") > 0) & (F.get(F.col("h"), i) <= F.col("at.h")), v).otherwise(F.get(F.col("other"), i)))
    steps = steps.select("dataset", "id", F.col("at.k").alias("now"),
                         F.get(F.col("entries"), F.col("step"))["k"].alias("next"), mixed.alias("__m"))
    scored = _score_arrays(model, steps, "__m", features, ("dataset", "id", "now", "next"))
    # the score after a step counts for the feature that switched there and against the one that switches next
    parts = F.array(F.struct(F.col("now").alias("k"), F.col("score").alias("v")),
                    F.struct(F.col("next").alias("k"), (-F.col("score")).alias("v")))
    credit = scored.select("dataset", "id", F.explode(parts).alias("p")).where(F.col("p.k") >= 0)
    sums = credit.groupBy("dataset", "id", F.col("p.k").alias("k")).agg(
        (F.sum("p.v") / permutations).alias("phi"))
    name = F.get(F.array(*[F.lit(f) for f in features]), F.col("k")).alias("feature")
    return sums.select("dataset", "id", name, "phi")


def _credits(batches, boosted):
    """(dataset, id, phi): per row and feature order, the change of the score as each feature that the model reads is switched."""
    for batch in batches:
        if not batch.num_rows:
            continue
        now, own, hashes = (_matrix(batch.column(c)) for c in ("other", "__x", "h"))
        now, row = now.copy(), np.arange(batch.num_rows)
        order, phi = np.argsort(hashes, axis=1, kind="stable"), np.zeros(own.shape)
        before = boosted.scores(boosted.leaves(now))
        for at in order.T:
            now[row, at] = own[row, at]
            after = boosted.scores(boosted.leaves(now))
            phi[row, at], before = after - before, after
        ends = pa.array(np.arange(batch.num_rows + 1) * own.shape[1], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("dataset"), batch.column("id"), pa.ListArray.from_arrays(ends, pa.array(phi.ravel()))],
                                         ["dataset", "id", "phi"])


def _boosted_shapley(boosted, df: DataFrame, features, permutations: int, id_column: str, seed: int, hot_rows: int) -> DataFrame:
    """The same for a boosted model: only features that it reads are switched, in the same order; others change no score."""
    rows = df.select("dataset", F.col(id_column).alias("id"), _feature_array([features[i] for i in boosted.at]))
    phis = rows.select("dataset", "id").distinct()
    found = []
    if boosted.at:
        paired = _with_partner(rows, "id", [seed + k for k in range(permutations)], hot_rows)
        hashes = F.array(*[F.xxhash64(F.col("id"), F.col("rep"), F.lit(seed), F.lit(k)) for k in boosted.at]).alias("h")
        drawn = paired.select("dataset", "id", "__x", "other", hashes)
        shared = df.sparkSession.sparkContext.broadcast(boosted)  # as large as the model
        kinds = [drawn.schema[c].dataType.simpleString() for c in ("dataset", "id")]
        parts = drawn.mapInArrow(lambda batches: _credits(batches, shared.value),
                                 f"dataset {kinds[0]}, id {kinds[1]}, phi array<double>")
        found = [F.get("phi", F.lit(i)) for i in range(len(boosted.at))]
        phis = parts.groupBy("dataset", "id").agg(*[(F.sum(c) / permutations).alias(f"__{i}") for i, c in enumerate(found)])
    each = {i: F.col(f"__{k}") for k, i in enumerate(boosted.at)}
    entries = F.array(*[F.struct(F.lit(f).alias("feature"), each.get(i, F.lit(0.0)).alias("phi")) for i, f in enumerate(features)])
    return phis.select("dataset", "id", F.explode(entries).alias("e")).select("dataset", "id", "e.feature", "e.phi")


def shapley_summary(values: DataFrame) -> DataFrame:
    """(dataset, feature, mean_abs, max_abs), strongest first."""
    return values.groupBy("dataset", "feature").agg(
        F.avg(F.abs("phi")).alias("mean_abs"), F.max(F.abs("phi")).alias("max_abs")).orderBy(
        "dataset", F.desc("mean_abs"), "feature")
