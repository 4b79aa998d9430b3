"""Models on feature tables: assemble, fit, score, tune, per-round metrics, save and load. All MLlib."""

from __future__ import annotations

import itertools
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml import classification as C
from pyspark.ml import clustering as K
from pyspark.ml import regression as G
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.operators import evaluate as EV
from txnlens.sources.writers import materialize, scratch_root

# Model kinds by name.
KINDS = {
    "GBTClassifier": C.GBTClassifier,
    "GBTRegressor": G.GBTRegressor,
    "RandomForestClassifier": C.RandomForestClassifier,
    "RandomForestRegressor": G.RandomForestRegressor,
    "DecisionTreeClassifier": C.DecisionTreeClassifier,
    "DecisionTreeRegressor": G.DecisionTreeRegressor,
    "MLPClassifier": C.MultilayerPerceptronClassifier,
    "LogisticRegression": C.LogisticRegression,
    "LinearRegression": G.LinearRegression,
    "KMeans": K.KMeans,
}

# Boosting parameter names in common use and the MLlib parameters that take their place.
# min_child_weight is approximate (a count, not a sum of second derivatives).
PARAMETERS = {
    "n_estimators": "maxIter",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "subsample": "subsamplingRate",
    "gamma": "minInfoGain",
    "min_child_weight": "minInstancesPerNode",
    "colsample_bynode": "featureSubsetStrategy",
}
WEIGHT, VECTOR = "__weight", "__features"


def estimator(kind: str, label: str | None, params: dict | None = None, n_features: int | None = None):
    """The MLlib estimator of a kind, with parameters under either naming."""
    if kind not in KINDS:
        raise ValueError(f"model kind must be one of {sorted(KINDS)}, not {kind!r}")
    est = KINDS[kind]()
    est.setFeaturesCol(VECTOR)
    if label is not None and est.hasParam("labelCol"):
        est.setLabelCol(label)
    params = dict(params or {})
    if params.pop("scale_pos_weight", None) is not None:
        est.setWeightCol(WEIGHT)
    if kind == "MLPClassifier" and "layers" not in params:
        params["layers"] = [n_features, max(2, n_features // 2), 2]
    for name, value in params.items():
        target = PARAMETERS.get(name, name)
        if target == "maxIter" and not est.hasParam("maxIter"):
            target = "numTrees"
        if not est.hasParam(target):
            raise ValueError(f"{kind} has no parameter {name!r}")
        if target == "featureSubsetStrategy":
            value = str(value)
        est.set(est.getParam(target), value)
    return est


def _weighted(train: DataFrame, label: str | None, params: dict | None) -> DataFrame:
    weight = (params or {}).get("scale_pos_weight")
    return train if weight is None else train.withColumn(WEIGHT, F.when(F.col(label) == 1, float(weight)).otherwise(1.0))


def fit(train: DataFrame, features, label: str | None, kind: str = "GBTClassifier",
        params: dict | None = None) -> PipelineModel:
    """Assemble the feature vector by name and fit."""
    train = _weighted(train, label, params)
    assemble = VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="keep")
    return Pipeline(stages=[assemble, estimator(kind, label, params, len(features))]).fit(train)


def score(model: Transformer, df: DataFrame, keep=("dataset",), label: str | None = None,
          name: str = "score") -> DataFrame:
    """``keep`` columns, ``y`` when there is a label, and the probability of class 1 (or the prediction)."""
    out = model.transform(df)
    value = (F.get(vector_to_array("probability"), F.lit(1)) if "probability" in out.columns
             else F.col("prediction").cast("double"))
    y = [F.col(label).cast("int").alias("y")] if label else []
    return out.select(*keep, *y, value.alias(name))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def grid(space: dict) -> list:
    """Every combination of the listed values."""
    names = list(space)
    return [dict(zip(names, values)) for values in itertools.product(*space.values())]


def draws(space: dict, n: int, seed: int) -> list:
    """``n`` seeded random settings. Each parameter is {"function": choice | uniform | quniform | normal,
    "params": ...}; quniform gives whole numbers. Values are returned, never option indices."""
    rng = np.random.default_rng(seed)

    def one(spec):
        kind, p = spec["function"], spec["params"]
        if kind == "choice":
            return p["options"][int(rng.integers(len(p["options"])))]
        if kind == "uniform":
            return float(rng.uniform(p["low"], p["high"]))
        if kind == "quniform":
            return int(round(rng.uniform(p["low"], p["high"]) / p["q"]) * p["q"])
        if kind == "normal":
            return float(rng.normal(p["mu"], p["sigma"]))
        raise ValueError(f"unknown distribution {kind!r}")

    return [{name: one(spec) for name, spec in space.items()} for _ in range(n)]


def assembled(df: DataFrame, features, label: str, keep=()) -> DataFrame:
    """(keep..., label, features, vector): rows whose features are put together once for many trials. Stored."""
    assemble = VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="keep")
    rows = assemble.transform(df.select(*dict.fromkeys([*keep, label, *features])))
    return materialize(rows.select(*dict.fromkeys([*keep, label]), VECTOR), "assembled")


def trial(train, valid, n_features: int, label: str, kind: str, params: dict, metric: str) -> float:
    """The metric of one setting, fitted and scored on assembled rows."""
    model = estimator(kind, label, params, n_features).fit(_weighted(train, label, params))
    return EV.metric(score(model, valid, keep=(), label=label), metric)


def tune(train: DataFrame, valid: DataFrame | None, features, label: str, settings, kind: str = "GBTClassifier",
         base: dict | None = None, metric: str = "log_loss", folds: int | None = None, id_column: str = "uniqueId",
         seed: int = 0, n_jobs: int = 1) -> tuple:
    """Try each setting; returns (best setting, [(setting, metric value)]).

    Scores a fixed validation set, or with ``folds`` the mean over that many folds of the training set (rows
    are assigned to folds by a hash of their id, so a fold is the same in every trial). Metrics are of
    probabilities. The rows are assembled and stored once; up to ``n_jobs`` trials run at a time, each as Spark jobs of its own,
    and results come in the order of the settings whatever their number.
    """
    settings, features = list(settings), list(features)
    if folds:
        whole = assembled(train, features, label, [id_column])
        fold = F.pmod(F.xxhash64(F.col(id_column), F.lit(seed)), F.lit(folds))
        pairs = [(whole.where(fold != i), whole.where(fold == i)) for i in range(folds)]
    else:
        pairs = [(assembled(train, features, label), assembled(valid, features, label))]
    with ThreadPoolExecutor(max(1, n_jobs)) as pool:
        values = [[pool.submit(trial, *pair, len(features), label, kind, {**(base or {}), **setting}, metric) for pair in pairs] for setting in settings]
        results = [(setting, float(np.mean([v.result() for v in of]))) for setting, of in zip(settings, values, strict=True)]
    pick = max if EV.HIGHER_IS_BETTER[metric] else min
    return pick(results, key=lambda r: r[1])[0], results


@dataclass(frozen=True)
class Trees:
    """The trees of a boosted model as flat arrays, one entry per node; a leaf is its own child. As large as the model."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    children: np.ndarray  # two columns: below or at the threshold, above it
    value: np.ndarray     # of a leaf, times the weight of its tree
    depth: int

    def margins(self, x: np.ndarray) -> np.ndarray:
        """One row per row of ``x``: the sum of the leaves reached up to each tree. All trees descend one level at a time."""
        node, row = np.broadcast_to(self.roots, (len(x), len(self.roots))), np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = self.children[node, (x[row, self.feature[node]] > self.threshold[node]).astype(np.int8)]
        return np.cumsum(self.value[node], axis=1)

    def reads(self) -> list:
        """Per feature that any tree reads, in rising order: (feature, the trees that read it)."""
        below: dict = {}
        for tree, root in enumerate(self.roots.tolist()):
            waiting = [root]
            while waiting:
                node = waiting.pop()
                if self.children[node, 0] != node:
                    below.setdefault(int(self.feature[node]), set()).add(tree)
                    waiting.extend(self.children[node].tolist())
        return [(f, sorted(below[f])) for f in sorted(below)]

    def leaves(self, x: np.ndarray, trees) -> np.ndarray:
        """The leaves that the rows of ``x`` reach in ``trees``, one column each. As in MLlib, a missing value goes right."""
        out, row, left, right = np.empty((len(x), len(trees))), np.arange(len(x)), *self.children.T.copy()
        for column, tree in enumerate(trees):
            node = np.full(len(x), self.roots[tree])
            for _ in range(self.depth):
                node = np.where(x[row, self.feature[node]] <= self.threshold[node], left[node], right[node])
            out[:, column] = self.value[node]
        return out

    def narrowed(self, features) -> Trees:
        """The same trees over rows that hold only ``features``, in rising order; they must be all that the trees read."""
        return replace(self, feature=np.minimum(np.searchsorted(features, self.feature), max(0, len(features) - 1)))


def flat_trees(boosted, spark: SparkSession) -> Trees:
    """The trees of a boosted model, from the node table that it is saved as."""
    path = f"{scratch_root(spark)}/txnlens/trees-{uuid.uuid4().hex}"
    boosted.write().save(path)
    rows = sorted(spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect(), key=lambda r: (r["treeID"], r["id"]))
    at = {(r["treeID"], r["id"]): i for i, r in enumerate(rows)}
    feature, threshold = np.zeros(len(rows), np.int64), np.full(len(rows), np.inf)
    children, value = np.repeat(np.arange(len(rows))[:, None], 2, axis=1), np.zeros(len(rows))
    level, deepest = {}, 0
    for i, r in enumerate(rows):
        value[i] = r["prediction"] * boosted.treeWeights[r["treeID"]]
        depth = level.setdefault(i, 0)
        if r["leftChild"] >= 0:
            split = r["split"]
            if split["numCategories"] >= 0:
                raise ValueError("only splits of continuous features are supported")
            feature[i], threshold[i] = split["featureIndex"], split["leftCategoriesOrThreshold"][0]
            children[i] = at[r["treeID"], r["leftChild"]], at[r["treeID"], r["rightChild"]]
            level[children[i, 0]] = level[children[i, 1]] = depth + 1
            deepest = max(deepest, depth + 1)
    roots = np.array([at[t, 0] for t in range(len(boosted.treeWeights))], np.int64)
    return Trees(roots, feature, threshold, children, value, deepest)


def round_margins(model: PipelineModel, df: DataFrame, label: str, keep=("dataset",)) -> DataFrame:
    """(keep..., y, margins): the margin of the ensemble after each boosting round, all rounds in one pass over the rows."""
    rows = df
    for stage in model.stages[:-1]:
        rows = stage.transform(rows)
    trees = df.sparkSession.sparkContext.broadcast(flat_trees(model.stages[-1], df.sparkSession))  # as large as the model

    @F.pandas_udf("array<double>")
    def margins(x: pd.Series) -> pd.Series:
        out = [trees.value.margins(np.stack(x.iloc[i:i + 512].to_numpy())) for i in range(0, len(x), 512)]
        return pd.Series([m for part in out for m in part], index=x.index, dtype=object)

    kind = "double" if isinstance(model.stages[-1], GBTRegressionModel) else "int"
    return rows.select(*keep, F.col(label).cast(kind).alias("y"), margins(vector_to_array(VECTOR)).alias("margins"))


def round_scores(model: PipelineModel, df: DataFrame, label: str, keep=("dataset",)) -> DataFrame:
    """(keep..., y, round, score): the probability after each boosting round, or a regression's value."""
    return _by_round(model, round_margins(model, df, label, keep), keep)


def _by_round(model: PipelineModel, margins: DataFrame, keep) -> DataFrame:
    rounds = margins.select(*keep, "y", F.posexplode("margins").alias("i", "margin"))
    linked = F.col("margin") if isinstance(model.stages[-1], GBTRegressionModel) else 1 / (1 + F.exp(-2 * F.col("margin")))
    return rounds.select(*keep, "y", (F.col("i") + 1).alias("round"), linked.alias("score"))


def round_metrics(model: PipelineModel, df: DataFrame, label: str, thresholds=()) -> DataFrame:
    """(dataset, round, auc, aucpr, logloss, error) after every boosting round, and ``error@t`` for each of ``thresholds``; of a
    regression (dataset, round, rmse, mae). The rows are scored once and stored."""
    by = ("dataset", "round")
    rounds = _by_round(model, materialize(round_margins(model, df, label), "round-margins"), ("dataset",))
    if isinstance(model.stages[-1], GBTRegressionModel):
        off = F.col("score") - F.col("y")
        return rounds.groupBy(*by).agg(F.sqrt(F.avg(off * off)).alias("rmse"), F.avg(F.abs(off)).alias("mae"))
    curves = EV.curve_metrics(rounds, by).select(*by, F.col("roc_auc").alias("auc"), F.col("pr_auc").alias("aucpr"))
    wrong = [F.avg(((F.col("score") > t).cast("int") != F.col("y")).cast("double")).alias(name)
             for t, name in [(0.5, "error"), *((t, f"error@{t}") for t in thresholds)]]
    error = rounds.groupBy(*by).agg(*wrong)
    loss = EV.losses(rounds, by).select(*by, F.col("log_loss").alias("logloss"))
    return curves.join(loss, [*by]).join(error, [*by])


def optimal_rounds(metrics: DataFrame) -> DataFrame:
    """(Metric, dataset, round): the first round with the best value."""
    higher = {"auc": True, "aucpr": True, "logloss": False, "error": False}
    aggs = []
    for m, up in higher.items():
        # ties go to the earliest round
        order = F.struct((-F.col(m) if up else F.col(m)).alias("v"), "round")
        aggs.append(F.min_by("round", order).cast("long").alias(m))
    best = metrics.groupBy("dataset").agg(*aggs)
    return best.unpivot(["dataset"], list(higher), "Metric", "round").select("Metric", "dataset", "round")


def loss_per_round(model: PipelineModel, df: DataFrame, label: str) -> list:
    """MLlib's own loss after each boosting round, every row with weight one."""
    rows = df.withColumn(label, F.col(label).cast("double")).withColumn(WEIGHT, F.lit(1.0))
    for stage in model.stages[:-1]:
        rows = stage.transform(rows)
    return list(model.stages[-1].evaluateEachIteration(rows))
