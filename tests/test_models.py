import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlens.operators import evaluate as EV
from txnlens.operators import explain as EX
from txnlens.operators import model as ML

COLS = ["distanceFromHome", "latitude", "amount", "hour"]


@pytest.fixture(scope="module")
def fitted(tables):
    sets = tables.feature_sets()
    return sets, ML.fit(sets.where("dataset = 'train'"), COLS, "fraudLabel", "GBTClassifier",
                        {"n_estimators": 4, "max_depth": 3, "seed": 1})


def test_scores_rank_the_training_label(fitted):
    sets, model = fitted
    train = ML.score(model, sets, label="fraudLabel").where("dataset = 'train'")
    assert EV.metric(train, "auc") > 0.5


def test_last_round_equals_the_model(fitted):
    sets, model = fitted
    rounds = ML.round_scores(model, sets, "fraudLabel", keep=("uniqueId",)).where("round = 4")
    both = rounds.join(ML.score(model, sets, keep=("uniqueId",), name="full"), "uniqueId")
    assert both.where(F.abs(F.col("score") - F.col("full")) > 1e-9).count() == 0
    assert len(ML.loss_per_round(model, sets.where("dataset = 'train'"), "fraudLabel")) == 4


def test_every_round_equals_the_trees_so_far(fitted):
    sets, model = fitted
    boosted, rows = model.stages[-1], model.stages[0].transform(sets.where("dataset = 'test'")).limit(50).collect()
    trees = ML.flat_trees(boosted, sets.sparkSession)
    got = trees.margins(np.array([r[ML.VECTOR].toArray() for r in rows]))
    for r, margins in zip(rows, got):
        each = [w * t.predict(r[ML.VECTOR]) for t, w in zip(boosted.trees, boosted.treeWeights)]
        assert np.allclose(margins, np.cumsum(each), atol=1e-12)


def test_eight_hundred_trees_in_one_pass():
    rng, n = np.random.default_rng(2), 800
    root = np.arange(n) * 7  # complete trees of depth two, nodes in level order
    feature, threshold = rng.integers(0, 5, 7 * n), rng.random(7 * n)
    children = np.repeat(np.arange(7 * n)[:, None], 2, axis=1)
    for k in range(3):
        children[root + k] = np.stack([root + 2 * k + 1, root + 2 * k + 2], axis=1)
    value, x = rng.random(7 * n), rng.random((20, 5))
    got = ML.Trees(root, feature, threshold, children, value, 2).margins(x)
    for row, margins in zip(x, got):
        total = 0.0
        for t in range(n):
            node = 7 * t
            for _ in range(2):
                node = children[node, int(row[feature[node]] > threshold[node])]
            total += value[node]
            assert abs(margins[t] - total) < 1e-9


def test_round_metrics_of_classes_and_values(fitted):
    sets, model = fitted
    got = ML.round_metrics(model, sets, "fraudLabel", thresholds=(0.3,)).where("dataset = 'test' AND round = 4").first()
    scored = ML.score(model, sets, label="fraudLabel").where("dataset = 'test'").toPandas()
    assert abs(got["error@0.3"] - ((scored.score > 0.3) != scored.y).mean()) < 1e-9
    assert abs(got["error"] - ((scored.score > 0.5) != scored.y).mean()) < 1e-9
    value = ML.fit(sets.where("dataset = 'train'"), COLS, "amount", "GBTRegressor", {"n_estimators": 3, "max_depth": 2, "seed": 1})
    last = ML.round_metrics(value, sets, "amount").where("dataset = 'test' AND round = 3").first()
    out = ML.score(value, sets, keep=("dataset", "amount")).where("dataset = 'test'").toPandas()
    assert abs(last["rmse"] - np.sqrt(((out.score - out.amount) ** 2).mean())) < 1e-9
    assert abs(last["mae"] - (out.score - out.amount).abs().mean()) < 1e-9


def test_trials_side_by_side_equal_those_in_turn(fitted):
    sets, _ = fitted
    train, valid = sets.where("dataset = 'train'"), sets.where("dataset = 'validation'")
    settings = [{"max_depth": 1}, {"max_depth": 2}, {"max_depth": 2, "scale_pos_weight": 3.0}]
    how = (train, valid, COLS, "fraudLabel", settings, "DecisionTreeClassifier")
    one, side = ML.tune(*how), ML.tune(*how, n_jobs=3)
    assert one == side and [s for s, _ in side[1]] == settings
    for setting, value in one[1]:
        model = ML.fit(train, COLS, "fraudLabel", "DecisionTreeClassifier", setting)
        assert abs(EV.metric(ML.score(model, valid, keep=(), label="fraudLabel"), "log_loss") - value) < 1e-12
    folded = [ML.tune(train, None, COLS, "fraudLabel", settings[:2], "DecisionTreeClassifier", folds=2, n_jobs=n) for n in (1, 4)]
    assert folded[0] == folded[1]


def test_saved_model_scores_alike(fitted, tmp_path):
    sets, model = fitted
    ML.save(model, str(tmp_path / "m"))
    a = ML.score(model, sets, keep=("uniqueId",))
    b = ML.score(ML.load(str(tmp_path / "m")), sets, keep=("uniqueId",))
    assert a.exceptAll(b).isEmpty()


def test_random_draws_are_values_and_repeatable():
    space = {"d": {"function": "choice", "params": {"options": [3, 9]}},
             "q": {"function": "quniform", "params": {"low": 2, "high": 8, "q": 2}},
             "u": {"function": "uniform", "params": {"low": 0, "high": 1}},
             "n": {"function": "normal", "params": {"mu": 0, "sigma": 1}}}
    one = ML.draws(space, 20, 5)
    assert one == ML.draws(space, 20, 5)
    assert {s["d"] for s in one} == {3, 9} and all(s["q"] in (2, 4, 6, 8) for s in one)
    assert ML.grid({"a": [1, 2], "b": [3]}) == [{"a": 1, "b": 3}, {"a": 2, "b": 3}]


def test_unknown_kind_and_parameter():
    with pytest.raises(ValueError):
        ML.estimator("Other", "y")
    with pytest.raises(ValueError):
        ML.estimator("LogisticRegression", "y", {"max_depth": 3})


def test_tree_importance_sums_to_one(fitted, spark):
    _, model = fitted
    rows = EX.tree_importance(model, COLS, spark).collect()
    assert {r["feature"] for r in rows} == set(COLS)
    for kind in ("gain", "total_gain", "weight", "cover", "total_cover"):
        assert abs(sum(r[kind] for r in rows) - 1) < 1e-9


@pytest.mark.parametrize("hot_rows", [10 ** 6, 10])
def test_permutation_importance(fitted, hot_rows):
    sets, model = fitted
    train = sets.where("dataset = 'train'")
    out = EX.permutation_importance(model, train, COLS, "fraudLabel", 2, ("roc_auc", "neg_log_loss"), hot_rows=hot_rows)
    got = {r["feature"]: r for r in out.collect()}
    assert set(got) == set(COLS)
    assert max(r["roc_auc_mean"] for r in got.values()) > 0


def test_partners_are_a_permutation(fitted):
    sets, _ = fitted
    rows = sets.select("dataset", F.col("uniqueId").alias("id"), F.array(F.col("uniqueId").cast("double")).alias("__x"))
    for hot in (10 ** 6, 7):
        pairs = EX._with_partner(rows, "id", [1, 2], hot)
        n = sets.count()
        assert pairs.count() == 2 * n
        assert pairs.select("dataset", "rep", "other").distinct().count() == 2 * n


def test_shapley_values_add_up(fitted):
    """Per row they sum to its score minus the mean score of the rows it was mixed with."""
    sets, model = fitted
    test = EX.hash_sample(sets.where("dataset = 'test'"), 10)
    values = EX.shapley_values(model, test, COLS, permutations=3, seed=4)
    sums = {r["id"]: r["s"] for r in values.groupBy("id").agg(F.sum("phi").alias("s")).collect()}
    rows = test.select("dataset", F.col("uniqueId").alias("id"), EX._feature_array(COLS))
    pairs = EX._with_partner(rows, "id", [4, 5, 6], 10 ** 6)
    own = EX._score_arrays(model, pairs, "__x", COLS, ("id", "rep"))
    mixed = EX._score_arrays(model, pairs, "other", COLS, ("id", "rep"))
    want = own.join(mixed.withColumnRenamed("score", "other"), ["id", "rep"]).groupBy("id").agg(
        F.avg(F.col("score") - F.col("other")).alias("w")).collect()
    assert len(want) == len(sums) == 10
    for r in want:
        assert abs(sums[r["id"]] - r["w"]) < 1e-9


def test_partial_dependence_grid(fitted):
    sets, model = fitted
    out = EX.partial_dependence(model, sets, ["amount"], COLS, points=5)
    assert out.count() == 15 and out.where("mean_score < 0 OR mean_score > 1").count() == 0


def test_hash_sample_is_repeatable(tables):
    a = [r[0] for r in EX.hash_sample(tables.scored(), 7, seed=1).select("uniqueId").collect()]
    b = [r[0] for r in EX.hash_sample(tables.scored().repartition(5), 7, seed=1).select("uniqueId").collect()]
    assert a == b and len(a) == 7


def test_boosted_explanations_equal_those_of_any_model(fitted, monkeypatch):
    """Scored where the rows are, over the features read, or by MLlib over all: the same importances and Shapley values."""
    sets, model = fitted
    some = sets.where("dataset <> 'train'").withColumn("latitude", F.when(F.col("hour") > 2, F.col("latitude")).otherwise(float("nan")))
    columns = [*COLS, "secondsToTransaction"]
    model = ML.fit(sets.where("dataset = 'train'"), columns, "fraudLabel", "GBTClassifier", {"n_estimators": 3, "max_depth": 2, "seed": 1})

    def explained():
        importance = EX.permutation_importance(model, some, columns, "fraudLabel", 2, ("roc_auc", "average_precision", "neg_log_loss"))
        values = EX.shapley_values(model, some, columns, permutations=2, seed=4)
        return ({(r["dataset"], r["feature"]): r[2:] for r in importance.collect()},
                {(r["dataset"], r["id"], r["feature"]): r["phi"] for r in values.collect()})

    boosted = EX._boosted(model, columns, sets.sparkSession)
    assert 0 < len(boosted.at) < len(columns)
    got = explained()
    monkeypatch.setattr(EX, "_boosted", lambda *a: None)
    want = explained()
    for a, b in zip(got, want, strict=True):
        assert a.keys() == b.keys()
        assert all(np.allclose(a[k], b[k], atol=1e-7) for k in a)


def test_only_scores_of_distinct_values_leave_a_task(fitted):
    """What the counting of permuted scores stores does not grow with the rows."""
    sets, model = fitted
    boosted = EX._boosted(model, COLS, sets.sparkSession)
    rows = sets.select("dataset", F.col("uniqueId").alias("__id"), F.col("fraudLabel").cast("int").alias("__y"),
                       EX._feature_array([COLS[i] for i in boosted.at])).withColumn("rep", F.lit(0).cast("long"))
    once = EX._counted_scores(boosted, rows, [])
    many = EX._counted_scores(boosted, rows.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(50)))), [])
    assert once.count() == many.count() < sets.count()
    assert many.agg(F.sum("all")).first()[0] == 50 * sets.count()
