import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txnlens.operators import calibrate as CA
from txnlens.operators import evaluate as EV


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    n = 120
    y = (rng.random(n) < 0.3).astype(int)
    score = np.clip((rng.random(n) * 0.7 + 0.3 * y).round(2), 0, 1)
    pdf = pd.DataFrame({"dataset": np.where(np.arange(n) < 80, "a", "b"), "y": y, "score": score,
                        "amount": rng.random(n).round(2)})
    return pdf, spark.createDataFrame(pdf)


def brute(part):
    pos, neg = part[part.y == 1].score.to_numpy(), part[part.y == 0].score.to_numpy()
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    ap = pr = 0.0
    r0, p0 = 0.0, 1.0
    for t in sorted(set(part.score), reverse=True):
        up = part[part.score >= t]
        p, r = up.y.mean(), up.y.sum() / len(pos)
        ap, pr = ap + (r - r0) * p, pr + (r - r0) * (p + p0) / 2
        r0, p0 = r, p
    c = np.concatenate([[0], np.cumsum(part.sort_values(["score", "y"], ascending=False).y)])
    P, n = len(pos), len(part)
    area = ((c[1:] + c[:-1]) / 2).sum()
    perfect = P * P / 2 + (n - P) * P
    grid = sorted(set(part.score))
    ks = max(abs((pos <= t).mean() - (neg <= t).mean()) for t in grid)
    return wins / len(pos) / len(neg), pr, ap, (area - n * P / 2) / (perfect - n * P / 2), ks


@pytest.mark.parametrize("hot_rows", [10 ** 6, 4])
def test_curve_metrics_against_brute_force(scored, hot_rows):
    pdf, df = scored
    for r in EV.curve_metrics(df, hot_rows=hot_rows).collect():
        got = [r[c] for c in ("roc_auc", "pr_auc", "average_precision", "accuracy_ratio", "ks")]
        assert np.allclose(got, brute(pdf[pdf.dataset == r["dataset"]]), atol=1e-12)


def test_threshold_table_against_brute_force(scored):
    pdf, df = scored
    part = pdf[pdf.dataset == "a"]
    got = EV.threshold_table(df, 0.05, aux=["amount"]).where("dataset = 'a'").orderBy("threshold").toPandas()
    assert len(got) == 20
    for i, row in got.iterrows():
        edge = 0 if i == 0 else (i - 1) * 0.05 + 0.05
        up = part.score >= edge
        assert (row.tp, row.fp) == ((up & (part.y == 1)).sum(), (up & (part.y == 0)).sum())
        assert row.fn + row.tp == part.y.sum()
        assert abs(row.amount_tp_sum - part[up & (part.y == 1)].amount.sum()) < 1e-9
    with pytest.raises(ValueError):
        EV.threshold_table(df, 1.5)


def test_histogram_keeps_every_row_and_closes_the_last_bin(spark):
    rows = [("a", 0, s) for s in (0.0, 0.06, 0.14, 0.58, 0.9999, 1.0)]
    got = {r["bin"]: r["n"] for r in EV.score_histogram(spark.createDataFrame(rows, "dataset string, y int, score double")).collect()}
    edges = np.arange(0, 1.02, 0.02)
    want = np.histogram([r[2] for r in rows], bins=edges)[0]
    assert got == {i: n for i, n in enumerate(want) if n}


def test_det_curve_runs_from_lowest_fp_to_full_recall(spark):
    rows = [("a", y, s) for y, s in [(1, .9), (1, .8), (0, .7), (1, .6), (0, .5), (0, .4)]]
    got = EV.det_curve(spark.createDataFrame(rows, "dataset string, y int, score double")).orderBy("threshold").collect()
    assert [(r["threshold"], round(r["fpr"], 4), round(r["fnr"], 4)) for r in got] == [
        (.6, .3333, 0.0), (.7, .3333, .3333), (.8, 0.0, .3333)]


def test_metric_names(scored):
    _, df = scored
    for name in EV.HIGHER_IS_BETTER:
        assert 0 <= EV.metric(df, name) < 10
    with pytest.raises(ValueError):
        EV.metric(df, "accuracy")


@pytest.mark.parametrize("n0,n1", [(3, 4), (5, 2), (4, 4)])
def test_exact_ks_p_value_against_all_arrangements(n0, n1):
    dists = []
    for where in itertools.combinations(range(n0 + n1), n0):
        i = j = 0
        d = 0.0
        for k in range(n0 + n1):
            i, j = (i + 1, j) if k in where else (i, j + 1)
            d = max(d, abs(i / n0 - j / n1))
        dists.append(d)
    for d in sorted(set(round(x, 9) for x in dists)):
        assert abs(EV.ks_exact(d, n0, n1) - np.mean([x >= d - 1e-7 for x in dists])) < 1e-12


def test_limiting_ks_p_value_at_every_size(spark):
    rows = spark.createDataFrame([(0.02, 20_000, 20_000), (0.0, 20_000, 20_000), (0.5, 4, 4), (0.5, 0, 4)], "d double, n0 long, n1 long")
    got = [r[0] for r in rows.select(EV.ks_limit(F.col("d"), F.col("n0"), F.col("n1"))).collect()]
    assert abs(got[0] - 0.00067) < 5e-5 and got[1] == 1.0 and abs(got[2] - 0.6994) < 1e-3 and np.isnan(got[3])


def pav(points):
    blocks = [[y * w, w, [s]] for s, y, w in points]
    i = 0
    while i < len(blocks) - 1:
        if blocks[i][0] / blocks[i][1] > blocks[i + 1][0] / blocks[i + 1][1]:
            blocks[i] = [blocks[i][0] + blocks[i + 1][0], blocks[i][1] + blocks[i + 1][1], blocks[i][2] + blocks[i + 1][2]]
            del blocks[i + 1]
            i = max(i - 1, 0)
        else:
            i += 1
    return {s: b[0] / b[1] for b in blocks for s in b[2]}


def test_isotonic_against_pooled_neighbours(scored):
    pdf, df = scored
    groups = pdf.groupby("score").y.agg(["mean", "count"]).reset_index()
    want = pav(list(groups.itertuples(index=False, name=None)))
    for r in CA.apply(CA.fit(df, "isotonic"), df).collect():
        assert abs(r["score_cal"] - want[r["score"]]) < 1e-9


def test_calibrators_are_monotone_and_bounded(scored, spark):
    _, df = scored
    for kind in CA.TYPES:
        rows = CA.mapping_table(CA.fit(df, kind), spark, 0.01).orderBy("score").collect()
        values = [r["calibrated_score"] for r in rows]
        assert len(values) == 100 and all(a <= b + 1e-12 for a, b in zip(values, values[1:]))
        assert 0 <= values[0] and values[-1] <= 1
    with pytest.raises(ValueError):
        CA.fit(df, "spline")


def test_reliability_edges_belong_to_the_lower_bin(spark):
    df = spark.createDataFrame([("a", 1, .2), ("a", 0, .2000001), ("a", 1, 1.0)], "dataset string, y int, score double")
    got = {r["bin"]: r["n"] for r in CA.reliability_curve(df).collect()}
    assert got == {0: 1, 1: 1, 4: 1}
