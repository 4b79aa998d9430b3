import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txnlens.operators import monitor as MO


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(11)
    n = 400
    pdf = pd.DataFrame({"dataset": np.where(np.arange(n) < 250, "a", "b"), "u": rng.normal(size=n).round(3),
                        "w": rng.integers(0, 4, n).astype(float), "y": (rng.random(n) < 0.4).astype(int)})
    pdf["t"] = pdf.u * 2 + rng.normal(size=n)
    return pdf, spark.createDataFrame(pdf)


def legacy_psi(s1, s2, n=10):
    lo, hi = min(min(s1), min(s2)), max(min(s1), max(s2))
    edges = [lo + (hi - lo) * i / n for i in range(n + 1)]
    edges[0] += 1e-6
    edges[-1] += 1e-6
    c1 = pd.cut(pd.Series(s1), edges, labels=False).value_counts().reindex(range(n)).fillna(0)
    c2 = pd.cut(pd.Series(s2), edges, labels=False).value_counts().reindex(range(n)).fillna(0)
    r1, r2 = (c / c.sum() for c in (c1, c2))
    r1, r2 = r1.replace(0, 1e-6), r2.replace(0, 1e-6)
    return float(((r1 - r2) * np.log(r1 / r2)).mean())


def test_legacy_csi_reproduces_the_quirks(frame):
    pdf, df = frame
    got = {r["feature"]: r["csi"] for r in MO.csi_long(df, ["u", "w"], ["a", "b"], legacy=True).collect()}
    for f in ("u", "w"):
        assert abs(got[f] - legacy_psi(pdf[pdf.dataset == "a"][f], pdf[pdf.dataset == "b"][f])) < 1e-12


def test_textbook_psi_uses_every_row_and_is_symmetric(frame):
    _, df = frame
    ab = MO.psi(df, ["a", "b"], "u").first()["psi"]
    ba = MO.psi(df, ["b", "a"], "u").first()["psi"]
    assert abs(ab - ba) < 1e-12 and ab > 0
    grid, counts = MO.bin_table(df, ["u", "w"])
    total = grid.join(counts, ["cell", "bin"]).groupBy("dataset", "feature").agg(F.sum("n").alias("n")).collect()
    assert {(r["dataset"], r["feature"]): r["n"] for r in total} == {
        (d, f): n for d, n in (("a", 250), ("b", 150)) for f in ("u", "w")}


@pytest.mark.parametrize("least", [10 ** 6, 15, 1])
def test_exact_quantiles_against_numpy(frame, least):
    pdf, df = frame
    got = MO.quantile_edges(MO.long_features(df, ["u", "w"]), ["dataset", "feature"], 10, least=least)
    assert len(got) == 4
    for (d, f), edges in got.items():
        want = np.unique(np.quantile(pdf[pdf.dataset == d][["u", "w"][f]], np.linspace(0, 1, 11)))
        assert np.allclose(edges, want, atol=1e-12)


def test_quantiles_of_one_value(spark):
    df = spark.createDataFrame([("a", 5.0)], "dataset string, u double")
    assert list(MO.quantile_edges(MO.long_features(df, ["u"]), ["dataset", "feature"], 10)["a", 0]) == [5.0]


def test_iv_is_infinite_for_a_one_sided_bin(spark):
    rows = [("a", float(i), int(i >= 5)) for i in range(10)]
    w = MO.woe(spark.createDataFrame(rows, "dataset string, u double, y int"), ["u"], "y", "fixed", 2)
    r = MO.iv(w).first()
    assert r["iv"] == float("inf") and 0 < r["adj_iv"] < 10


def test_constant_feature_is_listed_with_zero(spark):
    rows = [("a", float(i), 1.0, int(i >= 5)) for i in range(10)]
    df = spark.createDataFrame(rows, "dataset string, u double, k double, y int")
    got = {r["feature"]: r["iv"] for r in MO.iv(MO.woe(df, ["u", "k"], "y"), ["u", "k"]).collect()}
    assert got["k"] == 0.0 and got["u"] == float("inf")


def test_vif_against_least_squares(frame, spark):
    pdf, _ = frame
    part = pdf[pdf.dataset == "a"].copy()
    part["d0"], part["d1"] = (part.w < 2).astype(float), (part.w >= 2).astype(float)  # dummies that sum to one
    cols = ["u", "t", "d0", "d1"]
    got = {r["feature"]: r["vif"] for r in MO.vif(spark.createDataFrame(part[["dataset", *cols]]), cols).collect()}
    for c in ("u", "t"):
        x, z = part[c].to_numpy(), part[[o for o in cols if o != c]].to_numpy()
        rest = x - z @ np.linalg.lstsq(z, x, rcond=None)[0]
        assert abs(got[c] - ((x - x.mean()) ** 2).sum() / (rest ** 2).sum()) < 1e-6
    plain = ["u", "t", "w"]
    got = {r["feature"]: r["vif"] for r in MO.vif(spark.createDataFrame(part[["dataset", *plain]]), plain).collect()}
    x, z = part["w"].to_numpy(), part[["u", "t"]].to_numpy()
    rest = x - z @ np.linalg.lstsq(z, x, rcond=None)[0]
    assert abs(got["w"] - (x ** 2).sum() / (rest ** 2).sum()) < 1e-6  # no constant among the others: uncentred


def test_collinear_columns_have_infinite_vif(frame, spark):
    pdf, _ = frame
    part = pdf.assign(s=pdf.u + pdf.t)
    got = [r["vif"] for r in MO.vif(spark.createDataFrame(part[["dataset", "u", "t", "s"]]), ["u", "t", "s"]).collect()]
    assert all(v == float("inf") for v in got)


def test_correlation_against_pandas_with_gaps(frame, spark):
    pdf, _ = frame
    part = pdf.assign(u=pdf.u.where(pdf.index % 7 > 0), k=1.0)
    cols = ["u", "t", "w", "k"]
    df = spark.createDataFrame(part[["dataset", *cols]])
    got = {(r["dataset"], r["feature_1"], r["feature_2"]): r["correlation"] for r in MO.corr_long(df, cols).collect()}
    assert len(got) == 2 * 4 * 3
    for d in ("a", "b"):
        want = part[part.dataset == d][cols].corr()
        for i in cols:
            for j in cols:
                if i != j:
                    a, b = got[d, i, j], want.loc[i, j]
                    assert (a is None and np.isnan(b)) or abs(a - b) < 1e-9
    assert MO.corr_matrix(df, cols).count() == 8


def test_wide_form_keeps_the_feature_order(frame):
    _, df = frame
    wide = MO.csi_wide(MO.csi_long(df, ["w", "u", "t"], ["a", "b"]), ["w", "u", "t"], ["a", "b"])
    assert [r["feature"] for r in wide.collect()] == ["w", "u", "t"] and wide.columns == ["feature", "a-b"]
    with pytest.raises(ValueError):
        MO.csi_long(df, ["u"], ["a", "b"], bin_type="even")
