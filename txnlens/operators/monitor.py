"""Stability and collinearity: binning, PSI, CSI, WOE/IV, cross products, VIF, correlation.

Features are unpivoted once and counted per (feature, bin) with map-side partial sums; nothing loops over
features. ``legacy=True`` reproduces three quirks of published values: the upper edge of the fixed bins uses
the first set's minimum instead of its maximum, the lowest edge is raised by 1e-6 so that the minimum falls
out of all bins, and PSI is the mean over bins rather than the sum.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.functions.scalars import log_ratio
from txnlens.operators import quantiles as Q

EPS = 1e-6  # fixed value: edge widening and the rate that stands for an empty bin
BIN_TYPES = ("fixed", "quantiles")


def long_features(df: DataFrame, features, keep=("dataset",)) -> DataFrame:
    """(keep..., feature, value) rows, ``feature`` being the position in ``features``.

    Missing values are left out, as they are in no bin.
    """
    values = F.array(*[F.col(c).cast("double") for c in features])
    return df.select(*keep, F.posexplode(values).alias("feature", "value")).where(
        F.col("value").isNotNull() & ~F.isnan("value"))


def _coded(df: DataFrame, datasets) -> DataFrame:
    """Data set names as their positions: joins and groupings of many rows then compare integers."""
    names = F.array(*[F.lit(d) for d in datasets])
    return df.withColumn("dataset", (F.array_position(names, F.col("dataset")) - 1).cast("int"))


def _name(names, column):
    return F.get(F.array(*[F.lit(n) for n in names]), F.col(column))


def quantile_edges(values: DataFrame, keys, n_bins: int, exact: bool = True, accuracy: int = 10_000, **how) -> dict:
    """Distinct n-quantiles of ``value`` per key, as {key tuple: array}.

    Exact ones are interpolated between the values at the neighbouring ranks, see ``quantiles``; ``how`` goes there.
    ``exact=False`` takes a sketch alone (rank error at most rows / accuracy, no interpolation) in one pass.
    """
    shares = [i / n_bins for i in range(n_bins + 1)]
    if not exact:
        q = values.groupBy(*keys).agg(F.percentile_approx("value", shares, accuracy).alias("q"))
        return {tuple(r[k] for k in keys): np.unique(r["q"]) for r in q.collect()}
    return {key: np.unique(found) for key, found in Q.quantiles(values, keys, shares, **how).items()}


def fixed_edges(lo: float, hi: float, n_bins: int, legacy: bool = False) -> np.ndarray:
    """n + 1 equally spaced edges. The last is ``hi`` itself, which the formula can miss by a rounding; the
    legacy form keeps the formula, as its widening covers that."""
    edges = np.array([lo + (hi - lo) * i / n_bins for i in range(n_bins + 1)])
    if not legacy:
        edges[-1] = hi
    return edges


def widen(edges: np.ndarray, legacy: bool) -> np.ndarray:
    """``legacy`` raises both outer edges by EPS; otherwise they stay (and the lowest bin is closed)."""
    edges = np.array(edges, dtype=float)
    if legacy:
        edges[[0, -1]] += EPS
    return edges


def _check_bins(bin_type):
    if bin_type not in BIN_TYPES:
        raise ValueError(f"bin_type must be one of {BIN_TYPES}, not {bin_type!r}")


def _ends(values: DataFrame, keys) -> dict:
    rows = values.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
    return {tuple(r[k] for k in keys): (r["lo"], r["hi"]) for r in rows}


def bins(values: DataFrame, keys, bin_type: str = "fixed", n_bins: int = 10, legacy: bool = False,
         exact: bool = True) -> dict:
    """Edges of each key's own values. Keys are data set and feature names, so this stays small."""
    _check_bins(bin_type)
    if bin_type == "quantiles":
        found = quantile_edges(values, keys, n_bins, exact)
    else:
        found = {k: fixed_edges(lo, hi, n_bins, legacy) for k, (lo, hi) in _ends(values, keys).items()}
    return {k: widen(e, legacy) for k, e in found.items()}


def edge_table(spark: SparkSession, names, rows, n_bins: int) -> DataFrame:
    """Local table of (names..., n_edges, e0 ... en) from (name values, edges) pairs; unused edges are +inf."""
    rows = list(rows)
    kinds = [T.IntegerType() if rows and isinstance(v, int) else T.StringType() for v in (rows[0][0] if rows else names)]
    fields = [T.StructField(n, k, False) for n, k in zip(names, kinds)]
    fields.append(T.StructField("n_edges", T.IntegerType(), False))
    fields += [T.StructField(f"e{i}", T.DoubleType(), False) for i in range(n_bins + 1)]
    data = [(*key, len(e), *[float(x) for x in e], *[float("inf")] * (n_bins + 1 - len(e))) for key, e in rows]
    return spark.createDataFrame(data, T.StructType(fields))


def cell_counts(values: DataFrame, cells, legacy: bool, extra=()) -> DataFrame:
    """(cell, extra..., bin, n): rows per right-closed bin. ``cells`` lists (feature position, data set
    position, edges), the cell number being the position in that list; a value may belong to several cells.

    The edges of all cells of a feature and data set are merged, so a value is placed once among them and
    counted once. Which bin of which cell a gap between merged edges belongs to is looked up afterwards, on
    the counts.
    """
    spark = values.sparkSession
    cuts = [np.array(e, dtype=float) for _, _, e in cells]
    if not legacy:
        for c in cuts:  # the lowest bin is closed: above the next smaller number means at or above the edge
            c[0] = np.nextafter(c[0], -np.inf)
    merged: dict = {}
    for (f, d, _), c in zip(cells, cuts):
        merged.setdefault((f, d), []).append(c)
    merged = {key: np.unique(np.concatenate(parts)) for key, parts in merged.items()}
    gaps = []
    for k, ((f, d, e), c) in enumerate(zip(cells, cuts)):
        bin_of = np.searchsorted(c, merged[f, d], side="right") - 1
        gaps += [(f, d, j + 1, k, int(i)) for j, i in enumerate(bin_of) if 0 <= i < len(e) - 1]
    gaps = spark.createDataFrame(gaps, "feature int, dataset int, slot int, cell int, bin int")
    # one row per feature and data set
    edges = spark.createDataFrame([(f, d, [float(x) for x in u]) for (f, d), u in merged.items()],
                                  "feature int, dataset int, edges array<double>")
    most = max((len(u) for u in merged.values()), default=1)
    placed = Q.edges_below(values.join(F.broadcast(edges), ["feature", "dataset"]),
                          ["feature", "dataset", *extra], most)
    counted = placed.groupBy("feature", "dataset", *extra, "slot").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(gaps, ["feature", "dataset", "slot"]).groupBy("cell", *extra, "bin").agg(F.sum("n").alias("n"))


def bin_grid(spark, keyed, names) -> DataFrame:
    """(cell, names..., bin, lower, upper): every bin of every cell, from (name values, edges) pairs."""
    rows = [(c, *key, i, float(e[i]), float(e[i + 1])) for c, (key, e) in enumerate(keyed) for i in range(len(e) - 1)]
    text = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame(rows, f"cell int, {text}, bin int, lower double, upper double")


def bin_table(df: DataFrame, features, bin_type: str = "fixed", n_bins: int = 10, legacy: bool = False, extra=(),
              exact: bool = True):
    """(grid, counts) of the bins of each data set and feature: two passes, edges and then counts by cell."""
    values = long_features(df, features)
    found = bins(values, ["dataset", "feature"], bin_type, n_bins, legacy, exact)
    datasets = sorted({d for d, _ in found})
    coded = long_features(_coded(df, datasets), features, keep=("dataset", *extra))
    keys = sorted(found)
    counts = cell_counts(coded, [(f, datasets.index(d), found[d, f]) for d, f in keys], legacy, extra)
    grid = bin_grid(df.sparkSession, [((d, features[f]), found[d, f]) for d, f in keys], ["dataset", "feature"])
    return grid, counts


def csi_long(df: DataFrame, features, datasets, bin_type: str = "fixed", n_bins: int = 10, legacy: bool = False,
             exact: bool = True) -> DataFrame:
    """(dataset1, dataset2, feature, csi) for every pair of data sets, in the order they are listed.

    Two passes: edges, then one count per (feature, pair, data set, bin).
    """
    _check_bins(bin_type)
    features, datasets = list(features), list(datasets)
    spark = df.sparkSession
    df = df.where(F.col("dataset").isin(datasets))
    values = long_features(_coded(df, datasets), features)
    ends = _ends(values, ["feature", "dataset"])
    quantiles = quantile_edges(values, ["feature", "dataset"], n_bins, exact) if bin_type == "quantiles" else {}
    cells, listed = [], []
    for f in range(len(features)):
        for a, b in combinations([d for d in range(len(datasets)) if (f, d) in ends], 2):
            (lo1, hi1), (lo2, hi2) = ends[f, a], ends[f, b]
            lo, hi = min(lo1, lo2), max(lo1 if legacy else hi1, hi2)
            if bin_type == "fixed":
                e = fixed_edges(lo, hi, n_bins, legacy)
            else:
                e = quantiles[f, a].copy()
                if not legacy:  # open the outer bins to both sets
                    e[0], e[-1] = lo, hi
            e = widen(e, legacy)
            for side, d in ((1, a), (2, b)):
                listed.append((len(cells), datasets[a], datasets[b], features[f], side, len(e) - 1))
                cells.append((f, d, e))
    names = spark.createDataFrame(
        listed, "cell int, dataset1 string, dataset2 string, feature string, side int, bins int")
    counts = cell_counts(values, cells, legacy)
    pair = ["dataset1", "dataset2", "feature"]

    def of(side):
        return F.sum(F.when(F.col("side") == side, F.col("n")).otherwise(0))

    # from here on there are at most n_bins rows per feature, pair and side
    per_bin = names.join(counts, "cell", "left").groupBy(*pair, "bins", "bin").agg(of(1).alias("c1"), of(2).alias("c2"))
    whole = Window.partitionBy(*pair)

    def rate(c):
        r = F.coalesce(F.try_divide(F.col(c), F.sum(c).over(whole)), F.lit(0.0))
        return F.when(r == 0, F.lit(EPS)).otherwise(r)

    rated = per_bin.select(*pair, "bins", rate("c1").alias("r1"), rate("c2").alias("r2"))
    # bins empty on both sides add nothing; they count in the mean
    total = F.sum((F.col("r1") - F.col("r2")) * F.ln(F.col("r1") / F.col("r2")))
    value = total / F.max("bins") if legacy else total
    return rated.groupBy(*pair).agg(value.alias("csi")).select(*pair, "csi")


def psi(df: DataFrame, datasets, score: str = "score", **options) -> DataFrame:
    """(dataset1, dataset2, psi) of the score for every pair of data sets."""
    out = csi_long(df, [score], datasets, **options)
    return out.select("dataset1", "dataset2", F.col("csi").alias("psi"))


def csi_wide(long: DataFrame, features, datasets) -> DataFrame:
    """One row per feature in the given order, one column per pair of data sets."""
    pairs = [f"{a}-{b}" for a, b in combinations(datasets, 2)]
    wide = (long.withColumn("pair", F.concat_ws("-", "dataset1", "dataset2"))
            .groupBy("feature").pivot("pair", pairs).agg(F.first("csi")))
    return in_order(wide, "feature", features)


def in_order(df: DataFrame, column: str, order) -> DataFrame:
    """Sort by the position of ``column`` in a given list."""
    ranks = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(order)], f"{column} string, __pos int")
    return df.join(F.broadcast(ranks), column).orderBy("__pos").drop("__pos")


def woe(df: DataFrame, features, label: str, bin_type: str = "quantiles", n_bins: int = 10, legacy: bool = False,
        exact: bool = True) -> DataFrame:
    """Weight of evidence per data set, feature and bin, with a half-count adjusted form."""
    features, keys = list(features), ["dataset", "feature"]
    grid, counted = bin_table(df, features, bin_type, n_bins, legacy, (label,), exact)
    counted = counted.groupBy("cell", "bin").agg(
        *[F.sum(F.when(F.col(label) == k, F.col("n")).otherwise(0)).alias(f"cnt_{k}") for k in (0, 1)])
    counts = grid.join(counted, ["cell", "bin"], "left").fillna(0, ["cnt_0", "cnt_1"])
    whole = Window.partitionBy(*keys)  # at most n_bins rows
    c = counts.withColumn("t0", F.sum("cnt_0").over(whole)).withColumn("t1", F.sum("cnt_1").over(whole))
    p0, p1 = F.try_divide("cnt_0", "t0"), F.try_divide("cnt_1", "t1")
    adjusted = F.ln(F.try_divide(F.try_divide(F.col("cnt_1") + 0.5, F.col("t1")),
                                 F.try_divide(F.col("cnt_0") + 0.5, F.col("t0"))))
    return c.select(*keys, "bin", "lower", "upper", "cnt_0", "cnt_1", p0.alias("pct_0"), p1.alias("pct_1"),
                    log_ratio(p1, p0).alias("woe"), adjusted.alias("adj_woe"))


def iv(woe_table: DataFrame, features=None) -> DataFrame:
    """Information value per data set and feature; infinite where a bin is one-sided.

    A feature with one value only has no bins; with ``features`` given it is listed with zero.
    """
    diff = F.col("pct_1") - F.col("pct_0")
    out = woe_table.groupBy("dataset", "feature").agg(
        F.sum(F.col("woe") * diff).alias("iv"), F.sum(F.col("adj_woe") * diff).alias("adj_iv"))
    if features is None:
        return out
    every = woe_table.select("dataset").distinct().select(
        "dataset", F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))
    return every.join(out, ["dataset", "feature"], "left").fillna(0.0, ["iv", "adj_iv"])


def cross_products(df: DataFrame, columns) -> DataFrame:
    """Pairwise sums per data set: (dataset, i, j, n, sx, sy, sxx, syy, sxy) with i <= j.

    Values are centred on the column means first (one aggregate, a few numbers per data set). Each task
    multiplies its own Arrow batches and emits one matrix per data set; only those are shuffled and added.
    A pair counts the rows where both values are present.
    """
    columns = list(columns)
    wanted = df.select("dataset", *[F.nullif(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in columns])
    rows = wanted.groupBy("dataset").agg(*[F.avg(c).alias(c) for c in columns]).collect()
    means = {r["dataset"]: np.array([r[c] or 0.0 for c in columns]) for r in rows}
    upper = np.triu_indices(len(columns))

    def partial(batches):
        acc = {}
        for pdf in batches:
            for name, part in pdf.groupby("dataset"):
                x = part[columns].to_numpy(dtype=float) - means[name]
                m = (~np.isnan(x)).astype(float)
                x = np.nan_to_num(x)
                # stacked: n, sum x_i, sum x_j, sum x_i^2, sum x_j^2, sum x_i x_j over rows with both present
                s, q = x.T @ m, (x * x).T @ m
                sums = np.stack([m.T @ m, s, s.T, q, q.T, x.T @ x])
                acc[name] = acc[name] + sums if name in acc else sums
        for name, sums in acc.items():
            i, j = upper
            out = pd.DataFrame({"dataset": name, "i": i, "j": j})
            for k, col in enumerate(("n", "sx", "sy", "sxx", "syy", "sxy")):
                out[col] = sums[k][upper]
            yield out

    schema = "dataset string, i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    sums = ("n", "sx", "sy", "sxx", "syy", "sxy")
    out = wanted.mapInPandas(partial, schema).groupBy("dataset", "i", "j").agg(*[F.sum(c).alias(c) for c in sums])
    # correlation and VIF want the centred sums; gram() puts the means back
    centre = df.sparkSession.createDataFrame(
        [(name, k, float(v)) for name, mean in means.items() for k, v in enumerate(mean)],
        "dataset string, k int, mean double")
    left = centre.select("dataset", F.col("k").alias("i"), F.col("mean").alias("mx"))
    right = centre.select("dataset", F.col("k").alias("j"), F.col("mean").alias("my"))
    # one row per data set and column name
    return out.join(F.broadcast(left), ["dataset", "i"]).join(F.broadcast(right), ["dataset", "j"])


def gram(products: DataFrame, columns) -> DataFrame:
    """Uncentred second moments: sum of x_i * x_j for every pair i <= j, with those of the two columns as ``xx`` and ``yy``."""
    xy = (F.col("sxy") + F.col("mx") * F.col("sy") + F.col("my") * F.col("sx")
          + F.col("n") * F.col("mx") * F.col("my"))
    return products.select("dataset", _name(columns, "i").alias("feature_1"), _name(columns, "j").alias("feature_2"),
                           F.col("n").cast("long").alias("n"), xy.alias("xy"), _square("x").alias("xx"), _square("y").alias("yy"))


def _square(x: str):
    return F.col(f"s{x}{x}") + 2 * F.col(f"m{x}") * F.col(f"s{x}") + F.col("n") * F.col(f"m{x}") * F.col(f"m{x}")


def correlations(products: DataFrame, columns) -> DataFrame:
    """Pearson correlation of every ordered pair of different columns; NULL where one is constant."""
    n = F.col("n")
    cov = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n)
    vx = F.col("sxx") - F.try_divide(F.col("sx") * F.col("sx"), n)
    vy = F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), n)
    r = F.try_divide(cov, F.sqrt(F.when((vx > 0) & (vy > 0), vx * vy)))
    upper = products.where("i < j").select("dataset", _name(columns, "i").alias("feature_1"),
                                           _name(columns, "j").alias("feature_2"), r.alias("correlation"))
    lower = upper.select("dataset", F.col("feature_2").alias("feature_1"), F.col("feature_1").alias("feature_2"),
                         "correlation")
    return upper.unionByName(lower)


def corr_long(df: DataFrame, columns) -> DataFrame:
    """Correlations in long form, strongest first."""
    columns = list(columns)
    out = correlations(cross_products(df, columns), columns)
    return out.orderBy("dataset", F.desc(F.abs("correlation")), "feature_1", "feature_2")


def corr_matrix(df: DataFrame, columns) -> DataFrame:
    """One row per data set and feature, one column per feature; 1 on the diagonal."""
    columns = list(columns)
    products = cross_products(df, columns)
    own = products.where("i = j").select(
        "dataset", _name(columns, "i").alias("feature_1"), _name(columns, "i").alias("feature_2"),
        F.when(F.col("sxx") > 0, F.lit(1.0)).alias("correlation"))
    rows = correlations(products, columns).unionByName(own)
    return rows.groupBy("dataset", F.col("feature_1").alias("feature")).pivot("feature_2", columns).agg(
        F.first("correlation"))


def vif_from_products(sums: np.ndarray, sx: np.ndarray, n: float, means: np.ndarray, tol: float = 1e-10) -> np.ndarray:
    """VIF of each column regressed on the others without an added constant, from centred cross products.

    ``sums`` is the centred matrix. If the other columns span a constant (as dummies that add up to one do),
    the total sum of squares is centred. A column that the others determine exactly gets infinity.
    """
    k = len(means)
    centred = sums - np.outer(sx, sx) / n
    mean = means + sx / n
    raw = centred + n * np.outer(mean, mean)
    full = np.empty((k + 1, k + 1))  # with the constant column last
    full[:k, :k], full[k, :k], full[:k, k], full[k, k] = raw, n * mean, n * mean, n
    scale = np.sqrt(np.diag(full))
    scale[scale == 0] = 1.0
    full = full / np.outer(scale, scale)
    # One factorisation serves all columns. Regressing column i on the others leaves 1 / inverse[i, i] of its norm, unless it lies
    # in the span of the others, as it does where a direction without variation involves it.
    values, vectors = np.linalg.eigh(full[:k, :k])
    kept = values > tol * max(1.0, values.max(initial=0.0))
    inverse = vectors[:, kept] / values[kept] @ vectors[:, kept].T
    left = 1.0 / np.maximum(np.diag(inverse), np.finfo(float).tiny)
    left[np.sum(vectors[:, ~kept] ** 2, axis=1) > tol * 10] = 0.0
    # the share of the constant that the others do not explain: what no column does, and what only column i does
    weights = inverse @ full[:k, k]
    alone = full[k, k] - full[:k, k] @ weights + weights ** 2 * left
    total = np.where((alone < tol * 10) & (k > 1), np.diag(centred), np.diag(raw))
    rest = left * scale[:k] ** 2
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where((rest <= tol * 10 * np.maximum(total, 0.0)) | (total <= 0), np.inf, total / rest)


def vif(df: DataFrame, columns) -> DataFrame:
    """(dataset, feature, vif). The matrix has one row per column name and is inverted on the driver."""
    columns = list(columns)
    rows = cross_products(df, columns).collect()  # columns^2 numbers per data set
    k, out = len(columns), []
    for name in sorted({r["dataset"] for r in rows}):
        sums, sx, means, n = np.zeros((k, k)), np.zeros(k), np.zeros(k), 0.0
        for r in (r for r in rows if r["dataset"] == name):
            sums[r["i"], r["j"]] = sums[r["j"], r["i"]] = r["sxy"]
            if r["i"] == r["j"]:
                sx[r["i"]], means[r["i"]], n = r["sx"], r["mx"], r["n"]
        out += [(name, c, float(v)) for c, v in zip(columns, vif_from_products(sums, sx, n, means))]
    return df.sparkSession.createDataFrame(out, "dataset string, feature string, vif double")
