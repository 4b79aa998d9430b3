import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txnlens.operators import running as R


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    n = 300
    pdf = pd.DataFrame({
        "k": rng.choice(["hot", "a", "b", "c"], n, p=[0.6, 0.2, 0.15, 0.05]),
        "g": rng.choice(["x", "y"], n), "p": rng.integers(0, 60, n), "id": np.arange(n),
        "v": np.where(rng.random(n) < 0.2, np.nan, rng.random(n).round(3)),
    })
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    return pdf.sort_values(["k", "p", "id"], ignore_index=True), df


def brute(pdf, keys, exclusive):
    out = []
    for _, part in pdf.groupby(keys, sort=False):
        for i in range(len(part)):
            seen = part.iloc[: i + (0 if exclusive else 1)]
            v = seen["v"].dropna()
            out.append((
                int(part["id"].iloc[i]), float(v.sum()) if len(v) else None, v.min() if len(v) else None,
                v.max() if len(v) else None, seen["v"].iloc[0] if len(seen) and seen["v"].iloc[0] == seen["v"].iloc[0] else None,
                v.iloc[-1] if len(v) else None))
    return sorted(out)


@pytest.mark.parametrize("hot_rows", [10 ** 6, 20, 3])
@pytest.mark.parametrize("extra", [[], ["g"]])
@pytest.mark.parametrize("exclusive", [False, True])
def test_running_matches_brute_force(rows, hot_rows, extra, exclusive):
    pdf, df = rows
    s = R.split(df, ["k"], F.col("p"), hot_rows)
    assert (s.hot is not None) == (hot_rows < 1000)
    aggs = {"s": ("sum", F.col("v")), "lo": ("min", F.col("v")), "hi": ("max", F.col("v")),
            "f": ("first", F.col("v")), "l": ("last", F.col("v"))}
    got = R.running(s, ["p", "id"], aggs, extra_keys=extra, exclusive=exclusive).done().select("id", *aggs).collect()
    want = brute(pdf, ["k", *extra], exclusive)
    for g, w in zip(sorted(tuple(r) for r in got), want):
        assert g[0] == w[0]
        for a, b in zip(g[1:], w[1:]):
            assert (a is None and b is None) or abs(a - b) < 1e-9, (g, w)


def test_blocks_bound_the_rows_of_a_hot_key(rows):
    pdf, df = rows
    s = R.split(df, ["k"], F.col("p"), 30)
    assert s.hot.groupBy("k", R.BLOCK).count().agg(F.max("count")).first()[0] <= 30
    assert s.done().count() == len(pdf) and s.done().columns == df.columns
    # a key gets blocks by its own size, and only its rows leave the plain window
    sizes = pdf.groupby("k").size()
    blocks = {r["k"]: r["n"] for r in s.hot.groupBy("k").agg(F.count_distinct(R.BLOCK).alias("n")).collect()}
    assert set(blocks) == {k for k, n in sizes.items() if n > 30}
    assert all(n / 30 <= blocks[k] <= 4 * -(-n // 30) for k, n in sizes.items() if k in blocks)
    assert blocks["hot"] > blocks["a"]


def test_cold_rows_are_neither_stored_nor_shuffled_twice(rows):
    _, df = rows
    s = R.split(df, ["k"], F.col("p"), 30).clustered()
    one = R.running(s, ["p", "id"], {"a": ("sum", F.lit(1))}, extra_keys=["g"])
    two = R.running(one, ["p", "id"], {"b": ("sum", F.col("a"))})
    plan = two.cold._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "parquet" not in plan
    executed = two.cold._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning(k") <= 2  # the rows, and the counts of hot keys on the broadcast side
    assert two.hot.where("k = 'hot'").count() + two.cold.count() <= len(df.collect())


def test_totals(rows):
    pdf, df = rows
    want = pdf.groupby("k")["id"].sum().to_dict()
    for hot in (10 ** 6, 5):
        out = R.prefix_sums(df.withColumn("pos", F.col("id").cast("double")), ["k"], "pos",
                            {"upto": ("sum", F.col("id"))}, {"total": ("sum", F.col("id"))}, hot)
        assert {r["k"]: r["total"] for r in out.select("k", "total").distinct().collect()} == want
        last = out.groupBy("k").agg(F.max("upto").alias("m")).collect()
        assert {r["k"]: r["m"] for r in last} == want


def test_plain_plan_has_one_exchange(rows):
    _, df = rows
    s = R.split(df, ["k"], F.col("p")).clustered()
    one = R.running(s, ["p", "id"], {"a": ("sum", F.lit(1))}, extra_keys=["g"])
    two = R.running(one, ["p", "id"], {"b": ("sum", F.col("a"))})
    plan = two.cold._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
