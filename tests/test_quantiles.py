"""Exact order statistics against sorted values, with narrow sketches that make many rounds and wrong brackets."""

import random

import numpy as np
import pytest

from txnlens.operators import quantiles as Q


def groups():
    rng = random.Random(3)
    return {
        "even": [rng.random() for _ in range(900)],
        "far": [10.0 ** rng.randrange(-300, 300) * rng.choice([-1, 1]) for _ in range(700)],
        "ties": [0.0] * 800 + [float(rng.randrange(5)) for _ in range(300)] + [0.1 + rng.random() / 1e9 for _ in range(200)],
        "dummy": [0.0] * 333 + [1.0] * 667,
        "one": [7.0], "same": [-0.5] * 50, "next": [1.0, float(np.nextafter(1.0, 2))] * 40, "few": [3.0, 1.0, 2.0],
    }


@pytest.fixture(scope="module")
def values(spark):
    rows = [(k, 1, v) for k, of in groups().items() for v in of] + [("even", 1, None), ("even", 1, float("nan"))]
    return spark.createDataFrame(rows, "name string, part int, value double").repartition(5).cache()


@pytest.mark.parametrize("points,margin,least,sketched", [(200, 4, 2000, 50_000), (200, 4, 30, 50_000), (8, 1, 5, 40), (4, 1, 1, 10**6), (16, 1, 2, 3)])
def test_equal_sorted_values(values, monkeypatch, points, margin, least, sketched):
    monkeypatch.setattr(Q, "POINTS", points)
    monkeypatch.setattr(Q, "MARGIN", margin)
    shares = [i / 10 for i in range(11)] + [0.333, 0.99]
    got = Q.quantiles(values, ["name", "part"], shares, least=least, sketched=sketched)
    assert {k for k, _ in got} == set(groups())
    for (name, _), found in got.items():
        want = np.quantile(np.array(groups()[name]), shares)
        assert np.allclose(found, want, rtol=1e-12, atol=0 if name == "far" else 1e-15), name


def test_every_rank(values, monkeypatch):
    monkeypatch.setattr(Q, "POINTS", 10)
    found = Q.order_statistics(values.where("name IN ('ties', 'far')"), ["name"], lambda n: range(0, n, 7), least=3, sketched=100)
    for (name,), (n, at) in found.items():
        want = sorted(groups()[name])
        assert n == len(want) and at == {r: want[r] for r in range(0, n, 7)}


def test_infinite_values_and_empty_tables(spark, values):
    df = spark.createDataFrame([("a", float("inf")), ("a", 1.0), ("a", float("-inf"))], "name string, value double")
    assert Q.quantiles(df, ["name"], [0, 0.5, 1], least=1)["a",] == [-Q._TOP, 1.0, Q._TOP]
    assert Q.quantiles(values.where("false"), ["name"], [0.5]) == {}


def test_values_are_not_exchanged(spark, values, monkeypatch):
    """Rows that a shuffle carries while brackets narrow: one per task, group and slot."""
    seen = []
    collect = type(values).collect
    monkeypatch.setattr(type(values), "collect", lambda df: seen.append(df) or collect(df))
    Q.quantiles(values, ["name"], [0, 0.25, 0.5, 1], least=1, sketched=10**6)
    monkeypatch.undo()
    for df in seen[:-1]:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate [name" in plan and "Window" not in plan and "value" not in plan.split("Aggregate [")[1].split("]")[0]
    assert len(seen) > 3
