"""Exact top-k and tool-call linking against brute force."""

import json
import math

import numpy as np
import pytest

from txnlens.llm import toolcalls, topk


def _brute_top(rows, k):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, (key, v) in enumerate(good):
        if key % 2:
            continue
        found = [(-sum(a * b for a, b in zip(v, w, strict=True)), other) for c, (other, w) in enumerate(good) if c != q and len(w) == len(v)]
        out += [(key, r + 1, other, -s) for r, (s, other) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.mark.parametrize("size,scale", [(6, 1.0), (150, 1.0), (60, 1e5)])
def test_top_k(spark, size, scale):
    rng = np.random.default_rng(size)
    rows = [(i, (scale * rng.normal(size=8)).tolist()) for i in range(size)]
    rows += [(size + i, [0.5] * 8) for i in range(20)]  # ties
    rows += [(3, [0.25] * 8), (4, [0.25] * 8), (4, [0.5] * 8), (None, [1.0] * 8), (1000, None), (1002, []), (1004, [None] + [1.0] * 7),
             (1006, [float("nan")] + [1.0] * 7), (1008, [float("inf")] * 8), (1010, [1.0, 2.0]), (1012, [2.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS v", "2 AS row", "3 AS key", "4 AS dim")
    got = topk.top_k(table, lambda key: key % 2 == 0, group=32, batch=7).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == _brute_top(rows, 10)


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, lambda key: key % 100 == 0).isEmpty()


def test_bounds_hold():
    rng = np.random.default_rng(1)
    q, rows = rng.integers(-50, 50, (9, 5)).astype(float), rng.integers(-50, 50, (70, 5)).astype(float)
    bounds = topk.block_bounds(q, rows, 16)
    for b in range(bounds.shape[1]):
        assert (bounds[:, b] >= (q @ rows[16 * b:16 * b + 16].T).max(axis=1)).all()


SCHEMA = {"type": "object", "required": ["city"], "additionalProperties": False,
          "properties": {"city": {"type": "string", "minLength": 2}, "days": {"type": "integer", "minimum": 1, "maximum": 9},
                         "kind": {"enum": ["a", "b"]}, "tags": {"type": "array", "items": {"type": "string"}, "maxItems": 2}}}


@pytest.mark.parametrize("text,n", [('{"city":"Rome"}', 0), ('{"city":"R"}', 1), ('{"days":0}', 2), ('{"city":"Rome","x":1}', 1), ("[]", 1),
                                    ('{"city":"Rome","days":true}', 1), ('{"city":"Rome","days":3.0}', 0), ('{"city":"Rome","kind":"c"}', 1),
                                    ('{"city":"Rome","tags":["a",1,"c"]}', 2), ("{", 1), (None, 1), ("null", 1)])
def test_schema(text, n):
    assert len(toolcalls.check(text, SCHEMA)[1]) == n


def test_canonical():
    assert toolcalls.canonical({"b": [1, 2.5, None], "a": {"é": "x\n"}}) == '{"a":{"é":"x\\n"},"b":[1,2.5,null]}'
    assert toolcalls.check(' { "b":1,\n"a":2 } ', None) == ('{"a":2,"b":1}', ["$: unknown tool"])


def _linked(spark, calls, results):
    c = spark.createDataFrame(calls, "conv_id long, call_id string, position long, name string, arguments string, depends_on array<string>")
    r = spark.createDataFrame(results, "conv_id long, call_id string, content string").selectExpr("*", "1 AS conv", "2 AS wave")
    return toolcalls.link(c.selectExpr("*", "1 AS conv", "2 AS wave", "3 AS content"), r, {"weather": SCHEMA}).collect()


def test_link(spark):
    good = '{"city":"Rome"}'
    calls = [(1, "a", 5, "weather", good, ["b"]), (1, "b", 6, "weather", good, ["c"]), (1, "c", 7, "weather", good, None),
             (1, "d", 8, "weather", '{"city":1}', ["a", "zz"]), (2, "a", 0, "other", good, ["b"]), (2, "b", 1, "weather", good, ["a"]),
             (3, "a", 0, "weather", "{", []), (3, "a", 1, "weather", good, []), (None, "a", 0, "weather", good, ["a"]),
             (4, None, None, None, None, None)]
    results = [(1, "a", "sunny"), (1, "a", "rain"), (1, "q", "lost"), (3, "a", None), (None, "a", "no")]
    out = {(r.conv_id, r.call_id, r.position): r for r in _linked(spark, calls, results)}
    assert len(out) == len(calls)
    waves = {k[1]: r.wave for k, r in out.items() if k[0] == 1}
    order = sorted("abcd", key=lambda x: (waves[x], "abcd".index(x)))
    assert order.index("c") < order.index("b") < order.index("a") < order.index("d")
    assert out[(1, "a", 5)].n_results == 2 and json.loads(out[(1, "a", 5)].message)["result"] == "rain"
    assert out[(1, "d", 8)].missing_deps == 1 and not out[(1, "d", 8)].valid and not out[(1, "d", 8)].cyclic
    assert out[(2, "a", 0)].cyclic and out[(2, "b", 1)].cyclic and out[(2, "a", 0)].errors == ["$: unknown tool"]
    assert out[(3, "a", 0)].n_calls == 2 and json.loads(out[(3, "a", 0)].message)["arguments"] is None
    assert out[(None, "a", 0)].n_results == 0 and out[(4, None, 0)].wave == 0
    assert out[(1, "c", 7)].message == '{"arguments":{"city":"Rome"},"id":"c","name":"weather","result":null}'


def test_link_of_nothing(spark):
    assert _linked(spark, [], []) == []
