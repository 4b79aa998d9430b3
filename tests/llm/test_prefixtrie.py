"""The prefix trie against a plain trie in Python, split at components of one task's size and far below."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlens.llm import prefixtrie

EXTRA = ("node", "parent", "d", "w", "comp", "total", "leaves", "tokens", "j", "part", "size", "g", "next")


def brute(rows):
    turns, members = {}, {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for found in turns.values():
        found.sort()
    built = {}
    for conv in turns:
        head = zlib.crc32(str(conv).encode()) % 9
        built[conv] = tuple(t[2:] for t in turns.get(conv - conv % 5, [])[:head] + turns[conv][head:])
        for d in range(len(built[conv]) + 1):
            members.setdefault(built[conv][:d], []).append(conv)
    children = {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        below = children.get(prefix, [])
        leaves[prefix] = sum(leaves[c] for c in below) or 1
        saved[prefix] = sum(saved[c] for c in below) + (len(members[prefix]) - 1) * (len(prefix[-1][1].encode()) if prefix else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(children.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumns({c: F.lit(None).cast("string") for c in EXTRA})


def result(spark, rows, **settings):
    found = prefixtrie.prefix_trie(frame(spark, rows), **settings)
    return sorted(tuple(r) for r in found.withColumn("parent_conv_id", F.coalesce("parent_conv_id", F.lit(-1))).collect())


def conversations(seed, n):
    """Few texts, so prefixes are shared; one very long conversation, a group of equal ones, and awkward rows."""
    rng, rows = random.Random(seed), []
    for conv in range(n):
        rows += [(conv, turn, "user", rng.choice(["a", "a", "é", None, "a longer text"])) for turn in range(rng.randrange(12))]
    for conv in range(1000, 1040):
        rows += [(conv, turn, "user", f"same {turn}") for turn in range(6)]
    rows += [(2000, turn, "assistant", f"step {turn}") for turn in range(300)]
    rows += [(2003, turn, "assistant", f"step {turn}") for turn in range(100)]
    rows += [(7, None, "user", "first"), (7, None, "user", "first"), (7, 3, None, None), (8, 1, "x", "tie"), (8, 1, "a", "tie"),
             (None, 1, "user", "no conversation"), (3004, 0, "user", "alone"), (3010, 0, "", ""), (10**17, 0, "user", "far")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [12, 200, 10**6])
def test_equals_plain_trie(spark, limit, monkeypatch):
    monkeypatch.setattr(prefixtrie, "BLOCK", 7)
    monkeypatch.setattr(prefixtrie, "IDS", 3)
    rows = conversations(1, 60)
    got, want = result(spark, rows, limit=limit), brute(rows)
    assert [x for x in got if x not in want][:2] == [] and got == want


def test_empty_tables_and_turnless_conversations(spark):
    assert result(spark, []) == [] == result(spark, [(None, 1, "user", "x")])
    turnless = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)
    got = result(spark, [(turnless, 0, "user", "taken by a head that is absent")])
    assert got == brute([(turnless, 0, "user", "x")]) and got[0][:4] == (turnless, 0, -1, 1)


@pytest.mark.parametrize("shape", ["path", "star", "random", "forest"])
def test_forest_is_split_in_few_rounds(shape):
    rng, n = random.Random(4), 3000
    parent = np.array([-1] + [{"path": i - 1, "star": 0, "random": rng.randrange(i),
                               "forest": -1 if i % 50 == 0 else rng.randrange(i - i % 50, i)}[shape] for i in range(1, n)])
    values = np.array([[rng.randrange(10**15), 1] for _ in range(n)], np.int64)
    depth = np.zeros(n, np.int64)
    for i in range(n):
        depth[i] = 0 if parent[i] < 0 else depth[parent[i]] + 1
    order = np.argsort(depth, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    parent, values = np.array([place[p] if p >= 0 else -1 for p in parent[order]]), values[order]
    want, weight = values.copy(), np.array([rng.randrange(1, 5) for _ in range(n)])
    for i in range(n - 1, -1, -1):
        if parent[i] >= 0:
            want[parent[i]] += want[i]
            weight[parent[i]] += weight[i]
    rounds = []
    unique = np.unique

    class Counted:
        def __getattr__(self, name):
            return getattr(np, name)

        def unique(self, x):
            rounds.append(len(x))
            return unique(x)

    original, prefixtrie.np = prefixtrie.np, Counted()
    try:
        got = prefixtrie.split_forest(parent, weight, values)
    finally:
        prefixtrie.np = original
    assert np.array_equal(got, want) and len(rounds) <= 1 + np.log2(weight.max())
