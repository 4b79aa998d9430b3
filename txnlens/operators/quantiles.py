"""Exact order statistics of many groups without moving their values.

A wanted rank is first bracketed: a mergeable sketch of a bounded share of the rows proposes points near it. One pass then counts, in
every group, the values at these points and between them, which tells exactly which point or gap holds the rank; what the sketch
got wrong only makes the gap wider. Gaps shrink by a factor of about ``POINTS / (2 * MARGIN)`` a round, heavy values are points and
leave no gap. Counts are combined before their shuffle, so an exchange carries one number per group and gap. Only gaps that hold
no more than ``LEAST`` rows of a group are read value by value.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKETCHED = 50_000  # about so many rows of the largest gap are sketched
POINTS = 200       # equal shares of a sketch
MARGIN = 4         # points proposed on each side of a rank
LEAST = 2_000      # rows of a gap that are read value by value
_TOP = sys.float_info.max


@dataclass
class Gap:
    """The values of one group strictly between two numbers: how many are below them, how many there are, and the ranks in them."""

    low: float
    high: float
    before: int
    n: int
    ranks: list = field(default_factory=list)


def edges_below(rows: DataFrame, keep, most: int) -> DataFrame:
    """(keep..., slot): how many of ``edges`` (sorted, at most ``most``) are below ``value``.

    A halving search written as one projection per step: a few comparisons whatever the number of edges, in
    code small enough to be compiled.
    """
    kept = list(dict.fromkeys([*keep, "value", "edges"]))
    found = F.lit(0)
    step = 1 << max(0, most.bit_length() - 1)
    while step:
        up = F.coalesce(F.col("value") > F.get(F.col("edges"), found + (step - 1)), F.lit(False))
        rows = rows.select(*kept, (found + F.when(up, step).otherwise(0)).alias("slot"))
        found, step = F.col("slot"), step // 2
    return rows.select(*keep, "slot")


def _placed(values: DataFrame, keys, edges: dict, keep=()) -> DataFrame:
    """(keys..., keep..., slot) of the rows whose group has edges. One row of edges per group is broadcast."""
    schema = T.StructType([*values.select(*keys).schema, T.StructField("edges", T.ArrayType(T.DoubleType()))])
    table = values.sparkSession.createDataFrame([(*key, [float(x) for x in e]) for key, e in edges.items()], schema)
    return edges_below(values.join(F.broadcast(table), keys), [*keys, *keep], max(map(len, edges.values())))


def _below(x: float) -> float:
    return float(np.nextafter(x, -np.inf))


def _bounds(gaps: dict) -> dict:
    """Edges by group such that slot 2 * i + 1 is the i-th gap."""
    return {key: [e for g in found for e in (g.low, _below(g.high))] for key, found in gaps.items()}


def _sketches(values: DataFrame, keys, gaps: dict, sketched: int) -> dict:
    """{(key, number of the gap): its points at equal shares}, of a sample that follows the largest gap."""
    share = min(1.0, sketched / max(g.n for found in gaps.values() for g in found))
    inside = _placed(values, keys, _bounds(gaps), ["value"]).where("slot % 2 = 1")
    some = inside if share == 1.0 else inside.sample(False, share, 17)
    shares = [i / POINTS for i in range(POINTS + 1)]
    rows = some.groupBy(*keys, "slot").agg(F.percentile_approx("value", shares, 4 * POINTS).alias("points")).collect()
    return {(tuple(r[k] for k in keys), r["slot"] // 2): r["points"] for r in rows}


def _proposed(gap: Gap, points) -> list[float]:
    chosen = set()
    for rank in gap.ranks:
        place = (rank - gap.before) / max(1, gap.n - 1) * POINTS
        low, high = int(place) - MARGIN, int(np.ceil(place)) + MARGIN
        chosen.update(points[max(0, low):high + 1])
    return sorted(p for p in chosen if gap.low < p < gap.high)


def _narrowed(values: DataFrame, keys, gaps: dict, sketched: int, found: dict) -> dict:
    """The gaps after one round; ranks that fall on a point are entered in ``found``."""
    sketches = _sketches(values, keys, gaps, sketched)
    points = {(key, i): _proposed(g, sketches.get((key, i), ())) for key, of in gaps.items() for i, g in enumerate(of)}
    edges = {key: [e for i, g in enumerate(of) for e in (g.low, *(x for p in points[key, i] for x in (_below(p), p)), _below(g.high))]
             for key, of in gaps.items()}
    counted = _placed(values, keys, edges).groupBy(*keys, "slot").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {(tuple(r[k] for k in keys), r["slot"]): r["n"] for r in counted}
    left: dict = {}
    for key, of in gaps.items():
        slot = 0
        for i, gap in enumerate(of):
            inner, before = points[key, i], gap.before
            for j in range(2 * len(inner) + 1):
                slot += 1
                n = counts.get((key, slot), 0)
                ranks = [r for r in gap.ranks if before <= r < before + n]
                if j % 2:
                    found[key].update(dict.fromkeys(ranks, inner[j // 2]))
                elif ranks:
                    low, high = [gap.low, *inner][j // 2], [*inner, gap.high][j // 2]
                    left.setdefault(key, []).append(Gap(low, high, before, n, ranks))
                before += n
            slot += 1
    return left


def _selected(values: DataFrame, keys, gaps: dict, found: dict) -> None:
    """Enter the values at the ranks of gaps that hold few rows each."""
    inside = _placed(values, keys, _bounds(gaps), ["value"]).where("slot % 2 = 1")
    schema = T.StructType([*values.select(*keys).schema, T.StructField("slot", T.IntegerType()),
                           T.StructField("ranks", T.ArrayType(T.LongType()))])
    wanted = values.sparkSession.createDataFrame(
        [(*key, 2 * i + 1, [r - g.before for r in g.ranks]) for key, of in gaps.items() for i, g in enumerate(of)], schema)
    upto = F.sum("n").over(Window.partitionBy(*keys, "slot").orderBy("value"))
    runs = inside.groupBy(*keys, "slot", "value").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto)
    runs = runs.join(F.broadcast(wanted), [*keys, "slot"]).withColumn("here", F.expr("filter(ranks, r -> r >= upto - n AND r < upto)"))
    for r in runs.where("size(here) > 0").select(*keys, "slot", "value", "here").collect():
        key = tuple(r[k] for k in keys)
        before = gaps[key][r["slot"] // 2].before
        found[key].update({before + rank: r["value"] for rank in r["here"]})


def order_statistics(values: DataFrame, keys, wanted, sketched: int = SKETCHED, least: int = LEAST) -> dict:
    """{key tuple: (rows, {rank: value})} of ``value`` (double) per key, ranks from 0; ``wanted(n)`` lists the ranks for ``n`` rows.

    Meant for few keys, such as data sets and features. Nulls and NaN take no part, infinite values count as the largest finite
    ones; an empty table gives no key.
    """
    keys = list(keys)
    values = values.where(F.col("value").isNotNull() & ~F.isnan("value")).select(
        *keys, F.greatest(F.least("value", F.lit(_TOP)), F.lit(-_TOP)).alias("value"))
    ends = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    found, gaps, small, rows = {}, {}, {}, {}
    for r in ends.collect():
        key, ranks = tuple(r[k] for k in keys), sorted(set(wanted(r["n"])))
        rows[key] = r["n"]
        found[key] = dict.fromkeys(ranks, r["low"]) if r["low"] == r["high"] else {}
        if not found[key]:
            gaps[key] = [Gap(_below(r["low"]), float(np.nextafter(r["high"], np.inf)), 0, r["n"], ranks)]
    while gaps:
        for key, of in gaps.items():
            small.setdefault(key, []).extend(g for g in of if g.n <= least)
        gaps = {key: large for key, of in gaps.items() if (large := [g for g in of if g.n > least])}
        if gaps:
            gaps = _narrowed(values, keys, gaps, sketched, found)
    small = {key: sorted(of, key=lambda g: g.before) for key, of in small.items() if of}
    if small:
        _selected(values, keys, small, found)
    return {key: (rows[key], at) for key, at in found.items()}


def quantiles(values: DataFrame, keys, shares, **how) -> dict:
    """{key tuple: [value at each share]}, interpolated between the two neighbouring ranks."""
    def places(n):
        return [(n - 1) * s for s in shares]

    def wanted(n):
        return {int(f(p)) for p in places(n) for f in (np.floor, np.ceil)}

    return {key: [_between(at[int(np.floor(p))], at[int(np.ceil(p))], p - np.floor(p)) for p in places(n)]
            for key, (n, at) in order_statistics(values, keys, wanted, **how).items()}


def _between(low: float, high: float, t: float) -> float:
    """Interpolated from the nearer end."""
    return high - (high - low) * (1 - t) if t >= 0.5 else low + (high - low) * t
