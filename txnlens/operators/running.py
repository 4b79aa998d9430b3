"""Running aggregates per key that stay parallel when one key holds a large share of the rows.

A plain ``Window.partitionBy(key)`` puts every row of a key in one task. Here the rows of keys with more rows than one
task should sort leave the plain window: they alone are stored, cut by quantiles of the ordering position into as many blocks as
the key needs. Each block is a window of its own, and what came before a block is added from a small table of block totals. All
other rows take the plain window, and when no key is above the limit the plan is just that window.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnlens.sources.writers import materialize

HOT_ROWS = 2_000_000      # rows of one key that a single task may sort
MAX_HOT_KEYS = 20_000     # no more keys than this can exceed total / MAX_HOT_KEYS rows
BLOCK = "__block"

_FOLD = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Split:
    """Rows ready for running aggregates: ``hot`` holds those of the keys that were cut, with the BLOCK column."""

    cold: DataFrame
    keys: tuple
    hot: DataFrame | None = None

    def map(self, change) -> "Split":
        """The same split after a change that keeps the rows: ``change`` takes a frame and returns one."""
        return replace(self, cold=change(self.cold), hot=None if self.hot is None else change(self.hot))

    def clustered(self) -> "Split":
        """One explicit shuffle of each part that serves every window over the keys plus further columns."""
        hot = None if self.hot is None else self.hot.repartition(*self.keys, BLOCK)
        return replace(self, cold=self.cold.repartition(*self.keys), hot=hot)

    def done(self) -> DataFrame:
        return self.cold if self.hot is None else self.cold.unionByName(self.hot.drop(BLOCK))


def hot_keys(df: DataFrame, keys, hot_rows: int = HOT_ROWS, size: Column | None = None):
    """Keys with more rows than one task should hold, as ``(DataFrame of keys and n, largest n, limit)``.

    None when there is none. At most MAX_HOT_KEYS rows: the limit is never below total / MAX_HOT_KEYS.
    ``size`` is the aggregate that counts a key's rows, if not one per row of ``df``.
    """
    counts = df.groupBy(*keys).agg((F.count(F.lit(1)) if size is None else size).alias("n"))
    total, top = counts.agg(F.sum("n"), F.max("n")).first()
    limit = max(hot_rows, (total or 0) // MAX_HOT_KEYS)
    if not top or top <= limit:
        return None
    return counts.where(F.col("n") > limit), top, limit


def split(df: DataFrame, keys, position: Column, hot_rows: int = HOT_ROWS, counted: DataFrame | None = None,
          size: Column | None = None) -> Split:
    """Cut the rows of hot keys into blocks along ``position`` (numeric, rising with the wanted order).

    ``counted`` is a cheaper frame to find the hot keys on: one that holds at least the rows of ``df`` (it
    then gives the block edges too), or one whose aggregate ``size`` estimates a key's rows in ``df``.
    """
    keys = list(keys)
    found = hot_keys(df if counted is None else counted, keys, hot_rows, size)
    if found is None:
        return Split(df, tuple(keys))
    hot, top, limit = found
    # a key of n rows gets about 2 * n / limit blocks, a power of two, so that few lists of shares serve all keys
    classes = max(1, (-(-top // limit) - 1).bit_length())
    grade = F.greatest(F.lit(1), F.ceil(F.log2(F.ceil(F.col("n") / limit)))).cast("int")
    named = F.broadcast(hot.select(*keys, grade.alias("__grade")))  # at most MAX_HOT_KEYS rows, see hot_keys
    source = df if counted is None or size is not None else counted
    cuts = []
    for k in range(1, classes + 1):
        blocks = min(2 << k, MAX_HOT_KEYS)
        shares = [i / blocks for i in range(1, blocks)]
        cuts.append(F.percentile_approx(F.when(F.col("__grade") == k, position), shares, max(10_000, 4 * blocks)))
    edges = source.join(named, keys).groupBy(*keys).agg(F.array_distinct(F.coalesce(*cuts)).alias("__edges"))
    # Two levels of edges: about 2 * sqrt(blocks) comparisons per row instead of blocks.
    edges = edges.withColumn("__step", F.greatest(F.lit(1), F.sqrt(F.size("__edges")).cast("int"))).select(
        *keys, "__step", F.expr("transform(sequence(0, (size(__edges) - 1) div __step), i -> "
                                "slice(__edges, cast(i * __step + 1 as int), __step))").alias("__fine"),
    ).withColumn("__coarse", F.transform("__fine", lambda chunk: chunk[0]))
    p = F.col("__pos")
    chunk = F.size(F.filter("__coarse", lambda e: e < p))
    inside = F.size(F.filter(F.get(F.col("__fine"), chunk - 1), lambda e: e < p))
    block = F.when(chunk == 0, F.lit(0)).otherwise((chunk - 1) * F.col("__step") + inside).cast("int")
    # the edges of all keys together are about 4 * total / limit numbers, and MAX_HOT_KEYS bounds total / limit
    cut = (df.withColumn("__pos", position).join(F.broadcast(edges), keys).withColumn(BLOCK, block)
           .drop("__pos", "__fine", "__coarse", "__step"))
    # block totals and windows each read the hot rows: store them once instead of recomputing what is above
    return Split(df.join(F.broadcast(hot.select(*keys)), keys, "left_anti"), tuple(keys), materialize(cut, "blocks"))


def running(rows: Split, order, aggs: dict, extra_keys=(), exclusive: bool = False,
            totals: dict | None = None) -> Split:
    """Add running aggregates from the key's first row up to the current one (or the one before it).

    ``order``: ascending column names, the first of them rising with the split's position. ``aggs``: output
    name -> (kind, column), kind one of sum, min, max, first (value at the first row, NULL kept) and last
    (latest non-null). ``totals``: the same for whole-key sums, minima and maxima.
    """
    totals = totals or {}
    keys = [*rows.keys, *extra_keys]
    cold = _plain(rows.cold, keys, order, aggs, exclusive, totals)
    return replace(rows, cold=cold, hot=None if rows.hot is None else _blocked(rows.hot, keys, order, aggs, exclusive, totals))


def _windowed(frame: DataFrame, part, order, aggs: dict, exclusive: bool) -> list:
    w = (Window.partitionBy(*part).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow))

    def local(kind, col):
        if kind in _FOLD:
            return _FOLD[kind](col).over(w)
        if kind == "first":
            return F.first(F.struct(col.alias("v"))).over(w)
        return F.last(F.when(col.isNotNull(), F.struct(col.alias("v"))), ignorenulls=True).over(w)

    return [*frame.columns, *[local(k, c).alias(n) for n, (k, c) in aggs.items()]]


def _plain(frame: DataFrame, keys, order, aggs: dict, exclusive: bool, totals: dict) -> DataFrame:
    whole = Window.partitionBy(*keys)
    return frame.select(*_windowed(frame, keys, order, aggs, exclusive)).select(
        *frame.columns,
        *[F.col(n)["v"].alias(n) if aggs[n][0] in ("first", "last") else F.col(n) for n in aggs],
        *[_FOLD[k](c).over(whole).alias(n) for n, (k, c) in totals.items()],
    )


def _blocked(frame: DataFrame, keys, order, aggs: dict, exclusive: bool, totals: dict) -> DataFrame:
    part, kept = [*keys, BLOCK], list(frame.columns)
    out = frame.select(*_windowed(frame, part, order, aggs, exclusive))
    at = F.struct(*order)

    def in_block(kind, col):
        if kind in _FOLD:
            return _FOLD[kind](col)
        if kind == "first":
            return F.min_by(F.struct(col.alias("v")), at)
        return F.max_by(F.when(col.isNotNull(), F.struct(col.alias("v"))), F.when(col.isNotNull(), at))

    # One row per (key, block): the block count per key is bounded by the split, not by the data.
    sums = frame.groupBy(*part).agg(
        *[in_block(k, c).alias(f"__c_{n}") for n, (k, c) in aggs.items()],
        *[_FOLD[k](c).alias(f"__t_{n}") for n, (k, c) in totals.items()],
    )
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)

    def carried(kind, name):
        if kind in _FOLD:
            return _FOLD[kind](name).over(before)
        pick = F.first if kind == "first" else F.last
        return pick(name, ignorenulls=True).over(before)

    sums = sums.select(
        *part,
        *[carried(k, f"__c_{n}").alias(f"__c_{n}") for n, (k, _) in aggs.items()],
        *[_FOLD[k](f"__t_{n}").over(whole).alias(n) for n, (k, _) in totals.items()],
    )

    def merged(name, kind):
        here, past = F.col(name), F.col(f"__c_{name}")
        if kind == "sum":
            return F.coalesce(here + past, here, past).alias(name)
        if kind == "min":
            return F.least(here, past).alias(name)
        if kind == "max":
            return F.greatest(here, past).alias(name)
        both = (past, here) if kind == "first" else (here, past)
        return F.coalesce(*both)["v"].alias(name)

    out = out.join(sums, part, "left")
    return out.select(*kept, *[merged(n, k) for n, (k, _) in aggs.items()], *totals)


def prefix_sums(df: DataFrame, keys, position: str, aggs: dict, totals: dict | None = None,
                hot_rows: int = HOT_ROWS, counted: DataFrame | None = None, size: Column | None = None) -> DataFrame:
    """Cumulative sums per key along a numeric column, ascending, with optional whole-key totals."""
    return running(split(df, keys, F.col(position), hot_rows, counted, size), [position], aggs, totals=totals).done()
