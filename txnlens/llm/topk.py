"""Exact top-k inner products with block-at-a-time pruning.

Vectors are ordered by the signs of their leading components and by key, and cut into ranges of GROUP vectors, each of them
into blocks of BLOCK. A block's term maxima and minima bound its score for a query: per component the larger of the two
products, summed. Within a range each query visits the blocks by falling bound, scores a block against its rows (the forward
index), and stops once the next bound is below its current k-th score. The first k-th score comes from a bounded set of seed
vectors that every query scores beforehand, so that the ranges, which run in parallel, all prune from the start.

Scores are exact: products are summed in doubles while they stay below 2**53, as whole numbers otherwise.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlens.llm.common import batch_rows, smallest_by_hash, stored

K = 10
BLOCK = 64
GROUP = 4096
QUERIES = 512
SEEDS = 2048  # vectors that give every query its first bound; they change the work, never the result
SIGNS = 12
_LONG = (-(1 << 63), (1 << 63) - 1)


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole-numbered doubles; exact, as objects where 2**53 may be passed."""
    if not len(queries) or not len(rows):
        return np.zeros((len(queries), len(rows)))
    if queries.shape[1] * np.abs(queries).max() * np.abs(rows).max() < 2 ** 53:
        return queries @ rows.T
    whole = np.vectorize(int, otypes=[object])
    return whole(queries).dot(whole(rows).T)


def block_bounds(queries: np.ndarray, rows: np.ndarray, block: int) -> np.ndarray:
    """(query, block): an upper bound of the scores in each block."""
    starts = np.arange(0, len(rows), block)
    high, low = np.maximum.reduceat(rows, starts, axis=0), np.minimum.reduceat(rows, starts, axis=0)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    bound = up @ high.T + down @ low.T
    return bound + np.abs(bound) * 1e-12  # never below the true sum, whatever the rounding


def best_of(scores, keys, own, k):
    """Positions of the k best columns of one row of scores: highest first, ties to the smaller key; ``own`` is left out."""
    at = np.flatnonzero(own)
    if len(at) > k:
        top = scores[at]
        least = np.partition(top, len(top) - k)[len(top) - k] if top.dtype != object else sorted(top)[-k]
        at = at[top >= least]
    return at[np.lexsort((keys[at], -scores[at]))][:k] if scores.dtype != object else np.array(
        sorted(at.tolist(), key=lambda i: (-scores[i], keys[i]))[:k], np.int64)


def search(queries, query_rows, floor, rows, keys, row_ids, k, block=BLOCK):
    """Yields (query, key, score) of every candidate of this range that can be among a query's k best.

    ``floor`` holds a score that each query's k-th best is known to reach (-inf if none).
    """
    bounds = block_bounds(queries, rows, block)
    visit = np.argsort(-bounds, axis=1, kind="stable")
    kept = [(np.empty(0), np.empty(0, np.int64)) for _ in queries]
    kth = floor.astype(float).copy()
    for step in range(bounds.shape[1]):
        now = visit[:, step]
        open_ = np.flatnonzero(bounds[np.arange(len(now)), now] >= kth)
        if not len(open_):
            break
        for b in np.unique(now[open_]):
            asking = open_[now[open_] == b]
            a, z = b * block, min((b + 1) * block, len(rows))
            scores = products(queries[asking], rows[a:z])
            for q, own_scores in zip(asking.tolist(), scores, strict=True):
                wanted = (row_ids[a:z] != query_rows[q]) & (own_scores >= kth[q])
                if not wanted.any():
                    continue
                s = np.concatenate([kept[q][0], own_scores[wanted]])
                n = np.concatenate([kept[q][1], np.arange(a, z)[wanted]])
                top = best_of(s, keys[n], np.ones(len(s), bool), k)
                kept[q] = s[top], n[top]
                if len(top) == k:
                    kth[q] = max(kth[q], float(s[top[-1]]))
    for q, (s, n) in enumerate(kept):
        for score, i in zip(s.tolist(), n.tolist(), strict=True):
            yield q, int(keys[i]), min(max(int(score), _LONG[0]), _LONG[1])


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(key, row, dim, v): components as floor(scale * x), of the vectors that take part; stored, so ``row`` is stable."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    v = F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    good = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & finite)
    slim = good.select(F.col(id_col).cast("long").alias("key"), v.alias("v"))
    return stored(slim.select("key", F.monotonically_increasing_id().alias("row"), F.size("v").alias("dim"), "v"), "vectors")


def packed(vectors: DataFrame, size: int) -> DataFrame:
    """(dim, keys, rows, matrix): up to ``size`` consecutive vectors of one length in a row, as binary columns."""

    def run(batches):
        held, count = [], 0

        def flush():
            frame = pd.concat(held, ignore_index=True)
            values = np.concatenate(frame["v"].to_list()).astype("<f8")
            return pa.RecordBatch.from_pydict(
                {"dim": pa.array([frame["dim"].iat[0]], pa.int32()), "keys": pa.array([frame["key"].to_numpy("<i8").tobytes()], pa.binary()),
                 "rows": pa.array([frame["row"].to_numpy("<i8").tobytes()], pa.binary()), "matrix": pa.array([values.tobytes()], pa.binary())})

        for batch in batches:
            frame = batch.to_pandas()
            while len(frame):
                same = frame["dim"].to_numpy() == (held[0]["dim"].iat[0] if held else frame["dim"].iat[0])
                n = min(size - count, len(same) if same.all() else int(same.argmin()))
                if n:
                    held.append(frame.iloc[:n])
                    count += n
                    frame = frame.iloc[n:]
                if count == size or not n:
                    yield flush()
                    held, count = [], 0
        if held:
            yield flush()

    return vectors.select("key", "row", "dim", "v").mapInArrow(run, "dim int, keys binary, rows binary, matrix binary")


def top_k(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
          scale: int = 1024, group: int = GROUP, batch: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query`` (a condition on ``id_col``) its k best other rows.

    Rows with a null key, a null or empty vector, or a null or non-finite component take no part; only vectors of one length
    are compared. Equal keys are rows of their own. Components and scores beyond the range of a long are set to its ends.
    An empty table gives no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = scaled(vectors, id_col, vector_col, scale)
    signs = sum((F.when(F.get("v", F.lit(i)) >= 0, F.lit(1 << i)).otherwise(0) for i in range(SIGNS)), F.lit(0))
    ranges = rows.withColumn("signs", signs).repartitionByRange("dim", "signs", "key").sortWithinPartitions("dim", "signs", "key")
    with batch_rows(spark, 1024):
        blocks = stored(packed(ranges, group), "vector-ranges")
    asked = rows.where(is_query(F.col("key")))
    batches = packed(asked.repartition("dim", F.pmod(F.xxhash64("row"), F.lit(1 << 30))).sortWithinPartitions("dim"), batch)
    with batch_rows(spark, 1024):
        batches = stored(batches, "query-batches")
    batches = seeded(batches, rows, k)
    # every query batch meets every range: ranges are dealt evenly, batches (a fixed share of the rows) copied to each deal
    deals = max(1, min(blocks.count(), 4 * spark.sparkContext.defaultParallelism))
    left = blocks.withColumn("deal", F.pmod(F.xxhash64("keys", "rows"), F.lit(deals)).cast("int"))
    right = batches.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1)))).withColumnsRenamed(
        {"keys": "q_keys", "rows": "q_rows", "matrix": "q_matrix"})

    def run(frames):
        for frame in frames:
            for r in frame.itertuples(index=False):
                q = np.frombuffer(r.q_matrix, "<f8").reshape(-1, r.dim)
                m = np.frombuffer(r.matrix, "<f8").reshape(-1, r.dim)
                keys, own, q_rows = (np.frombuffer(x, "<i8") for x in (r.keys, r.rows, r.q_rows))
                found = list(search(q, q_rows, np.frombuffer(r.floor, "<f8"), m, keys, own, k))
                q_keys = np.frombuffer(r.q_keys, "<i8")
                at = [f[0] for f in found]
                yield pd.DataFrame({"query_id": q_keys[at], "q_row": q_rows[at], "vec_id": [f[1] for f in found],
                                    "score": [f[2] for f in found]})

    met = left.join(right, ["deal", "dim"]).drop("deal").mapInPandas(run, "query_id long, q_row long, vec_id long, score long")
    with batch_rows(spark, 8):  # rows of this join hold whole ranges
        met = stored(met, "met-scores")
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def seeded(batches: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """``batches`` with ``floor``: for each query the k-th best score among the seeds, -inf where there are too few."""
    seeds = smallest_by_hash(rows, "row", SEEDS).collect()  # at most SEEDS rows
    by_dim: dict[int, tuple] = {}
    for dim in {r["dim"] for r in seeds}:
        mine = [r for r in seeds if r["dim"] == dim]
        by_dim[dim] = np.array([r["v"] for r in mine], float), np.array([r["row"] for r in mine])

    @F.pandas_udf("binary")
    def floor(dim: pd.Series, own: pd.Series, matrix: pd.Series) -> pd.Series:
        out = []
        for d, ids, data in zip(dim, own, matrix, strict=True):
            q = np.frombuffer(data, "<f8").reshape(-1, d)
            low = np.full(len(q), -np.inf)
            if d in by_dim:
                scores = products(q, by_dim[d][0]).astype(float)
                scores[np.frombuffer(ids, "<i8")[:, None] == by_dim[d][1][None, :]] = -np.inf
                if scores.shape[1] >= k:
                    low = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
                    low = low - np.abs(low) * 1e-12
            out.append(low.astype("<f8").tobytes())
        return pd.Series(out)

    return batches.withColumn("floor", floor("dim", "rows", "matrix"))
