"""Quality classifier by co-training of two views.

The content view sees the words of a text, the page view only what is known about the page: its language, source, stored size
and layout. Each view is a logistic regression. Over several rounds each labels the unlabelled pool documents it is sure of
(by its calibrated probability), and the other learns from them. The calibrated views are then combined by a logistic
regression on their log-odds, fitted on labelled documents that neither view has seen. Fitting uses bounded samples; scoring is
one map over all documents.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.llm.common import smallest_by_hash, small_batches, to_bytes
from txnlens.llm.rules import FEATURES, scan

MAX_LABELLED = 4000  # labelled documents used for fitting and calibration
MAX_POOL = 4000  # further documents that pseudo-labels are drawn from
ROUNDS = 4
PER_ROUND = 200  # pseudo-labels a view may give to the other in a round, per class
SURE = 0.97
THRESHOLD = 0.5
BUCKETS = 512  # hashed characters and word shapes of the content view
PAGE_BUCKETS = 64  # hashed languages and sources of the page view

_SHAPE = np.full(256, ord("x"), np.uint8)
_SHAPE[ord("A"):ord("Z") + 1] = ord("X")
_SHAPE[ord("0"):ord("9") + 1] = ord("9")
for _b in b" \t\n\x0b\x0c\r!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
    _SHAPE[_b] = _b
_TRIGRAM = np.uint32(2654435761)


def content_view(text: str | None) -> np.ndarray:
    """Line statistics weighted by words, repetition, and hashed trigrams of character shapes, from the whole text."""
    base, lines, words = scan(text)
    weight = words / max(1, words.sum())
    n = max(1, base[0])
    dense = np.r_[weight @ lines, np.log1p(base[0]) / 10, base[1] / n / 10, min(1.0, base[2] / n), base[3] / len(words), base[4] / n]
    shape = _SHAPE[np.frombuffer(to_bytes(text), np.uint8)].astype(np.uint32)
    grams = np.zeros(BUCKETS)
    if len(shape) > 2:
        keys = ((shape[:-2] << 16 | shape[1:-1] << 8 | shape[2:]) * _TRIGRAM) >> np.uint32(23)
        grams = np.bincount(keys, minlength=BUCKETS)[:BUCKETS] / (len(shape) - 2)
    return np.r_[1.0, dense, np.sqrt(grams)].astype(np.float32)


def page_view(lang, source, n_chars, text: str | None) -> np.ndarray:
    """Language, source, stored size and layout (lines, characters of a line); nulls have buckets of their own."""
    hot = np.zeros(PAGE_BUCKETS)
    hot[zlib.crc32(f"lang={lang}".encode()) % PAGE_BUCKETS] = 1
    hot[zlib.crc32(f"source={source}".encode()) % PAGE_BUCKETS] = 1
    size, lines = float(n_chars or 0), (text or "").count("\n") + 1
    spread = len(text or "") / lines
    cuts = np.array([size < c for c in (200, 1000, 4000, 16000)] + [spread < c for c in (40, 120, 400, 1600)], float)
    return np.r_[1.0, hot, np.log1p(max(0.0, size)) / 10, np.log1p(lines) / 10, np.log1p(spread) / 10, cuts,
                 float(n_chars is None)].astype(np.float32)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, rounds: int = 200) -> np.ndarray:
    """Weights of a logistic regression by accelerated gradient descent; the step follows from the largest curvature."""
    x, y = x.astype(np.float64), y.astype(np.float64)
    v = np.ones(x.shape[1])
    for _ in range(20):
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v) or 1.0
    step = 1 / (0.25 * np.linalg.norm(x @ v) ** 2 / len(x) + l2)
    w = last = np.zeros(x.shape[1])
    for k in range(rounds):
        ahead = w + k / (k + 3) * (w - last)
        last, w = w, ahead - step * (x.T @ (sigmoid(x @ ahead) - y) / len(x) + l2 * ahead)
    return w


class View:
    """A logistic regression with Platt calibration: probability = sigmoid(a * score + b)."""

    def __init__(self, weights, a=1.0, b=0.0):
        self.weights, self.a, self.b = weights, a, b

    def odds(self, x):
        return self.a * (x @ self.weights) + self.b

    @classmethod
    def fit(cls, x, y, held_x, held_y):
        weights = logistic(x, y)
        b, a = logistic(np.stack([np.ones(len(held_y)), held_x @ weights], axis=1), held_y, l2=1e-4, rounds=500)
        return cls(weights, max(a, 0.0), b)


class Model:
    """Two calibrated views and the weights (bias, content, page) that combine their log-odds."""

    def __init__(self, content: View, page: View, mix: np.ndarray, log: list | None = None):
        self.content, self.page, self.mix, self.log = content, page, mix, log or []

    def score(self, content_x, page_x) -> np.ndarray:
        return sigmoid(self.mix[0] + self.mix[1] * self.content.odds(content_x) + self.mix[2] * self.page.odds(page_x))


def co_train(views, y, held_views, held_y, pools, rounds=ROUNDS, per_round=PER_ROUND, sure=SURE) -> Model:
    """``views``, ``held_views``, ``pools``: (content matrix, page matrix) of training, calibration and pool documents."""
    given = [(views[v], y) for v in (0, 1)]  # what each view learns from
    open_ = [np.ones(len(pools[0]), bool) for _ in (0, 1)]
    log = []
    for _ in range(rounds):
        fitted = [View.fit(*given[v], held_views[v], held_y) for v in (0, 1)]
        gifts = [0, 0]
        for v in (0, 1):
            other = 1 - v
            p = sigmoid(fitted[v].odds(pools[v])) if len(pools[v]) else np.empty(0)
            for label, confidence in ((1, p), (0, 1 - p)):
                best = np.argsort(-confidence, kind="stable")
                best = best[(confidence[best] >= sure) & open_[other][best]][:per_round]
                open_[other][best] = False
                x, t = given[other]
                given[other] = np.concatenate([x, pools[other][best]]), np.r_[t, np.full(len(best), label)]
                gifts[v] += len(best)
        log.append(tuple(gifts))
        if not any(gifts):
            break
    content, page = (View.fit(*given[v], held_views[v], held_y) for v in (0, 1))
    odds = np.stack([np.ones(len(held_y)), content.odds(held_views[0]), page.odds(held_views[1])], axis=1)
    weights = logistic(odds, held_y, l2=1e-3, rounds=500)
    return Model(content, page, weights, log)


def _views(frame: pd.DataFrame):
    return [np.stack([np.frombuffer(b, np.float32) for b in frame[c]]) if len(frame) else np.empty((0, w), np.float32)
            for c, w in (("c", 1 + len(FEATURES) + 5 + BUCKETS), ("p", PAGE_BUCKETS + 13))]


def _page_columns(docs: DataFrame):
    """Language, source and stored size, null where the table has no such column."""
    kinds = {"lang": "string", "source": "string", "n_chars": "long"}
    return [(F.col(c) if c in docs.columns else F.lit(None)).cast(k).alias(c + "_") for c, k in kinds.items()]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality",
        max_labelled: int = MAX_LABELLED, max_pool: int = MAX_POOL, rounds: int = ROUNDS) -> Model | None:
    """Fit on bounded samples, chosen by the smallest hashes of the keys; None if one of the two classes has fewer than two examples.

    Labels other than 0 and 1 and null keys are ignored; of contradicting labels the lower counts.
    """
    small_batches(docs.sparkSession)
    known = labels.where(F.col(quality_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("id_")).agg(F.min(quality_col).cast("int").alias("y_"))
    named = smallest_by_hash(known, "id_", max_labelled)
    free = docs.select(F.col(id_col).alias("id_")).where("id_ IS NOT NULL").distinct()
    pool = smallest_by_hash(free, "id_", max_labelled + max_pool).select("id_", F.lit(None).cast("int").alias("y_"))
    chosen = named.union(pool).groupBy("id_").agg(F.max("y_").alias("y_"))  # at most 2 * max_labelled + max_pool rows
    slim = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"), *_page_columns(docs))
    sample = slim.join(F.broadcast(chosen), "id_").select("y_", F.col("id_").cast("string").alias("k_"), "text_", "lang_",
                                                         "source_", "n_chars_")

    def run(batches):
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            content = [content_view(t).tobytes() for t in cols[2]]
            page = [page_view(a, b, n, t).tobytes() for t, a, b, n in zip(*cols[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(content, pa.binary()),
                                              pa.array(page, pa.binary())], ["y", "k", "c", "p"])

    got = sample.mapInArrow(run, "y int, k string, c binary, p binary").toPandas()
    got = got.sort_values(["k", "c"], kind="stable", ignore_index=True)  # the same order on every run
    labelled, free_rows = got[got["y"].notna()], got[got["y"].isna()].head(max_pool)
    if labelled["y"].nunique() < 2:
        return None
    held = np.array([zlib.crc32(k.encode()) % 4 == 0 for k in labelled["k"]])
    y = labelled["y"].to_numpy(np.int64)
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:  # few examples: every second one of each class
        held = labelled.groupby("y").cumcount().to_numpy() % 2 == 1
        if len(set(y[held])) < 2:
            return None
    return co_train(_views(labelled[~held]), y[~held], _views(labelled[held]), y[held], _views(free_rows), rounds)


def classify(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = THRESHOLD,
             into: str = "quality_", kept: str = "kept_") -> DataFrame:
    """The rows of ``docs`` with ``into`` (struct: score, content_score, page_score) and ``kept``; input columns so named give way.

    A null text is scored as an empty one. Without a model every score is null and every row is kept. All columns pass
    through unchanged; an empty table gives no rows.
    """
    if model is None:
        nothing = F.struct(*[F.lit(None).cast("double").alias(c) for c in ("score", "content_score", "page_score")])
        return docs.withColumns({into: nothing, kept: F.lit(True)})
    small_batches(docs.sparkSession)

    @F.pandas_udf("score double, content_score double, page_score double")
    def scores(text: pd.Series, lang: pd.Series, source: pd.Series, size: pd.Series) -> pd.DataFrame:
        size = size.astype(object).where(size.notna(), None)
        content = np.stack([content_view(t) for t in text])
        page = np.stack([page_view(a, b, n, t) for a, b, n, t in zip(lang, source, size, text, strict=True)])
        return pd.DataFrame({"score": model.score(content, page), "content_score": sigmoid(model.content.odds(content)),
                             "page_score": sigmoid(model.page.odds(page))})

    given = docs.withColumn(into, scores(F.col(text_col), *_page_columns(docs)))
    return given.withColumn(kept, F.col(f"`{into}`.score") >= threshold)
