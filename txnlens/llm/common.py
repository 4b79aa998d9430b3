"""What the operators share: stored stages, batches of bounded size, words, stable sampling."""

from __future__ import annotations

import re
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.sources.writers import materialize

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BATCH_ROWS = 256


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let Python workers take at most ``rows`` documents at a time, so that memory follows the longest texts only."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


@contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """Python workers take ``rows`` rows at a time in what is run inside; the session's setting holds again afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage and survives the loss of executors."""
    return materialize(df, label)


def discard(df: DataFrame) -> None:
    """Delete a table written by :func:`stored` that nothing reads any more."""
    files = df.inputFiles()
    if files:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def words(text: str | None) -> list[str]:
    return WORD.findall(text) if text else []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def smallest_by_hash(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows whose key has the smallest hash: a sample that does not depend on the partitioning."""
    return df.orderBy(F.xxhash64(F.col(key).cast("string")), key).limit(n)


def mix(a: np.ndarray, b) -> np.ndarray:
    """Combine two uint64 arrays into one hash, order-sensitive."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x = (x + b) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive symbols, from the symbols' hashes, in O(len * log k)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, covered, power, length = None, 0, h, 1
    while True:
        if k & length:
            out = power[:n] if out is None else mix(out, power[covered:covered + n])
            covered += length
        if covered == k:
            return out
        power = mix(power[:len(power) - length], power[length:])
        length *= 2


def first_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """For every run of ``w`` consecutive hashes the position of its smallest one, the first where they tie."""
    n, pad = len(h), -len(h) % w
    x = np.concatenate([h, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    column, base = np.arange(w), np.arange(0, n + pad, w)[:, None]
    low = np.minimum.accumulate(x, axis=1)
    new = np.ones(x.shape, bool)
    np.less(x[:, 1:], low[:, :-1], out=new[:, 1:])
    ahead = (np.maximum.accumulate(np.where(new, column, 0), axis=1) + base).ravel()
    low = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1]
    new = np.ones(x.shape, bool)
    np.less_equal(x[:, :-1], low[:, 1:], out=new[:, :-1])
    behind = (np.minimum.accumulate(np.where(new, column, w)[:, ::-1], axis=1)[:, ::-1] + base).ravel()
    behind, ahead = behind[:n - w + 1], ahead[w - 1:n]
    return np.where(h[behind] <= h[ahead], behind, ahead)


# Hashes of ranges are polynomials modulo a prime: modulo a power of two, words that differ by a pattern would hash alike.
# Fixed seed: hashes are compared across tasks.
_rng = np.random.default_rng(20240117)
_PRIME = (1 << 61) - 1
_P, _HALF = np.uint64(_PRIME), np.uint64(0xFFFFFFFF)
_BYTE_VALUE = _rng.integers(1, 1 << 60, 256, dtype=np.uint64) | np.uint64(1)
_BASE = int(_rng.integers(1 << 59, 1 << 60))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = {"n": 0}


def _reduced(x: np.ndarray) -> np.ndarray:
    """Numbers below 2**64 modulo the prime."""
    x = (x & _P) + (x >> np.uint64(61))
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b) -> np.ndarray:
    """Products modulo the prime of numbers below it, by halves of 32 bits."""
    a1, a0, b1, b0 = a >> np.uint64(32), a & _HALF, b >> np.uint64(32), b & _HALF
    middle, low = a1 * b0 + a0 * b1, a0 * b0
    x = (a1 * b1 << np.uint64(3)) + (middle >> np.uint64(29)) + ((middle & np.uint64((1 << 29) - 1)) << np.uint64(32))
    return _reduced(x + (low >> np.uint64(61)) + (low & _P))


def _power_tables(n: int):
    """Powers of the base and of its inverse modulo the prime, at least ``n`` of them; they grow with the longest text."""
    if _powers["n"] < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, _PRIME))):
            table = np.ones(size, np.uint64)
            known = 1
            while known < size:
                table[known:2 * known] = _times(table[:known], np.uint64(pow(base, known, _PRIME)))
                known *= 2
            _powers[name] = table
        _powers["n"] = size
    return _powers["up"], _powers["down"]


class RangeHashes:
    """Hashes of any ranges of ``values``: equal ranges hash alike wherever they stand. Sums are kept by halves of 32 bits."""

    def __init__(self, values: np.ndarray):
        up, self.down = _power_tables(len(values) + 1)
        terms = _times(_reduced(values), up[:len(values)])
        self.high, self.low = np.zeros((2, len(values) + 1), np.uint64)
        np.cumsum(terms >> np.uint64(32), out=self.high[1:])
        np.cumsum(terms & _HALF, out=self.low[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        whole = _times(_reduced(self.high[ends] - self.high[starts]), np.uint64(1 << 32))
        whole += _reduced(self.low[ends] - self.low[starts])
        return mix(_times(_reduced(whole), self.down[starts]), (ends - starts).astype(np.uint64))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for each range."""
    return RangeHashes(values).of(starts, ends)


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words of UTF-8 bytes: maximal runs without the six ASCII white-space characters.

    The hash of a word adds up a scrambled number for each of its bytes and its place in the word.
    """
    raw = np.frombuffer(data, np.uint8)
    edge = np.diff(np.r_[True, _SPACE[raw], True].view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return starts, ends, np.empty(0, np.uint64)
    sizes = np.diff(starts, append=len(raw))
    sizes[0] += starts[0]  # white space before the first word is in no sum
    place = np.arange(len(raw)) - np.repeat(starts, sizes)
    x = (((place << 8) + raw + 1).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(x, out=sums[1:])
    return starts, ends, mix(sums[ends] - sums[starts], (ends - starts).astype(np.uint64))


def to_bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by spans; touching spans are joined."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.r_[True, starts[1:] > reach[:-1]]
    return starts[first], reach[np.r_[first[1:], True]]
