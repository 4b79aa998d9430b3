"""Byte-level BPE by two tiers: a minimal perfect hash over the vocabulary, then merges from a heap over linked bytes.

A pre-token that is itself in the vocabulary and reachable by merges is resolved by one probe of the hash. Everything else is
merged: bytes form a linked list, adjacent pairs wait in a heap ordered by rank and position, and stale pairs are skipped.
"""

from __future__ import annotations

import base64
import re
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.llm.common import small_batches

# Pre-token pattern of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The same pattern for texts of ASCII and Latin letters only, where the plain engine is faster: its classes are spelled out.
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_WHITE = r"\t\n\x0b\x0c\r "
_LATIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^{_WHITE}{_LETTER}0-9]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
_NOT_LATIN = re.compile("[^\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]")
MEMO = 400_000  # resolved pre-tokens that a worker remembers


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class PerfectHash:
    """Minimal perfect hash of byte strings: buckets are displaced, largest first, until their keys land on free slots."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.size, self.buckets = n, max(1, n // 2)
        hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
        self.shift = np.zeros(self.buckets, np.int64)
        slot = np.full(n, -1, np.int64)
        free = np.ones(n, bool)
        bucket = self._bucket(hashes)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(sizes)
        singles = []
        for b in np.argsort(-sizes, kind="stable"):
            members = order[ends[b] - sizes[b]:ends[b]]
            if len(members) == 0:
                break
            if len(members) == 1:
                singles.append((b, members[0]))
                continue
            for first in range(1, 1 << 30, 128):
                tries = np.sort(self._displaced(hashes[members][None, :], np.arange(first, first + 128)[:, None]), axis=1)
                fits = free[tries].all(axis=1) & (np.diff(tries, axis=1) > 0).all(axis=1)
                if fits.any():
                    shift = first + int(fits.argmax())
                    at = self._displaced(hashes[members], shift)
                    free[at], slot[members], self.shift[b] = False, at, shift
                    break
        for (b, key), at in zip(singles, np.flatnonzero(free), strict=True):
            slot[key], self.shift[b] = at, -1 - at  # a bucket of one key names its slot
        self.keys = [b""] * n
        for i, at in enumerate(slot.tolist()):
            self.keys[at] = keys[i]
        self.slots = slot

    def _bucket(self, hashes):
        return (hashes >> np.uint64(40)).astype(np.int64) % self.buckets

    def _displaced(self, hashes, shift):
        x = hashes + np.asarray(shift, np.int64).astype(np.uint64) * ((hashes >> np.uint64(32)) | np.uint64(1))
        x ^= x >> np.uint64(31)
        return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).astype(np.int64) % self.size

    def find(self, asked: list[bytes]) -> np.ndarray:
        """The slot of each key, -1 for strings that are not among the keys."""
        if not asked or not self.size:
            return np.full(len(asked), -1, np.int64)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, asked), np.uint64, len(asked))
        shift = self.shift[self._bucket(hashes)]
        at = np.where(shift < 0, -1 - shift, self._displaced(hashes, np.maximum(shift, 0)))
        keys = self.keys
        return np.array([i if keys[i] == k else -1 for i, k in zip(at.tolist(), asked, strict=True)], np.int64)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: always merges the adjacent pair of lowest rank, the leftmost among equals.

    A heap entry is ``rank << 32 | start``. ``rank_at[start]`` is the rank of the pair that starts there now, so an entry
    with another rank is stale.
    """
    n, get = len(piece), ranks.get
    rank_at = [get(piece[i:i + 2], -1) for i in range(n - 1)]
    heap = [r << 32 | i for i, r in enumerate(rank_at) if r >= 0]
    heapify(heap)
    rank_at.append(-1)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        entry = heappop(heap)
        i = entry & 0xFFFFFFFF
        if rank_at[i] != entry >> 32:
            continue
        middle = end[i]
        stop = end[i] = end[middle]
        rank_at[middle] = -1
        if stop < n:
            before[stop] = i
            rank = rank_at[i] = get(piece[i:end[stop]], -1)
            if rank >= 0:
                heappush(heap, rank << 32 | i)
        else:
            rank_at[i] = -1
        if i:
            left = before[i]
            rank = rank_at[left] = get(piece[left:stop], -1)
            if rank >= 0:
                heappush(heap, rank << 32 | left)
    out, i = [], 0
    while i < n:
        stop = end[i]
        out.append(ranks[piece[i:stop]])
        i = stop
    return out


class Tables:
    """What workers need: the ranks and the perfect hash with the ids of its slots. Its size follows the vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        keys = sorted(ranks)
        self.hash = PerfectHash(keys)
        self.ids = np.zeros(len(keys), np.int64)
        self.ids[self.hash.slots] = [ranks[k] for k in keys]
        self.by_id = {i: k for k, i in ranks.items()}


class Encoder:
    def __init__(self, tables: Tables, pattern: str = PATTERN):
        import regex

        self.tables, self.general, self.latin = tables, regex.compile(pattern).findall, pattern == PATTERN
        self.memo: dict[str, tuple] = {}

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a text."""
        return _LATIN.findall(text) if self.latin and _NOT_LATIN.search(text) is None else self.general(text)

    def _resolve(self, pieces: list[str]) -> None:
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        found = self.tables.hash.find(raw)
        ids, ranks = self.tables.ids, self.tables.ranks
        for text, data, at in zip(pieces, raw, found.tolist(), strict=True):
            self.memo[text] = (int(ids[at]),) if at >= 0 else tuple(merge(data, ranks))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo, out = self.memo, []
        parts = [self.split(t) if t else [] for t in texts]
        self._resolve(list({p for part in parts for p in part if p not in memo}))
        for part in parts:
            ids: list[int] = []
            extend = ids.extend
            for resolved in map(memo.__getitem__, part):
                extend(resolved)
            out.append(np.array(ids, np.int32))
        return out


def tables(spark, path: str):
    """The tables of a rank file, broadcast: a vocabulary has a fixed size."""
    return spark.sparkContext.broadcast(Tables(read_ranks(path)))


def encode(docs: DataFrame, shared, id_col: str = "doc_id", text_col: str = "text", pattern: str = PATTERN) -> DataFrame:
    """(id_col, ids): token ids of every text; null and empty texts have no ids. Keys are kept as they are, null or repeated;
    other columns are ignored. ``shared`` comes from :func:`tables`."""
    small_batches(docs.sparkSession)

    def run(batches):
        encoder = Encoder(shared.value, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            at = 0
            while at < len(texts):  # at most a few megabytes of text are held as pre-tokens at a time
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size < 2_000_000):
                    size += len(texts[stop] or "")
                    stop += 1
                ids = encoder.encode(texts[at:stop])
                ends = np.cumsum([0, *map(len, ids)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, stop - at), lists], ["id_", "ids"])
                at = stop

    slim = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
    kind = slim.schema["id_"].dataType.simpleString()
    return slim.mapInArrow(run, f"id_ {kind}, ids array<int>").withColumnRenamed("id_", id_col)


def decode(shared):
    """A column function: array of ids -> the bytes they stand for (null for null)."""

    @F.pandas_udf("binary")
    def to_bytes(ids: pd.Series) -> pd.Series:
        by_id = shared.value.by_id
        return ids.map(lambda x: None if x is None else b"".join(map(by_id.__getitem__, x.tolist())))

    return to_bytes
