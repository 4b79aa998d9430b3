"""Repeated byte strings by suffix sorting of shards.

Every byte that a string of ``window`` bytes covers is removed if that string also starts anywhere else. Documents are reduced
to the contexts of their anchors (see ``anchors``). Equal contexts are kept once with their count: if it is above one, all their
strings repeat. The others are compared with the contexts that share half a string with them, on one side of the anchor or the
other; without such a partner they hold no repeat. What is left is cut into shards by anchor and suffix-sorted with common
prefixes (see ``induced``): neighbours in the order that share ``window`` bytes form a class, and a class repeats if it has two
members or a context that occurs more than once. Repeated stretches go back to every document that has the context.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.llm import induced
from txnlens.llm.anchors import context_anchors, halves
from txnlens.llm.common import _BYTE_VALUE, RangeHashes, merge_spans, small_batches, stored, to_bytes, window_hashes

WINDOW = 400
GRAM = 32
SHARD_BYTES = 3_000_000  # a shard closes before the anchor that would take it beyond so many bytes
SHARD_CONTEXTS = 8192  # contexts of one anchor (about 600 bytes each) beyond which their strings are grouped by hash

_FIELDS = "anchor long, context long, start int, size int, left long, right long"


def occurrences(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(id_, row_, anchor, context, start, size, left, right): the contexts of every document, stored."""

    def run(batches):
        for batch in batches:
            cols = [[] for _ in range(7)]
            for i, text in enumerate(batch.column(2).to_pylist()):
                values = _BYTE_VALUE[np.frombuffer(to_bytes(text), np.uint8)]
                hashes = RangeHashes(values)
                anchor, at, start, end, context = context_anchors(values, window, gram, hashes)
                sides = halves(hashes, at, start, end, window, gram)
                for col, part in zip(cols, (np.full(len(anchor), i), anchor, context, start, end - start, *sides), strict=True):
                    col.append(part)
            take, anchor, context, start, size, left, right = (np.concatenate(c).astype(np.int64) for c in cols)
            take = pa.array(take)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(anchor), pa.array(context),
                 pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(left), pa.array(right)],
                ["id_", "row_", "anchor", "context", "start", "size", "left", "right"])

    kind = docs.schema["id_"].dataType.simpleString()
    return stored(docs.mapInArrow(run, f"id_ {kind}, row_ long, {_FIELDS}"), "byte-contexts")


def partners(unlike: DataFrame) -> DataFrame:
    """(anchor, context, id_, row_, start, size, n_): contexts with a partner that shares a half, one of both occurring once; stored."""
    sides = unlike.select("anchor", "context", "at_.id_", "at_.row_", "at_.start", "at_.size", "n_",
                          F.explode(F.array("at_.left", "at_.right")).alias("side")).where("side <> 0")
    live = sides.groupBy("side").agg(F.count("*").alias("kinds_"), F.min("n_").alias("least_")).where("kinds_ > 1 AND least_ = 1")
    return stored(sides.join(live.select("side"), "side", "left_semi").drop("side").dropDuplicates(["anchor", "context"]),
                  "like-byte-contexts")


def contexts(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(anchor, context, n_, crowded, data): the bytes of the contexts that ``places`` names, stored."""
    by_row = places.groupBy("id_", "row_").agg(
        F.collect_list(F.struct("anchor", "context", "start", "size", "n_", "crowded")).alias("at_"))
    texts = docs.select("id_", "row_", "text_").join(by_row.withColumnsRenamed({"id_": "i_", "row_": "r_"}),
                                                     F.col("id_").eqNullSafe(F.col("i_")) & (F.col("row_") == F.col("r_")))
    texts = texts.dropDuplicates(["id_", "row_"]).select("text_", "at_")

    def run(batches):
        for batch in batches:
            for i, text in enumerate(batch.column(0).to_pylist()):
                data, at = to_bytes(text), batch.column(1).slice(i, 1).flatten()
                start, size = at.field("start"), at.field("size")
                cut = [data[a:a + n] for a, n in zip(start.to_pylist(), size.to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [at.field("anchor"), at.field("context"), at.field("n_"), at.field("crowded"), pa.array(cut, pa.binary())],
                    ["anchor", "context", "n_", "crowded", "data"])

    return stored(texts.mapInArrow(run, "anchor long, context long, n_ long, crowded boolean, data binary"), "byte-reference")


def repeated_starts(shard: pd.DataFrame, window: int, memory: int, base: int):
    """For every context of a shard, in order: offsets at which a string of ``window`` bytes starts that repeats."""
    sizes = shard["data"].map(len).to_numpy()
    # UTF-8 never holds bytes above 0xF4: shifted by two they leave 0 for the end and 1 for the gaps between contexts
    text = np.frombuffer(b"\xff".join(shard["data"]) + b"\xfe", np.uint8) + np.uint8(2)  # wraps: gap 1, end 0
    begins = np.cumsum(np.r_[0, sizes[:-1] + 1])
    with induced.Disk(memory) as disk:
        owner_all, offset_all = [], []
        members = np.where(shard["n_"].to_numpy() > 1, 2, 1)
        for order, common in induced.sort(text, window, disk, base):
            # batches come from the largest symbol down and a class never crosses two of them
            owner = np.searchsorted(begins, order, side="right") - 1
            offset = order - begins[owner]
            new = common < window
            new[0] = True
            group = np.cumsum(new) - 1
            whole = sizes[owner] - offset >= window
            hit = (np.bincount(group, weights=members[owner] * whole) > 1)[group] & whole
            owner_all.append(owner[hit])
            offset_all.append(offset[hit])
        owner, offset = np.concatenate(owner_all), np.concatenate(offset_all)
    by = np.lexsort((offset, owner))
    return np.split(offset[by], np.searchsorted(owner[by], np.arange(1, len(shard))))


def runs_of(offsets: np.ndarray, window: int) -> list[dict]:
    """Bytes covered by the strings that start at these offsets, as runs [from, to)."""
    a, b = merge_spans(offsets, offsets + window)
    return [{"from": x, "to": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)]


def shards(frames, shard_bytes: int):
    """Whole anchors, together at most ``shard_bytes`` bytes, or one larger anchor; rows arrive sorted by anchor."""
    waiting, size = [], 0
    last, last_size = [], 0  # the anchor of which more rows may come
    for frame in frames:
        cuts = np.r_[0, np.flatnonzero(np.diff(frame["anchor"].to_numpy())) + 1, len(frame)] if len(frame) else [0]
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = frame.iloc[a:b]
            if last and part["anchor"].iat[0] != last[-1]["anchor"].iat[-1]:
                waiting += last
                size, last, last_size = size + last_size, [], 0
            last.append(part)
            last_size += sum(map(len, part["data"]))
            if waiting and size + last_size > shard_bytes:
                yield pd.concat(waiting, ignore_index=True)
                waiting, size = [], 0
    if waiting or last:
        yield pd.concat([*waiting, *last], ignore_index=True)


def repeated_runs(reference: DataFrame, window: int, shard_bytes: int, memory: int, base: int) -> DataFrame:
    """(anchor, context, runs): the repeated bytes of every context, by suffix sorting of its shard."""

    def run(frames):
        for shard in shards(frames, shard_bytes):
            runs = [runs_of(x, window) for x in repeated_starts(shard, window, memory, base)]
            # contexts that occur more than once are compared with, but their own result is known
            yield pd.DataFrame({"anchor": shard["anchor"], "context": shard["context"], "runs": runs})[shard["n_"] == 1]

    dealt = reference.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInPandas(run, "anchor long, context long, runs array<struct<from: int, to: int>>")


def crowded_runs(reference: DataFrame, window: int) -> DataFrame:
    """The same rows for anchors with very many contexts: every string is grouped by its hash, whatever their number.

    Only strings that occur once leave the grouping, each of which has one place.
    """

    def strings_of(batches):
        for batch in batches:
            for i, data in enumerate(batch.column(3).to_pylist()):
                h = window_hashes(_BYTE_VALUE[np.frombuffer(data, np.uint8)], window).view(np.int64)
                take = pa.array(np.full(len(h), i))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(take) for c in range(3)), pa.array(h), pa.array(np.arange(len(h), dtype=np.int32))],
                    ["anchor", "context", "n_", "h", "i"])

    def run(frames):
        for frame in frames:
            runs = [runs_of(np.setdiff1d(np.arange(size - window + 1), [] if once is None else once), window)
                    for size, once in zip(frame["size"], frame["once"], strict=True)]
            yield pd.DataFrame({"anchor": frame["anchor"], "context": frame["context"], "runs": runs})

    strings = reference.select("anchor", "context", "n_", "data").mapInArrow(
        strings_of, "anchor long, context long, n_ long, h long, i int")
    once = strings.groupBy("h").agg(F.sum("n_").alias("n_"), *(F.min(c).alias(c) for c in ("anchor", "context", "i"))).where("n_ = 1")
    once = once.groupBy("anchor", "context").agg(F.collect_list("i").alias("once"))
    texts = reference.where("n_ = 1").select("anchor", "context", F.octet_length("data").alias("size"))
    return texts.join(once, ["anchor", "context"], "left").select("anchor", "context", "size", "once").mapInPandas(
        run, "anchor long, context long, runs array<struct<from: int, to: int>>")


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
                   shard_contexts: int = SHARD_CONTEXTS, memory: int = induced.MEMORY, base: int = induced.BASE) -> DataFrame:
    """(id_, row_, spans): byte spans [from, to) of every document that repeated strings cover. ``docs``: (id_, row_, text_)."""
    spots = occurrences(docs, window, gram)
    unlike = stored(spots.groupBy("anchor", "context").agg(
        F.min(F.struct("id_", "row_", "start", "size", "left", "right")).alias("at_"), F.count("*").alias("n_")),
        "unlike-byte-contexts")
    like = partners(unlike)
    kinds = like.groupBy("anchor").agg((F.count("*") > shard_contexts).alias("crowded"))
    reference = contexts(docs, like.join(kinds, "anchor"))
    # where a context occurs twice or more, all its strings repeat: there is nothing to find out
    whole = F.array(F.struct(F.lit(0).alias("from"), F.col("at_.size").alias("to")))
    runs = repeated_runs(reference.where("NOT crowded"), window, shard_bytes, memory, base).unionByName(
        crowded_runs(reference.where("crowded"), window)).unionByName(
        unlike.where("n_ > 1").select("anchor", "context", whole.alias("runs")))
    found = spots.join(stored(runs.where("size(runs) > 0"), "repeated-runs"), ["anchor", "context"]).select(
        "id_", "row_", F.expr("transform(runs, r -> struct(start + r.from AS from, start + r.to AS to))").alias("spans_")).distinct()
    return found.groupBy("id_", "row_").agg(F.flatten(F.collect_list("spans_")).alias("spans"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, **shards) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept): the bytes left of every row, as binary.

    A null text is empty. Keys may be null or repeated; equal rows are places of their own, so they repeat each other. Texts
    shorter than the window are kept. An empty table gives no rows. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    given = docs.select(F.col(id_col).alias("id_"), F.xxhash64(text_col).alias("row_"), F.col(text_col).alias("text_"))
    spans = repeated_spans(given, window, **shards).withColumnsRenamed({"id_": "i_", "row_": "r_"})
    joined = given.join(spans, F.col("id_").eqNullSafe(F.col("i_")) & (F.col("row_") == F.col("r_")), "left").select(
        "id_", "text_", "spans")

    def run(batches):
        for batch in batches:
            counts, kept = [[], [], []], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                data, n_spans = to_bytes(text), 0
                left = data
                if batch.column(2)[i].is_valid:
                    at = batch.column(2).slice(i, 1).flatten()
                    a, b = merge_spans(at.field("from").to_numpy(), at.field("to").to_numpy())
                    n_spans = len(a)
                    left = b"".join(data[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(data)], strict=True))
                for col, value in zip(counts, (len(data), len(data) - len(left), n_spans), strict=True):
                    col.append(value)
                kept.append(left)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in counts),
                                              pa.array(kept, pa.binary())], ["id_", "n_bytes", "n_removed", "n_spans", "kept"])

    kind = given.schema["id_"].dataType.simpleString()
    return joined.mapInArrow(run, f"id_ {kind}, n_bytes long, n_removed long, n_spans long, kept binary").withColumnRenamed(
        "id_", id_col)
