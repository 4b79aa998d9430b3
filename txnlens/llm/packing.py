"""Best-fit packing by minimum bin slack.

Documents are tokenized and cut, lengths are counted, and the packing is planned on the histogram of lengths: at most one
entry per length up to the capacity, whatever the number of documents. Each step fixes the longest length left, finds with a
bitset of reachable sums the fullest combination of available lengths beside it, and repeats that combination as often as the
counts allow, so a step uses up a length (or all but fewer copies than one bin takes). Pieces are then numbered within their
length and looked up in the plan; no document is moved for planning.
"""

from __future__ import annotations

import json
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlens.llm.common import small_batches, stored

CAPACITY = 1024
END_ID = 2
# Pre-token pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of the printable alphabet that byte-level vocabulary files are written in."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a byte-level BPE file; ids of merged tokens follow the order of the merges."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    alphabet = byte_alphabet()
    return {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}


def added_tokens(path: str) -> dict[str, int]:
    """Strings of the added tokens of a vocabulary file -> id; the library finds them in a text before anything else."""
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f).get("added_tokens", [])}


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: all of full length but perhaps the first."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


_PIECES = "id_ {}, piece int, start long, length int, ids binary, part_ int, rank_ long"


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID, added: bool = False) -> DataFrame:
    """(id_, piece, start, length, ids, part_, rank_): the token pieces of every document, stored.

    ``ids`` holds little-endian unsigned 32-bit ids. Strings of added tokens in a text are ordinary text, or with ``added``
    their ids, as the tokenizers library has it by default. ``rank_`` numbers the pieces of one length within one task,
    ``part_`` names the task.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ranks = spark.sparkContext.broadcast(vocabulary(tokenizer_path))  # the vocabulary file: its size is fixed
    specials = added_tokens(tokenizer_path) if added else {}

    def run(batches):
        import tiktoken

        encoder = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks.value, special_tokens=specials)
        encode = partial(encoder.encode, allowed_special="all", disallowed_special=()) if specials else encoder.encode_ordinary
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*encode(text or ""), end_id], dtype="<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append((key, k, start, length, ids[start:start + length].tobytes(), part, seen[length]))
                    seen[length] += 1
                    if len(rows) >= 4096:
                        yield to_batch(rows, batch.schema.field(0).type)
                        rows = []
            if rows:
                yield to_batch(rows, batch.schema.field(0).type)

    def to_batch(rows, key_type):
        kinds = [key_type, pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64()]
        names = ["id_", "piece", "start", "length", "ids", "part_", "rank_"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    slim = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
    return stored(slim.mapInArrow(run, _PIECES.format(slim.schema["id_"].dataType.simpleString())), "pieces")


def fullest(room: int, counts: dict[int, int]) -> list[tuple[int, int]]:
    """(length, copies) of a multiset of available lengths whose sum is the largest that fits into ``room``."""
    steps, reach, mask = [], 1, (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, size = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            take = min(size, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & mask
            left -= take
            size *= 2
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return sorted(chosen.items(), reverse=True)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(bins, [(length, copies in each bin), ...]), ...]: combinations by minimum bin slack, longest length first."""
    left, out = {k: v for k, v in histogram.items() if v}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        beside = fullest(capacity - longest, {k: v for k, v in left.items() if v})
        left[longest] += 1
        inside = dict(beside)
        inside[longest] = inside.get(longest, 0) + 1
        bins = min(left[k] // m for k, m in inside.items())
        for k, m in inside.items():
            left[k] -= bins * m
        left = {k: v for k, v in left.items() if v}
        out.append((bins, sorted(inside.items(), reverse=True)))
    return out


def slots(planned) -> pd.DataFrame:
    """The plan by length: from which rank on, in which bins and at which offset the pieces of a length go."""
    used, first_bin, rows = {}, 0, []
    for bins, inside in planned:
        offset = 0
        for length, copies in inside:
            rows.append((length, used.get(length, 0), copies, first_bin, offset))
            used[length] = used.get(length, 0) + bins * copies
            offset += length * copies
        first_bin += bins
    return pd.DataFrame(rows, columns=["length", "rank", "copies", "bin", "offset"], dtype="int64").sort_values(
        ["length", "rank"], ignore_index=True)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, added: bool = False) -> DataFrame:
    """(id_col, piece, start, length, ids, ids_crc32, sequence_id, offset): every piece and its place.

    A null text counts as empty (one piece that holds the end id alone); null and repeated keys are kept as they are; equal
    documents are packed once each. An empty table gives no rows. Other columns are ignored.
    """
    cuts = pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, added)
    counts = cuts.groupBy("part_", "length").agg(F.count("*").alias("n_"))
    before = F.sum("n_").over(Window.partitionBy("length").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("part_", "length", F.coalesce(before, F.lit(0)).alias("first_"))
    histogram = cuts.groupBy("length").count().collect()  # at most one row for each length up to the capacity
    table = slots(plan({r["length"]: r["count"] for r in histogram}, capacity))
    if table.empty:
        table.loc[0] = [0, 0, 1, 0, 0]
    lengths, ranks = table["length"].to_numpy(), table["rank"].to_numpy()
    copies, bins, offsets = table["copies"].to_numpy(), table["bin"].to_numpy(), table["offset"].to_numpy()
    shift = 1 << 44  # ranks stay below
    keys = lengths * shift + ranks

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy("int64"), rank.to_numpy("int64")
        at = np.searchsorted(keys, length * shift + rank, side="right") - 1
        within = rank - ranks[at]
        return pd.DataFrame({"sequence_id": bins[at] + within // copies[at],
                             "offset": offsets[at] + within % copies[at] * length})

    placed = cuts.withColumn("ids_crc32", F.crc32("ids")).join(starts, ["part_", "length"]).withColumn(
        "place_", place(F.col("length").cast("long"), F.col("first_") + F.col("rank_")))
    return placed.select(F.col("id_").alias(id_col), "piece", "start", F.col("length").cast("long").alias("length"), "ids",
                         "ids_crc32", "place_.sequence_id", "place_.offset")
