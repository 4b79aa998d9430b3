"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two fingerprints that differ in at most ``bits`` bits share at least ``8 - bits`` of their eight positional bytes. The index
lists distinct fingerprints under every choice of that many positional bytes, so all pairs that reach the guaranteed minimum
meet in a list, and no pair below it does: a list over a single byte would hold 1/256 of the corpus. Within a list the
fingerprints differ in the other bytes only, so it holds at most 256 ** bits of them however large the corpus is; each looks
up its neighbours there instead of being paired with every other. The count filter is in the keys: a pair meets exactly if its tally
of equal bytes reaches the minimum, and pairs that meet are verified.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.llm.common import WORD, small_batches, stored
from txnlens.llm.graph import components

SEED = 42
SHINGLE = 3
BITS = 2
_LOWER = {i: i + 32 for i in range(65, 91)}


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bitwise majority of the XXH64 of the word shingles, repeats included; 0 without words."""
    words = WORD.findall(text.translate(_LOWER)) if text else []
    if not words:
        return 0
    if len(words) < shingle:
        parts = [" ".join(words)]
    else:
        parts = map(" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    return majority(np.array([xxhash.xxh64_intdigest(p, seed) for p in parts], ">u8"))


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are those set in more than half of the big-endian 64-bit ``hashes``."""
    over, n = np.zeros(64, np.int64), len(hashes)
    for at in range(0, n, 65536):
        over += np.unpackbits(hashes[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(over * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id_, row_, fp): the fingerprint of every document as a signed long, and the hash of its text. Null and wordless texts
    have fingerprint 0."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            bits = [fingerprint(t, shingle) for t in batch.column(2).to_pylist()]
            values = np.array(bits, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values)], ["id_", "row_", "fp"])

    slim = docs.select(F.col(id_col).alias("id_"), F.xxhash64(text_col).alias("row_"), F.col(text_col).alias("text_"))
    return slim.mapInArrow(run, f"id_ {slim.schema['id_'].dataType.simpleString()}, row_ long, fp long")


def masks(shared: int) -> list[int]:
    """Bit masks of every choice of ``shared`` positional bytes of eight."""
    return [sum(0xFF << 8 * i for i in chosen) for chosen in combinations(range(8), shared)]


def flips(free: int, bits: int) -> np.ndarray:
    """The non-zero patterns of at most ``bits`` set bits within the mask ``free``."""
    places = [1 << i for i in range(64) if free >> i & 1]
    return np.array([sum(c) for k in range(1, bits + 1) for c in combinations(places, k)], np.uint64)


def links(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``) at ``bits`` or fewer differing bits.

    Within an index list the links form a spanning forest of all its verified pairs: no connection is lost, and there are
    fewer links than entries.
    """
    choices = masks(8 - bits)
    signed = [m - (1 << 64) if m >> 63 else m for m in choices]
    table = F.array(*[F.struct(F.lit(i).alias("choice"), F.lit(m).cast("long").alias("mask")) for i, m in enumerate(signed)])
    index = distinct.select("fp", F.explode(table).alias("m_")).select(
        F.col("m_.choice").alias("choice"), F.col("fp").bitwiseAND(F.col("m_.mask")).alias("shared"), "fp")
    patterns = [flips(~m & (1 << 64) - 1, bits) for m in choices]

    def forest(choice: int, fps: np.ndarray):
        """Links of a list: breadth-first, each fingerprint looks up its verified neighbours among those not reached."""
        if len(fps) == 2:
            ok = int(fps[0] ^ fps[1]).bit_count() <= bits
            return [(fps[0], fps[1])] if ok else []
        waiting, out = set(fps.tolist()), []
        while waiting:
            queue = [waiting.pop()]
            while queue:
                fp = queue.pop()
                if len(waiting) < 64:
                    near = [x for x in waiting if (x ^ fp).bit_count() <= bits]
                else:
                    near = waiting.intersection((patterns[choice] ^ np.uint64(fp)).tolist())
                waiting.difference_update(near)
                queue.extend(near)
                out.extend((fp, x) for x in near)
        return out

    def run(batches):
        """Rows arrive sorted by list; a list that a batch cuts is carried over to the next."""
        carried = None
        for frame in batches:
            part = frame if carried is None else pd.concat([carried, frame], ignore_index=True)
            c, s = part["choice"].to_numpy(), part["shared"].to_numpy()
            starts = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (s[1:] != s[:-1])])
            carried = part.iloc[starts[-1]:]
            yield found(part.iloc[:starts[-1]], starts)
        if carried is not None:
            yield found(carried, np.array([0, len(carried)]))

    def found(part, starts):
        c, fps = part["choice"].to_numpy(), part["fp"].to_numpy().view(np.uint64)
        starts = starts[starts < len(part)] if len(part) else np.empty(0, np.int64)
        ends = np.r_[starts[1:], len(part)]
        out = [x for i, j in zip(starts, ends, strict=True) if j - i > 1 for x in forest(c[i], fps[i:j])]
        pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    dealt = index.repartition("choice", "shared").sortWithinPartitions("choice", "shared")
    return dealt.mapInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    bits: int = BITS) -> DataFrame:
    """(id_col, text_hash, fp, root, component_id): for every row its fingerprint, a fingerprint that names its component, and
    the smallest key among the documents reachable by links.

    Documents of one fingerprint are one node. Null texts count as wordless; a null key never names a component unless
    all keys in it are null; repeated rows stay. An empty table gives no rows. Other columns are ignored.
    """
    marked = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    classes = stored(marked.groupBy("fp").agg(F.min("id_").alias("first_")), "simhash-classes")
    grouped = components(links(classes, bits), "simhash-links")
    named = classes.join(grouped.withColumnsRenamed({"a": "fp", "b": "root_"}), "fp", "left")
    rooted = named.select("fp", "first_", F.coalesce("root_", "fp").alias("root_"))
    smallest = rooted.groupBy("root_").agg(F.min("first_").alias("component_id"))
    labels = rooted.join(smallest, "root_").select("fp", "root_", "component_id")
    return marked.join(labels, "fp").select(F.col("id_").alias(id_col), F.col("row_").alias("text_hash"), "fp",
                                            F.col("root_").alias("root"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest key stays (a null key only
    where no other is there), of equal rows one. All columns pass through."""
    return keep_smallest(docs, near_duplicates(docs, id_col, text_col, **how), id_col, text_col)


def keep_smallest(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row with the smallest key of each ``root`` of ``found`` (id_col, text_hash, root)."""
    row = F.struct(F.col(id_col).isNull().alias("none_"), F.col(id_col).alias("i_"), F.col("text_hash").alias("r_"))
    stay = found.groupBy("root").agg(F.min(row).alias("row_")).select("row_.i_", "row_.r_")
    given = docs.select(F.struct("*").alias("all_"), F.col(id_col).alias("id_"), F.xxhash64(text_col).alias("row_"))
    kept = given.join(stay, F.col("id_").eqNullSafe(F.col("i_")) & (F.col("row_") == F.col("r_")))
    return kept.dropDuplicates(["id_", "row_"]).select("all_.*")


def hexadecimal(fp):
    """Column: 16 lowercase hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
