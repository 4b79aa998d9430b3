"""The trie of conversation prefixes, rolled up by centroid decomposition of its parent edges.

A node's subtree total is needed however deep the trie is and however many children a node has. So the forest is split at
centroids: in each component the nodes above which more than half of the component's weight lies form the path from its centroid to
its top; the total of the centroid's side is added along that path, the centroid is taken out, and what is left are components
of at most half the weight. A node weighs as much as the conversations that pass it, so the weight below a node is known before
anything is rolled up: what is left of each of its conversations. Components above a limit are split by joins, all at once in each
round; smaller ones are split to the end in one task each.

What belongs below a centroid is told without walking edges: a node is known by the smallest conversation that passes it, and it lies
below exactly if that conversation passes a child of the centroid.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlens.llm.common import discard, stored

LIMIT = 20_000  # weight of a component that one task splits to the end
BLOCK = 4_096   # turns whose hashes are added up in one window
IDS = 4_096     # conversation ids that are hashed as one piece
GROUP, HEAD = 5, 9  # a conversation begins with up to HEAD - 1 turns of the first one of its group


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, j, e1, e2, bytes): every turn with its number in its conversation and hashes of its role and text.

    Turns are sorted once, by ranges, so a conversation of any length is cut between partitions. Each border cuts one conversation at
    most; the turns that it has in earlier partitions are added to the numbers in the later ones.
    """
    order = ["conv_id", "turn", "role", "text"]
    slim = turns.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    in_order = slim.repartitionByRange(_partitions(turns), *order).sortWithinPartitions(*order)
    found = stored(in_order.select(
        "conv_id", F.xxhash64(F.lit(1), "role", "text").alias("e1"), F.xxhash64("text", F.lit(2), "role").alias("e2"),
        F.octet_length("text").alias("bytes"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "turns")
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    carried = found.groupBy("conv_id", "part").agg(F.count("*").alias("n")).select("conv_id", "part", before.alias("before"))
    number = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("at"))
    return (found.withColumn("j", number)
            .join(F.broadcast(carried.where("before > 0")), ["conv_id", "part"], "left")  # fewer rows than partitions
            .select("conv_id", (F.col("j") + F.coalesce("before", F.lit(0))).alias("j"), "e1", "e2", "bytes"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, conversations): the turns of the rebuilt conversations, (conv_id, d, e1, e2, bytes, size), and (conv_id, size)."""
    turn = stored(numbered(turns), "numbered")
    own = turn.groupBy("conv_id").agg(F.max("j").alias("own"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD
    first = (F.col("conv_id") - F.col("conv_id") % GROUP).alias("first")
    known = own.select("conv_id", first, head.alias("h"), "own")
    known = known.join(own.select(F.col("conv_id").alias("first"), F.col("own").alias("given")), "first", "left")
    taken = F.least("h", F.coalesce("given", F.lit(0)))
    known = stored(known.select("conv_id", "first", "h", taken.alias("m"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
                                .alias("size")), "conversations")
    kept = turn.withColumn("h_", head).where("j > h_").join(known.select("conv_id", "m", "size"), "conv_id")
    kept = kept.select("conv_id", (F.col("m") + F.col("j") - F.col("h_")).alias("d"), "e1", "e2", "bytes", "size")
    heads = turn.where((F.col("j") < HEAD) & (F.col("conv_id") % GROUP == 0)).withColumnRenamed("conv_id", "first")
    given = heads.join(known, "first").where("j <= h").select("conv_id", F.col("j").alias("d"), "e1", "e2", "bytes", "size")
    return kept.union(given), known.select("conv_id", "size")


def _name(depth, one, two):
    return F.unhex(F.md5(F.concat_ws(":", depth, one, two)))


def places(turns: DataFrame) -> DataFrame:
    """(conv_id, d, node, parent, bytes, size): the node of every prefix of every rebuilt conversation, the root with d = 0.

    A prefix is named by two sums of hashes of its turns with their places: sums of blocks can be added, so a conversation of any length
    is summed in parallel.
    """
    rows, conversations = rebuilt(turns)
    rows = stored(rows.withColumns({
        "t1": F.xxhash64("d", "e1").cast("decimal(20,0)"), "t2": F.xxhash64("e2", "d").cast("decimal(20,0)"),
        "block": F.floor((F.col("d") - 1) / BLOCK)}).drop("e1", "e2"), "rebuilt")
    here = Window.partitionBy("conv_id", "block").orderBy("d")
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.where(F.col("size") > BLOCK).groupBy("conv_id", "block").agg(F.sum("t1").alias("b1"), F.sum("t2").alias("b2"))
    blocks = blocks.select("conv_id", "block", F.sum("b1").over(earlier).alias("b1"), F.sum("b2").over(earlier).alias("b2"))
    wide, zero = "decimal(38,0)", F.lit(0).cast("decimal(38,0)")
    summed = rows.withColumns({"s1": F.sum("t1").over(here), "s2": F.sum("t2").over(here)}).join(blocks, ["conv_id", "block"], "left")
    s1, s2 = (F.col(f"s{i}").cast(wide) + F.coalesce(F.col(f"b{i}").cast(wide), zero) for i in (1, 2))
    summed = summed.select("conv_id", "d", "t1", "t2", s1.cast(wide).alias("s1"), s2.cast(wide).alias("s2"), "bytes", "size")
    named = summed.select("conv_id", "d", _name(F.col("d"), F.col("s1"), F.col("s2")).alias("node"),
                          _name(F.col("d") - 1, (F.col("s1") - F.col("t1")).cast(wide), (F.col("s2") - F.col("t2")).cast(wide)).alias("parent"),
                          F.col("bytes").cast("long").alias("bytes"), F.col("size").cast("long").alias("size"))
    root = conversations.select("conv_id", F.lit(0).cast("long").alias("d"), _name(F.lit(0), zero, zero).alias("node"),
                                F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("bytes"),
                                F.col("size").cast("long").alias("size"))
    out = stored(named.withColumn("d", F.col("d").cast("long")).union(root), "places")
    discard(rows)
    return out


def nodes(rows: DataFrame) -> DataFrame:
    """One row per node of :func:`places`: its smallest conversation, its counts, and the weight ``w`` of its subtree."""
    found = stored(rows.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.min("d").alias("d"), F.min("parent").alias("parent"), F.count("*").alias("n_convs"),
        F.max("bytes").alias("bytes"), F.sum(F.col("size") - F.col("d") + 1).alias("w")), "nodes")
    children = found.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    above = found.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = found.join(children, "node", "left").join(above, "parent", "left")
    return out.select("node", "parent", "conv_id", "d", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
                      F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaf"),
                      ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"), "w")


def split_forest(parent: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree totals of ``values`` (one row per node) by centroid decomposition, all components of a round at once.

    ``parent`` holds the index of a node's parent, which comes before it, or -1; ``weight`` the positive weight of its subtree.
    """
    n = len(parent)
    own, up, weight = np.arange(n), np.where(parent < 0, np.arange(n), parent), weight.copy()
    alive, totals, left = np.ones(n, bool), np.zeros_like(values), own

    def tops():
        at = up
        while True:
            further = at[at]
            if np.array_equal(further, at):
                return at
            at = further

    while len(left):
        top = tops()
        path = left[2 * weight[left] > weight[top[left]]]
        centroid = np.full(n, -1)
        centroid[top[path]] = path  # parents come first, so the deepest of a component stays
        chosen = centroid[top[path]]
        taken = np.unique(chosen)
        up[taken] = taken
        side = tops()[left]
        below = np.zeros_like(values)
        inside = np.isin(side, taken)
        np.add.at(below, side[inside], values[left[inside]])
        totals[path] += below[chosen]
        weight[path] -= np.where(path == chosen, 0, weight[chosen])
        alive[taken] = False
        left = left[alive[left]]
        loose = left[~alive[up[left]]]
        up[loose] = loose
    return totals


_STATE = ["node", "parent", "conv_id", "d", "parent_conv_id", "n_convs", "n_children", "leaf", "saved", "w", "comp", "total", "leaves", "tokens"]
_RESULT = ["node", "conv_id", "d", "parent_conv_id", "n_convs", "n_children", "leaves", "tokens"]


def _small(parts: DataFrame, limit: int) -> DataFrame:
    """Components within the limit, split to the end: each stands in one partition, and a task holds a few at a time."""

    def solve(table):
        ids, above, comps = (table.column(c).to_pylist() for c in ("node", "parent", "comp"))
        index = {x: i for i, x in enumerate(ids)}
        parent = np.array([index.get(p, -1) if i != c else -1 for i, p, c in zip(ids, above, comps, strict=True)], np.int64)
        values = np.stack([table.column(c).to_numpy() for c in ("leaf", "saved")], axis=1)
        found = split_forest(parent, table.column("w").to_numpy(), values)
        for k, name in enumerate(("leaves", "tokens")):
            sums = pa.array(found[:, k] + table.column(name).to_numpy())
            table = table.set_column(table.column_names.index(name), name, sums)
        return table.select(_RESULT).combine_chunks().to_batches()

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 2 * limit:
                table = pa.Table.from_batches(held)
                comps, stop = table.column("comp").to_pylist(), size
                while stop and comps[stop - 1] == comps[-1]:
                    stop -= 1
                if stop:
                    yield from solve(table.slice(0, stop))
                    held, size = table.slice(stop).to_batches(), size - stop
        if size:
            yield from solve(pa.Table.from_batches(held))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.select(*_RESULT).schema)
    return parts.select(*_STATE).repartition(F.col("comp")).sortWithinPartitions("comp", "d").mapInArrow(run, schema)


def roll_up(trie: DataFrame, rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes with ``leaves`` and ``tokens``: leaves of the subtree and the sum of ``saved`` over it."""
    whole = trie.where("parent IS NULL").select(F.col("node").alias("comp"), F.col("w").alias("total"))  # one row
    state = stored(trie.crossJoin(F.broadcast(whole)).withColumns({"leaves": F.lit(0).cast("long"), "tokens": F.lit(0).cast("long")})
                   .select(*_STATE), "components")
    small, done = [], []
    while True:
        small.append(state.where("comp IS NOT NULL").where(F.col("total") <= limit))
        done.append(state.where("comp IS NULL").select(*_RESULT))
        large = state.where("comp IS NOT NULL").where(F.col("total") > limit)
        if large.isEmpty():
            break
        on_path = F.col("w") * 2 > F.col("total")
        centroids = (large.where(on_path).groupBy("comp").agg(F.max(F.struct("d", "node", "w")).alias("g"))
                     .select("comp", F.col("g.node").alias("g"), F.col("g.d").alias("g_d"), F.col("g.w").alias("g_w")))
        children = large.join(centroids.select(F.col("g").alias("parent")), "parent").select(
            "node", "comp", F.col("w").alias("next_total"))
        passing = rows.select("node", "conv_id").join(children, "node").withColumnRenamed("node", "next")
        marked = stored(large.join(centroids, "comp").join(passing, ["conv_id", "comp"], "left").select(
            *_STATE, "g", "g_w", "next_total", on_path.alias("on_path"), (F.col("node") == F.col("g")).alias("is_g"),
            F.when(F.col("d") > F.col("g_d"), F.col("next")).alias("next")), "split")
        sides = marked.where("is_g OR next IS NOT NULL").groupBy("comp").agg(F.sum("leaf").alias("s_leaves"), F.sum("saved").alias("s_tokens"))
        is_g, inside = F.col("is_g"), F.col("next").isNotNull()
        state = stored(marked.join(sides, "comp").withColumns({
            "leaves": F.col("leaves") + F.when(F.col("on_path"), F.col("s_leaves")).otherwise(0),
            "tokens": F.col("tokens") + F.when(F.col("on_path"), F.col("s_tokens")).otherwise(0),
            "w": F.when(F.col("on_path") & ~is_g, F.col("w") - F.col("g_w")).otherwise(F.col("w")),
            "total": F.when(inside, F.col("next_total")).otherwise(F.col("total") - F.col("g_w")),
            "comp": F.when(is_g, F.lit(None)).when(inside, F.col("next")).otherwise(F.col("comp"))}).select(*_STATE), "components")
        discard(marked)
    parts, ready = small[0], done[0]
    for more, finished in zip(small[1:], done[1:], strict=True):
        parts, ready = parts.union(more), ready.union(finished)
    return ready.union(_small(parts, limit))


def ends(rows: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the ids of the conversations that end at a node, ascending, joined by commas.

    Ids are joined within ranges of (node, id) first, so a node where very many end is read as a few pieces in order.
    """
    order = ["node", "conv_id"]
    last = rows.where("d = size").select(*order)
    pieces = last.repartitionByRange(_partitions(rows), *order).sortWithinPartitions(*order)

    def join(batches):
        for batch in batches:
            names, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at, out = 0, []
            while at < len(ids):
                stop = at + 1
                while stop < len(ids) and stop - at < IDS and names[stop] == names[at]:
                    stop += 1
                out.append((names[at], ids[at], ",".join(map(str, ids[at:stop]))))
                at = stop
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*out, strict=True), (pa.binary(), pa.int64(), pa.string()), strict=True)], ["node", "first", "ids"])

    def digest(batches):
        now, sha = None, None
        for batch in batches:
            out = []
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if name != now:
                    if sha:
                        out.append((now, sha.hexdigest()))
                    now, sha = name, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
            if out:
                yield as_batch(out)
        if sha:
            yield as_batch([(now, sha.hexdigest())])

    def as_batch(out):
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())],
                                          ["node", "ends_sha256"])

    joined = pieces.mapInArrow(join, "node binary, first long, ids string")
    return joined.repartition(F.col("node")).sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): one row per distinct prefix.

    ``turns`` has conv_id, turn, role and text. Turns are ordered by turn, null first, ties by role and text; a null role or text is
    empty; rows without a conv_id are left out; repeated rows are turns of their own. A conversation is rebuilt from the first turns of
    the first one of its group and its own (see :func:`rebuilt`). No conversation gives no rows, one without turns the root alone.
    Texts of any length count by their bytes; other columns are ignored, whatever their names.
    """
    rows = places(turns.select("conv_id", "turn", "role", "text"))
    rolled = roll_up(nodes(rows), rows, limit)
    out = rolled.join(ends(rows), "node", "left")
    return out.select("conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                      F.col("tokens").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
