"""Substring dedup with suffix automata of reference shards.

A window (so many consecutive words) of a document is removed where its words also start in a document with a smaller key.
Documents are reduced to the contexts of their anchors (see ``anchors``), equal contexts to one with its smallest key. The
contexts whose anchor occurs in several documents are the reference, cut into shards by anchor, so that a shard and all texts
that can match it are together. In each shard a suffix automaton is built over its contexts, its states carry the smallest key
that reaches them, and every context is streamed through it: where the matching statistic reaches the window length, the
state's key is the first document with these words. Spans that belong to a smaller key go back to the documents.

Only shards of an anchor with very many different contexts are not built (see SHARD_CONTEXTS): their windows are grouped by
hash, which gives the same keys for any number of contexts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.llm.anchors import context_anchors
from txnlens.llm.common import merge_spans, small_batches, stored, to_bytes, window_hashes, word_spans

WINDOW = 50
GRAM = 16
SHARD_CONTEXTS = 512  # contexts of one anchor beyond which their windows are grouped by hash
COMBINE = 1_000_000  # words whose windows a task compares before it sends them to be grouped
SHARD_WORDS = 20_000  # words after which a shard that is being read closes, at the next anchor

# A row of the tables is known by its key and the hash of its text, so repeated rows share their result.
_ROW = "id_ {}, row_ long"


class SuffixAutomaton:
    """Suffix automaton of several word sequences, each with a key; ``first[state]`` is the smallest key of its words."""

    def __init__(self):
        self.next, self.link, self.length, self.first = [{}], [-1], [0], [None]

    def add(self, symbols, key) -> None:
        nexts, link, length, first = self.next, self.link, self.length, self.first
        last = 0
        for c in symbols:
            here = nexts[last].get(c)
            if here is not None:  # this sequence was seen before: reuse its state, or split it off
                if length[here] == length[last] + 1:
                    last = here
                else:
                    last = self._split(last, here, c)
                if first[last] is None or key < first[last]:
                    first[last] = key
                continue
            new = len(nexts)
            nexts.append({})
            length.append(length[last] + 1)
            first.append(key)
            link.append(0)
            p = last
            while p != -1 and c not in nexts[p]:
                nexts[p][c] = new
                p = link[p]
            if p != -1:
                q = nexts[p][c]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, q, c)
            last = new

    def _split(self, p, q, c):
        nexts, link, length = self.next, self.link, self.length
        copy = len(nexts)
        nexts.append(dict(nexts[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        self.first.append(self.first[q])
        link[q] = copy
        while p != -1 and nexts[p].get(c) == q:
            nexts[p][c] = copy
            p = link[p]
        return copy

    def close(self) -> None:
        """Carry the smallest keys from longer to shorter states along the suffix links."""
        link, first = self.link, self.first
        for state in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            up = link[state]
            if up > 0 and (first[up] is None or first[state] < first[up]):
                first[up] = first[state]

    def stream(self, symbols, window: int) -> list:
        """For every end of a window in ``symbols``: the smallest key whose words hold the window, or None."""
        nexts, link, length, first = self.next, self.link, self.length, self.first
        state, matched, out = 0, 0, []
        for i, c in enumerate(symbols):
            while state and c not in nexts[state]:
                state = link[state]
                matched = length[state]
            state = nexts[state].get(c, 0)
            matched = matched + 1 if state else 0
            if matched >= window:
                matched = window
                while length[link[state]] >= window:
                    state = link[state]
            if i >= window - 1:
                out.append(first[state] if matched >= window else None)
        return out


def occurrences(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(id_, row_, anchor, context, start, size): the contexts of every document, stored."""

    def run(batches):
        for batch in batches:
            cols = [[] for _ in range(6)]
            for i, text in enumerate(batch.column(2).to_pylist()):
                anchor, _, start, end, context = context_anchors(word_spans(to_bytes(text))[2], window, gram)
                for col, values in zip(cols, (np.full(len(anchor), i), anchor, context, start, end - start), strict=False):
                    col.append(values)
            take = pa.array(np.concatenate(cols[0]).astype(np.int64))
            rest = [np.concatenate(c) for c in cols[1:5]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(rest[0]), pa.array(rest[1]),
                 pa.array(rest[2].astype(np.int32)), pa.array(rest[3].astype(np.int32))],
                ["id_", "row_", "anchor", "context", "start", "size"])

    kind = docs.schema["id_"].dataType.simpleString()
    return stored(docs.mapInArrow(run, f"{_ROW.format(kind)}, anchor long, context long, start int, size int"), "contexts")


def contexts(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The word hashes (``words``, little-endian) of the context that each row of ``places`` names, stored."""
    by_row = places.groupBy("id_", "row_").agg(F.collect_list(F.struct("anchor", "context", "start", "size", "crowded")).alias("at_"))
    texts = docs.join(by_row, ["id_", "row_"]).dropDuplicates(["id_", "row_"]).select("id_", "text_", "at_")

    def run(batches):
        for batch in batches:
            for i, text in enumerate(batch.column(1).to_pylist()):
                hashes = word_spans(to_bytes(text))[2]
                at = batch.column(2).slice(i, 1).flatten()
                start, size = at.field("start").to_numpy(), at.field("size").to_numpy()
                data = [hashes[a:a + n].tobytes() for a, n in zip(start.tolist(), size.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.full(len(data), i))), at.field("anchor"), at.field("context"),
                     at.field("crowded"), pa.array(data, pa.binary())], ["id_", "anchor", "context", "crowded", "words"])

    kind = docs.schema["id_"].dataType.simpleString()
    return stored(texts.mapInArrow(run, f"id_ {kind}, anchor long, context long, crowded boolean, words binary"), "reference")


def first_keys(reference: DataFrame, window: int, shard_words: int) -> DataFrame:
    """(anchor, context, runs): for every context its runs of windows (from, to, key) with the first key of each."""
    kind = reference.schema["id_"].dataType.simpleString()

    def shards(frames):
        """Whole anchors up to ``shard_words`` words; rows arrive sorted by anchor."""
        waiting, size = [], 0
        for frame in frames:
            for row in frame.itertuples(index=False):
                if size >= shard_words and row.anchor != waiting[-1].anchor:
                    yield waiting
                    waiting, size = [], 0
                waiting.append(row)
                size += len(row.words) // 8
        if waiting:
            yield waiting

    def run(frames):
        for shard in shards(frames):
            automaton, texts, codes = SuffixAutomaton(), [], {}
            for row in shard:
                text = [codes.setdefault(w, len(codes)) for w in np.frombuffer(row.words, np.uint64).tolist()]
                automaton.add(text, row.id_)
                texts.append(text)
            automaton.close()
            rows = []
            for row, text in zip(shard, texts, strict=True):
                runs = []
                for i, key in enumerate(automaton.stream(text, window)):
                    if runs and runs[-1]["key"] == key:
                        runs[-1]["to"] = i
                    else:
                        runs.append({"from": i, "to": i, "key": key})
                rows.append((row.anchor, row.context, runs))
            yield pd.DataFrame(rows, columns=["anchor", "context", "runs"])

    dealt = reference.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInPandas(run, f"anchor long, context long, runs array<struct<from: int, to: int, key: {kind}>>")


def crowded_keys(reference: DataFrame, window: int, combine: int = COMBINE) -> DataFrame:
    """The same rows for anchors with very many contexts: every window is grouped by its hash, whatever their number.

    Only windows for which no smaller key is at hand leave a task. Of these the ones whose key is the smallest of all stay with
    their context; its other windows start in a document smaller than any that has the context, and their key is null.
    """

    def first_at_hand(batch):
        """Windows of these contexts, but for those that a context with a smaller key holds as well."""
        words = [np.frombuffer(x, np.uint64) for x in batch.column(3).to_pylist()]
        hashes = [window_hashes(x, window) for x in words]
        h, many = np.concatenate(hashes).view(np.int64), np.array([len(x) for x in hashes])
        at = np.repeat(np.arange(len(many)), many)
        i = np.arange(len(h)) - np.repeat(np.cumsum(many) - many, many)
        rank = pd.Series(batch.column(0).to_pylist()).rank(method="dense").to_numpy(np.int64)
        lowest = pd.Series(rank[at]).groupby(h).transform("min").to_numpy()
        keep = rank[at] == lowest
        take = pa.array(at[keep])
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(take) for c in range(3)), pa.array(h[keep]), pa.array(i[keep].astype(np.int32))],
            ["id_", "anchor", "context", "h", "i"])

    def strings_of(batches):
        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.nbytes // 8
            if size >= combine:
                yield first_at_hand(pa.concat_batches(waiting))
                waiting, size = [], 0
        if sum(len(x) for x in waiting):
            yield first_at_hand(pa.concat_batches(waiting))

    def run(frames):
        for frame in frames:
            runs = []
            for n, key, own in zip(frame["n"], frame["id_"], frame["own"], strict=True):
                first = np.zeros(n, bool)
                first[[] if own is None else np.asarray(own, np.int64)] = True
                cuts = [0, *(np.flatnonzero(first[1:] != first[:-1]) + 1).tolist(), n]
                runs.append([{"from": x, "to": y - 1, "key": key if first[x] else None} for x, y in zip(cuts, cuts[1:], strict=False)])
            yield pd.DataFrame({"anchor": frame["anchor"], "context": frame["context"], "runs": runs})

    kind = reference.schema["id_"].dataType.simpleString()
    # contexts of one anchor come together, in as many tasks as their number asks for
    dealt = reference.select("id_", "anchor", "context", "words").repartitionByRange("anchor", "context")
    windows = dealt.mapInArrow(
        strings_of, f"id_ {kind}, anchor long, context long, h long, i int")
    first = windows.groupBy("h").agg(F.min("id_").alias("id_"))
    own = windows.join(first, ["h", "id_"]).groupBy("anchor", "context").agg(F.collect_list("i").alias("own"))
    texts = reference.select("id_", "anchor", "context", F.expr(f"int(octet_length(words) / 8) - {window - 1}").alias("n"))
    return texts.join(own, ["anchor", "context"], "left").mapInPandas(
        run, f"anchor long, context long, runs array<struct<from: int, to: int, key: {kind}>>")


def removed_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_contexts: int = SHARD_CONTEXTS,
                  shard_words: int = SHARD_WORDS) -> DataFrame:
    """(id_, row_, spans): word spans [from, to) that windows of smaller keys cover. ``docs``: (id_, row_, text_)."""
    spots = occurrences(docs.where("id_ IS NOT NULL"), window, gram)
    unlike = spots.groupBy("anchor", "context").agg(
        F.min(F.struct("id_", "row_", "start", "size")).alias("at_"), F.max("id_").alias("last_"))
    unlike = stored(unlike, "unlike-contexts")
    shared = unlike.groupBy("anchor").agg(F.min("at_.id_").alias("low_"), F.max("last_").alias("high_"),
                                          F.count("*").alias("n_")).where("low_ < high_")
    places = unlike.join(shared, "anchor").select("anchor", "context", "at_.*", (F.col("n_") > shard_contexts).alias("crowded"))
    reference = contexts(docs, places)
    keys = first_keys(reference.where("NOT crowded"), window, shard_words).unionByName(
        crowded_keys(reference.where("crowded"), window))
    found = spots.join(stored(keys, "first-keys"), ["anchor", "context"]).select(
        "id_", "row_", F.expr("transform(filter(runs, r -> r.key IS NULL OR r.key < id_), "
                              f"r -> struct(start + r.from AS from, start + r.to + {window} AS to))").alias("spans_"))
    return found.where("size(spans_) > 0").groupBy("id_", "row_").agg(F.flatten(F.collect_list("spans_")).alias("spans"))


def without(data: bytes, starts: np.ndarray, spans) -> bytes:
    """A text without the words of the spans [from, to) and the white space after them; all else stays as it is."""
    edges = [*starts.tolist(), len(data)]
    out, at = [], 0
    for a, b in spans:
        out.append(data[at:edges[a]])
        at = edges[b]
    return b"".join([*out, data[at:]])


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
          into: str = "dedup_", as_text: bool = False) -> DataFrame:
    """The rows of ``docs`` with a struct column ``into``: n_words, n_removed, kept (the words left, joined by one space; with
    ``as_text`` the text as it was but for the removed spans, null for null). An input column of that name gives way.

    Keys must be orderable. A null text has no words; rows with a null key are kept whole and remove nothing; rows with equal
    keys remove nothing from each other, as neither key is smaller. An empty table gives no rows. All columns pass through.
    """
    small_batches(docs.sparkSession)
    given = docs.select(F.col(f"`{id_col}`").alias("id_"), F.xxhash64(F.col(f"`{text_col}`")).alias("row_"),
                        F.col(f"`{text_col}`").alias("text_"),
                        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != into]).alias("all_"))
    spans = removed_spans(given.select("id_", "row_", "text_"), window, gram)
    spans = spans.withColumnsRenamed({"id_": "i_", "row_": "r_"})
    joined = given.join(spans, (F.col("id_") == F.col("i_")) & (F.col("row_") == F.col("r_")), "left")

    @F.pandas_udf("n_words long, n_removed long, kept string")
    def cut(texts: pd.Series, begins: pd.Series, stops: pd.Series) -> pd.DataFrame:
        rows = []
        for text, begin, stop in zip(texts, begins, stops, strict=True):
            data = to_bytes(text)
            starts, ends, _ = word_spans(data)
            keep, removed = np.ones(len(starts), bool), []
            if begin is not None:
                removed = list(zip(*merge_spans(np.asarray(begin), np.asarray(stop)), strict=True))
                for a, b in removed:
                    keep[a:b] = False
            if as_text:
                left = None if text is None else without(data, starts, removed).decode("utf-8", "surrogatepass")
                rows.append((len(keep), int((~keep).sum()), left))
                continue
            words = [data[a:b] for a, b in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)]
            rows.append((len(keep), int((~keep).sum()), b" ".join(words).decode("utf-8", "surrogatepass")))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])

    return joined.select("all_", cut("text_", "spans.from", "spans.to").alias("new_")).select("all_.*", F.col("new_").alias(into))
