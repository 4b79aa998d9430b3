"""Phrases whose words belong together, from sorted count streams: nothing is grouped by a hash.

Tasks cut texts into windows of the longest phrase, count them within a few megabytes and deal them out by ranges of their
bytes, so that each partition is one stretch of a single stream in prefix order. Every phrase is a prefix of windows that stand
together there, so one pass over a stretch adds up the phrases of every length and lets only frequent ones through. The
frequent phrases are then walked twice, in suffix order (words reversed) and in prefix order: a phrase stands below its parts, so
one pass in lockstep meets, for each phrase, the counts of its last or first words and of its extensions by one word.

Stretches end anywhere, also inside the phrases of one very common word. What a stretch cannot know, the counts of the phrases
open at its border, is a handful of rows per partition, added afterwards.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlens.llm.common import stored, to_bytes

LONGEST = 4     # words of a phrase
LEAST = 30      # occurrences of a phrase
SCALE = 2_000_000
SHARE = (80, 100)  # a longer phrase with this share of the occurrences replaces its parts
TOP = 2_000
CHUNK = 8_000_000  # bytes of text whose windows are counted together
ROWS = 60_000      # windows of a stream that are added up at a time
SAMPLED = 2_000    # about so many texts tell where the ranges end; their choice changes the layout, never the result
STEP = 64
NO_LANG = "und"
# Words and the characters that end a piece.
_TOKEN = re.compile(rb"[^\x20\x09.,;:!?\x0a-\x0d]+|[.,;:!?\x0a-\x0d]")
_ENDS = [bytes([c]) for c in b".,;:!?\n\x0b\x0c\r"]
_CUT = re.compile(rb"[.,;:!?\x0a-\x0d]")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class _Numbers(dict):
    """Words -> numbers in order of appearance; characters that end a piece are 0."""

    def __init__(self):
        super().__init__(dict.fromkeys(_ENDS, 0))

    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def escaped(word: bytes) -> bytes:
    """Words are joined by a zero byte, below all others: phrases with a common prefix stand together."""
    if b"\x01" in word or b"\x00" in word:
        return word.replace(b"\x01", b"\x01\x02").replace(b"\x00", b"\x01\x01")
    return word


def _order(codes: np.ndarray, more: np.ndarray, size: int) -> np.ndarray:
    """Numbers that order like the pairs of ``codes`` and ``more`` (below ``size``)."""
    if len(codes) and (int(codes.max()) + 1) * size >= 1 << 62:
        codes = np.unique(codes, return_inverse=True)[1]
    return codes * size + more


class Windows:
    """The distinct windows of some texts in byte order, with their counts."""

    def __init__(self, texts: list[tuple[bytes, bytes]], longest: int = LONGEST):
        numbers, langs, parts, sizes = _Numbers(), sorted({lang for lang, _ in texts}), [], []
        of_lang = {lang: i for i, lang in enumerate(langs)}
        for _, data in texts:
            found = _TOKEN.findall(data)
            parts += [np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)), np.zeros(1, np.int64)]
            sizes.append(len(found) + 1)
        ids = np.concatenate([*parts, np.zeros(longest, np.int64)])
        lang = np.repeat([of_lang[x] for x, _ in texts], sizes)
        words = [escaped(w) for w in list(numbers)[len(_ENDS):]]
        by_bytes = sorted(range(len(words)), key=words.__getitem__)
        rank = np.zeros(len(words) + len(_ENDS), np.int64)
        rank[np.array(by_bytes, np.int64) + len(_ENDS)] = np.arange(1, len(words) + 1)
        ids, n = rank[ids], len(ids) - longest
        at = np.flatnonzero(ids[:n])
        columns, codes = [lang[at]], lang[at]
        for j in range(longest):
            word = ids[at + j]
            if j:
                word[columns[-1] == 0] = 0  # a window ends with its piece
            columns.append(word)
            codes = _order(codes, word, len(words) + 1)
        _, first, self.counts = np.unique(codes, return_index=True, return_counts=True)
        self.columns = [c[first] for c in columns]
        self.langs, self.words = [escaped(x) for x in langs], [words[i] for i in by_bytes]

    def keys(self, chosen=slice(None)) -> pa.Array:
        """Language and words of the windows, joined."""
        words = pa.array([None, *self.words], pa.binary())
        parts = [pa.array(self.langs, pa.binary()).take(pa.array(self.columns[0][chosen]))]
        parts += [words.take(pa.array(c[chosen])) for c in self.columns[1:]]
        return pc.binary_join_element_wise(*parts, pa.scalar(b"\x00", pa.binary()), null_handling="skip")

    def before(self, bound: tuple[bytes, ...]) -> int:
        """How many windows stand before a bound."""
        low, high = 0, len(self.counts)
        for known, column, part in zip([self.langs] + [self.words] * len(self.columns), self.columns, bound, strict=False):
            place = bisect_left(known, part)
            exact, number = place < len(known) and known[place] == part, place + (known is self.words)
            here = column[low:high]
            start = low + int(np.searchsorted(here, number))
            if not exact:
                return start
            low, high = start, low + int(np.searchsorted(here, number, side="right"))
        return low

    def parts(self, bounds: list[tuple[bytes, ...]]) -> np.ndarray:
        """The range in which each window stands."""
        inside = np.zeros(len(self.counts) + 1, np.int64)
        np.add.at(inside, [self.before(b) for b in bounds], 1)
        return np.cumsum(inside[:-1])


def _chunks(batches):
    """Lists of (language, text in lower case) of a few megabytes; a long text is cut where a piece ends."""
    held, size = [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            data, at = to_bytes(text.as_py()).translate(_LOWER), 0
            while at < len(data):
                end = _CUT.search(data, at + CHUNK) if len(data) - at > CHUNK else None
                stop = end.end() if end else len(data)
                held.append((to_bytes(lang.as_py()), data[at:stop]))
                size, at = size + stop - at, stop
                if size >= CHUNK:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang_"), F.col(text_col).alias("text_"))


def ranges(texts: DataFrame, partitions: int, longest: int) -> list[tuple[bytes, ...]]:
    """At most ``partitions`` - 1 bounds that cut the stream into stretches of about one size, from a sample of the texts."""
    share = min(1.0, SAMPLED / max(1, texts.count()))

    def run(batches):
        for chunk in _chunks(batches):
            found = Windows(chunk, longest)
            total = np.cumsum(found.counts)
            at = np.searchsorted(total, np.arange(0, total[-1] if len(total) else 0, STEP), side="right")
            yield pa.RecordBatch.from_arrays([pc.binary_slice(found.keys(at), 0, 200)], ["key"])

    found = sorted(bytes(r[0]) for r in texts.sample(False, share, 11).mapInArrow(run, "key binary").collect())
    chosen = {found[len(found) * i // partitions] for i in range(1, partitions)} if found else set()
    return [tuple(key.split(b"\x00")) for key in sorted(chosen)]


def _prefix_ends(offsets: np.ndarray, data: np.ndarray, longest: int) -> np.ndarray:
    """For each key the byte at which its first 0, 1, ... words end, -1 beyond its last."""
    n = len(offsets) - 1
    at = np.flatnonzero(data[offsets[0]:offsets[-1]] == 0) + offsets[0]
    row = np.searchsorted(offsets, at, side="right") - 1
    words = np.bincount(row, minlength=n)
    ends = np.full((n, longest + 1), -1, np.int64)
    ends[row, np.arange(len(at)) - np.repeat(np.cumsum(words) - words, words)] = at - offsets[row]
    ends[np.arange(n), words] = np.diff(offsets)
    return ends


def _common(offsets: np.ndarray, data: np.ndarray, before: bytes) -> np.ndarray:
    """For each key how many of its first bytes are those of the key before it."""
    sizes = np.diff(offsets)
    earlier = np.r_[len(before), sizes[:-1]]
    row_start = np.repeat(offsets[:-1] - offsets[0], sizes)
    place = np.arange(int(sizes.sum()))
    inside = place - row_start
    whole = np.concatenate([np.frombuffer(before, np.uint8), data[offsets[0]:offsets[-1]]])
    shift = np.repeat(earlier, sizes)
    differs = (inside >= shift) | (whole[place + len(before)] != whole[place + len(before) - shift])
    first = np.where(differs, inside, np.iinfo(np.int64).max)
    return np.minimum(np.minimum.reduceat(first, offsets[:-1] - offsets[0]), sizes)


class Runs:
    """Adds up the prefixes of one stretch of the stream. Rows out: (key, words, occurrences, whether it may go on elsewhere)."""

    def __init__(self, longest: int, least: int):
        self.longest, self.least = longest, least
        self.open: list = [None] * (longest + 1)  # by length the last prefix met: its key, its count, whether it stood first
        self.last, self.out = b"", []

    def _close(self, words: int, at_end: bool = False) -> None:
        if self.open[words] is not None:
            key, count, edge = self.open[words]
            edge = edge or at_end and self.last.split(b"\x00")[:words + 1] == key.split(b"\x00")
            if edge or words == 0 or count >= self.least:
                self.out.append((key, words, count, edge))

    def add(self, keys: pa.Array, counts: np.ndarray) -> None:
        if not len(keys):
            return
        offsets = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset:keys.offset + len(keys) + 1].astype(np.int64)
        data = np.frombuffer(keys.buffers()[2], np.uint8)
        start = self.last == b""
        ends, common = _prefix_ends(offsets, data, self.longest), _common(offsets, data, self.last)
        earlier = np.vstack([_prefix_ends(np.array([0, len(self.last)]), np.frombuffer(self.last, np.uint8), self.longest), ends[:-1]])
        same = (ends >= 0) & (earlier == ends) & (common[:, None] >= ends)
        if start:
            same[0] = False
        for words in range(self.longest + 1):
            has = ends[:, words] >= 0
            at, n = np.flatnonzero(has & ~same[:, words]), np.where(has, counts, 0)
            if self.open[words] is not None:
                key, count, edge = self.open[words]
                self.open[words] = (key, count + int(n[:at[0]].sum() if len(at) else n.sum()), edge)
            if not len(at):
                continue
            self._close(words)
            sums = np.add.reduceat(n, at)
            edge = start and at[0] == 0
            for i in np.flatnonzero((sums[:-1] >= self.least) | (words == 0) | (edge & (np.arange(len(at) - 1) == 0))):
                self.out.append((self._key(keys, at[i], ends, words), words, int(sums[i]), bool(edge and i == 0)))
            self.open[words] = (self._key(keys, at[-1], ends, words), int(sums[-1]), bool(edge and len(at) == 1))
        self.last = keys[len(keys) - 1].as_py()

    @staticmethod
    def _key(keys, row, ends, words) -> bytes:
        return keys[int(row)].as_py()[:ends[row, words]]

    def taken(self) -> list:
        rows, self.out = self.out, []
        return rows

    def ended(self) -> list:
        for words in range(self.longest + 1):
            self._close(words, at_end=True)
        return self.taken()


def turned(key: bytes) -> bytes:
    """Language and words from the last to the first."""
    lang, *words = key.split(b"\x00")
    return b"\x00".join([lang, *reversed(words)])


_COUNTS = "prefix binary, suffix binary, words int, n long, edge boolean"


def _counted(rows):
    keys = [r[0] for r in rows]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.binary()), pa.array(map(turned, keys), pa.binary()), pa.array([r[1] for r in rows], pa.int32()),
         pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.bool_())],
        ["prefix", "suffix", "words", "n", "edge"])


def counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(prefix, suffix, words, n): every phrase of up to ``longest`` words with ``least`` or more occurrences, and every language
    (words 0) with the number of its words. ``prefix`` and ``suffix`` are the phrase's keys in the two orders."""
    texts = _texts(docs, lang_col, text_col)
    partitions = _partitions(docs)
    bounds = ranges(texts, partitions, longest)

    def windows(batches):
        for chunk in _chunks(batches):
            found = Windows(chunk, longest)
            part = found.parts(bounds)
            for low in range(0, len(part), ROWS):
                chosen = slice(low, low + ROWS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[chosen].astype(np.int32)), found.keys(chosen), pa.array(found.counts[chosen])], ["part", "key", "n"])

    def added(batches):
        runs, held, size = Runs(longest, least), [], 0

        def add():
            table = pa.Table.from_batches(held).combine_chunks()
            for batch in table.to_batches():
                runs.add(batch.column(0), batch.column(1).to_numpy())

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= ROWS:
                add()
                held, size = [], 0
                if len(runs.out) >= 10_000:
                    yield _counted(runs.taken())
        if size:
            add()
        yield _counted(runs.ended())

    stream = texts.mapInArrow(windows, "part int, key binary, n long").repartitionById(partitions, F.col("part"))
    found = stored(stream.select("key", "n").sortWithinPartitions("key").mapInArrow(added, _COUNTS), "phrases")
    # at most two phrases of a length for each partition stand at its borders
    edges = found.where("edge").groupBy("prefix", "suffix", "words").agg(F.sum("n").alias("n"))
    return found.where("NOT edge").drop("edge").union(edges.where((F.col("words") == 0) | (F.col("n") >= least)))


def annotate(phrases: DataFrame, order: str, label: str, longest: int = LONGEST) -> DataFrame:
    """Each phrase with ``{order}_0`` ... the counts of its first words in ``order`` (``prefix`` or ``suffix``; 0: the language),
    null for parts as long as the phrase, and ``{order}_more``, the largest count of an extension by one word, 0 if there is none.

    The phrases are dealt out by ranges of ``order`` and walked in it. Other columns are passed through.
    """
    more, parts = f"{order}_more", [f"{order}_{k}" for k in range(longest)]
    kept = [c for c in phrases.columns if c != order]
    names = [order, *kept, *parts, more]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in phrases.select(order, *kept).schema), "part int",
                        "open boolean", *(f"{c} long" for c in (*parts, more))])

    def run(batches):
        here, path, words_before, out, types = TaskContext.get().partitionId(), [], [], [], None
        names_in = [order, *kept]
        at_n, at_words = names_in.index("n"), names_in.index("words")

        def batch_of(rows):
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                              [*names_in, "part", "open", *parts, more])

        def leave(depth):
            """Phrases below ``depth`` are complete: nothing that follows extends them."""
            while len(path) > depth:
                row, counts_above, largest, known = path.pop()
                out.append((*row, here, not known, *counts_above, *[None] * (longest - len(counts_above)), largest))

        for batch in batches:
            types = types or [*(f.type for f in batch.schema), pa.int32(), pa.bool_(), *[pa.int64()] * (longest + 1)]
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words, n = row[0].split(b"\x00"), row[at_n]
                same = 0
                while same < len(words_before) and same < len(words) - 1 and words_before[same] == words[same]:
                    same += 1
                leave(same)
                for depth in range(same, len(words) - 1):  # parts that stand in an earlier stretch
                    blank = [None] * len(names_in)
                    blank[0], blank[at_words] = b"\x00".join(words[:depth + 1]), depth
                    path.append([tuple(blank), [p[0][at_n] for p in path], 0, False])
                if path:
                    path[-1][2] = max(path[-1][2], n)
                path.append([row, [p[0][at_n] for p in path], 0, True])
                words_before = words
                if len(out) >= 10_000:
                    yield batch_of(out)
                    out = []
        leave(0)
        if out:
            yield batch_of(out)

    partitions = _partitions(phrases)
    ordered = phrases.select(order, *kept).repartitionByRange(partitions, order).sortWithinPartitions(order)
    walked = stored(ordered.mapInArrow(run, schema), label)
    rows, opened = walked.where("NOT open").drop("open"), walked.where("open").select(order, "part", "words", more)
    # at most ``longest`` rows for each partition: its first phrase's parts that stand before it
    filled = (opened.join(rows.select(order, "n"), order).groupBy("part")
              .agg(*[F.max(F.when(F.col("words") == k, F.col("n"))).alias(f"n_{k}") for k in range(longest)]))
    largest = opened.groupBy(order).agg(F.max(more).alias("more_"))
    rows = rows.join(F.broadcast(filled), "part", "left").join(F.broadcast(largest), order, "left")
    return rows.select(order, *kept, *[F.when(F.col("words") > k, F.coalesce(c, f"n_{k}")).alias(c) for k, c in enumerate(parts)],
                       F.greatest(more, F.coalesce("more_", F.lit(0))).alias(more)).select(*names)


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST,
                 share: tuple[int, int] = SHARE, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): of each language the ``top`` phrases of two words and more that hold together best.

    Words are runs without space and tab within pieces that end at ``.,;:!?`` and line breaks; A-Z are lower-cased. ``a`` counts a
    phrase, ``l`` and ``r`` its two parts at the cut with the lowest score ``SCALE * a / (l + r)`` (floored; the first such cut),
    ``n`` the words of the language. A phrase goes if one that holds it has ``share`` of its occurrences: a longer one has no
    more than those between, so extensions by one word tell. Ties in rank: higher ``a``, then the phrase in byte order.
    A null language is ``und``, a null text empty; every row counts, repeated or with a null key; an empty table or one without a
    frequent phrase gives no rows. Very long texts are cut between pieces. Other columns are ignored, whatever their names.
    """
    both = annotate(annotate(counts(docs, lang_col, text_col, least, longest), "suffix", "phrases-suffix", longest),
                    "prefix", "phrases-prefix", longest)
    cuts = []
    for k in range(1, longest):
        left = f"prefix_{k}"
        right = "CASE " + " ".join(f"WHEN words = {m} THEN suffix_{m - k}" for m in range(k + 1, longest + 1)) + " END"
        score = f"CAST({SCALE} AS DECIMAL(18,0)) * CAST(n AS DECIMAL(20,0)) DIV CAST({left} + {right} AS DECIMAL(20,0))"
        cuts.append(F.expr(f"CASE WHEN words > {k} THEN named_struct('score', {score}, 'k', {k}, 'l', {left}, 'r', {right}) END"))
    largest = F.greatest("prefix_more", "suffix_more").cast("decimal(20,0)")
    kept = both.where(F.col("words") >= 2).where(largest * share[1] < F.col("n").cast("decimal(20,0)") * share[0])
    parts = F.transform(F.split(F.col("prefix").cast("string"), "\\x00"),
                        lambda w: F.replace(F.replace(w, F.lit("\x01\x01"), F.lit("\x00")), F.lit("\x01\x02"), F.lit("\x01")))
    kept = kept.select(F.array_min(F.array_compact(F.array(*cuts))).alias("cut"), parts.alias("parts"), F.col("n").alias("a"),
                       F.col("prefix_0").alias("n"))
    kept = kept.select(F.col("parts")[0].alias("lang"), F.array_join(F.slice("parts", 2, longest), " ").alias("phrase"), "a",
                       "cut.l", "cut.r", "n", "cut.score")
    best = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(_partitions(docs)))  # a language's best are among the best of its parts
    kept = kept.withColumn("part", part)
    for by in (["lang", "part"], ["lang"]):
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*best))).where(F.col("rank") <= top)
    return kept.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
