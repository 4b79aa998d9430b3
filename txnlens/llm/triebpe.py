"""BPE encoding over a trie of the distinct words: the encoding of a shared prefix is computed once.

An encoding is fixed by its neighbours: a row of tokens is what the merges make of its bytes exactly if every two neighbours stay
apart when their bytes are merged alone. So the encoding of a prefix is the encoding of a shorter prefix and one last token, and
a prefix is a node of the trie, found by its bytes, once a word ends there or a token may begin there; other prefixes are passed
by. Distinct words are inserted in order, which visits the trie depth first; a new node tries the tokens that end there and takes
the one that stays apart from the last token of the node where it starts. Words that come again, in any later batch of the
worker, are looked up whole; where its tables start anew, the words of the batch at hand that were known stay.
"""

from __future__ import annotations

import json
from struct import unpack

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from txnlens.llm.bpe import _NOT_LATIN, PATTERN, Encoder, merge
from txnlens.llm.packing import byte_alphabet

NODES = 400_000  # nodes, words and checked neighbours that a worker keeps; it starts anew beyond
WORDS = 200_000
CHECKED = 400_000
LONGEST = 64     # bytes of words kept; longer ones take a branch of their own that is dropped
SLICE = 2_000_000  # characters of text held as pre-tokens at a time
_NEVER = 1 << 62
_ONE = (1,)
_LIBRARY = ByteLevel(add_prefix_space=False)


class Vocabulary:
    """Tokens and merges of a byte-level vocabulary file. Its size follows the file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.ids = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.added}
        self.pairs: dict[int, dict[int, int]] = {}  # right -> left -> rank of their merge
        self.halves: dict[int, tuple[int, int, int]] = {}  # token -> (left, right, rank)
        ranks = {token: -1 for token in self.ids if len(token) == 1}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = (bytes(alphabet[c] for c in half) for half in (pair.split(" ") if isinstance(pair, str) else pair))
            if left + right in ranks or left not in ranks or right not in ranks:
                raise ValueError(f"merge {rank} does not make a new token of earlier ones")
            ranks[left + right] = rank
            key = self.ids[left], self.ids[right]
            self.pairs.setdefault(key[1], {})[key[0]] = rank
            self.halves[self.ids[left + right]] = (*key, rank)
        # only tokens that their own bytes merge into can stand in an encoding
        alone = {token for token in ranks if len(token) == 1 or merge(token, ranks) == [ranks[token]]}
        self.tokens = {token: i for token, i in self.ids.items() if token in alone}
        lengths: dict[bytes, set] = {}  # by the last three bytes: how long the tokens are that end so
        for token in self.tokens:
            lengths.setdefault(token[-3:], set()).add(len(token))
        self.lengths = {end: (*sorted(found | {n for n in (1, 2) if end[-n:] in self.tokens}, reverse=True),)
                        for end, found in lengths.items()}
        self.sides: dict[tuple[int, bool], list] = {}  # filled as neighbours are met
        self.by_id = {i: token for token, i in self.ids.items()} | {i: s.encode() for s, i in self.added.items()}

    def side(self, token: int, right: bool) -> list[tuple[int, int]]:
        """(token, rank of the merge that ends it) of what stands at one end of a token while its bytes are merged, last first."""
        out, until = [], _NEVER
        while True:
            out.append((token, until))
            if token not in self.halves:
                return out
            *halves, until = self.halves[token]
            token = halves[right]

    def apart(self, left: int, right: int) -> bool:
        """Whether two neighbours stay as they are: nothing at their border ever merges across it.

        A merge takes place while both sides stand; of equal ranks the left one comes first, so a merge across must be strictly
        earlier than the one that takes its left side away.
        """
        sides = self.sides
        ends = sides.get((left, True)) or sides.setdefault((left, True), self.side(left, True))
        for b, until_b in sides.get((right, False)) or sides.setdefault((right, False), self.side(right, False)):
            ranks = self.pairs.get(b)
            if ranks is not None:
                for a, until_a in ends:
                    rank = ranks.get(a)
                    if rank is not None and rank < until_a and rank <= until_b:
                        return False
        return True


class TrieEncoder(Encoder):
    """Encodes texts, keeping trie and words between them."""

    def __init__(self, vocabulary: Vocabulary, pattern: str = PATTERN):
        super().__init__(None, pattern)
        self.vocabulary, self.lengths = vocabulary, vocabulary.lengths
        self.tokens = {token: i.to_bytes(4, "little") for token, i in vocabulary.tokens.items()}
        self.sizes = {i: len(token) for token, i in self.tokens.items()}
        self.checked: dict[bytes, bool] = {}
        self.special = regex.compile("(" + "|".join(
            regex.escape(s) for s in sorted(vocabulary.added, key=len, reverse=True)) + ")") if vocabulary.added else None
        self.clear()

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a text. Engines know different versions of Unicode, so beyond Latin letters the library's own splits."""
        if not self.latin or _NOT_LATIN.search(text) is None:
            return super().split(text)
        return [text[start:end] for _, (start, end) in _LIBRARY.pre_tokenize_str(text)]

    def clear(self) -> None:
        self.last: dict[bytes, bytes] = {b"": b""}  # the nodes, by prefix: ids of its encoding, its last token's at the end
        self.memo: dict[str, bytes] = {}

    def _last(self, word: bytes, end: int, done: list[bytes] | None = None) -> bytes:
        """Ids of ``word[:end]``, a new node. With ``done``, the last ids of all shorter prefixes: its last id, and no node."""
        tokens, checked, last = self.tokens, self.checked, self.last
        lengths = self.lengths
        for length in (lengths.get(word[end - 3:end]) if end > 2 else None) or (
                lengths.get(word[end - 2:end]) if end > 1 else None) or _ONE:
            start = end - length
            if start < 0:
                continue
            token = tokens.get(word[start:end])
            if token is None:
                continue
            before = done[start] if done is not None else last.get(word[:start]) if start else b""
            if before is None:
                before = self._last(word, start)
            if start:
                key = before[-4:] + token
                fits = checked.get(key)
                if fits is None:
                    if len(checked) > CHECKED:
                        checked.clear()
                    fits = checked[key] = self.vocabulary.apart(*unpack("<II", key))
                if not fits:
                    continue
            if done is not None:
                return token
            ids = last[word[:end]] = before + token
            return ids
        raise ValueError("the vocabulary lacks a byte")

    def _branch(self, word: bytes) -> bytes:
        """The same for a long word, on a branch that is not kept."""
        done, ids, end = [b""], [], len(word)
        for i in range(1, end + 1):
            done.append(self._last(word, i, done))
        while end:
            ids.append(done[end])
            end -= self.sizes[done[end]]
        ids.reverse()
        return b"".join(ids)

    def resolve(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of distinct pre-tokens, in order of their bytes: the trie is walked depth first. Long ones are returned only."""
        memo, last, long = self.memo, self.last, {}
        for text in sorted(pieces):
            word = text.encode("utf-8", "surrogatepass")
            if len(word) > LONGEST:
                long[text] = self._branch(word)
            else:
                memo[text] = last.get(word) or self._last(word, len(word))
        return long

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        added, parts = self.vocabulary.added, []
        for text in texts:
            if self.special is not None and text and self.special.search(text):
                spans = self.special.split(text)
                parts.append([x for i, s in enumerate(spans) for x in ([added[s]] if i % 2 else self.split(s))])
            else:
                parts.append(self.split(text) if text else [])
        memo = self.memo
        met = {p for p in set().union(*parts) if p.__class__ is str}
        new = met.difference(memo)
        if len(self.last) > NODES or len(memo) + len(new) > WORDS:
            self.clear()
            self.memo.update((p, memo[p]) for p in met.difference(new))
        long = self.resolve(new)
        memo, out = self.memo, []
        for part in parts:
            try:
                out.append(b"".join(map(memo.__getitem__, part)))
            except KeyError:
                out.append(b"".join([memo[p] if p in memo else long[p] if p in long else p.to_bytes(4, "little") for p in part]))
        return out


def tables(spark, path: str):
    """The vocabulary, broadcast: a vocabulary file has a fixed size."""
    return spark.sparkContext.broadcast(Vocabulary(path))


_workers: dict = {}


def _encoder(shared, pattern: str) -> TrieEncoder:
    """The encoder of this worker process: tasks that follow each other share its trie."""
    key = shared.id if hasattr(shared, "id") else id(shared), pattern
    if _workers.get("key") != key:
        _workers.update(key=key, encoder=TrieEncoder(shared.value, pattern))
    return _workers["encoder"]


def to_text(ids: bytes | None, by_id: dict[int, bytes]) -> str | None:
    return None if ids is None else b"".join(map(by_id.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def encode(docs: DataFrame, shared, id_col: str = "doc_id", text_col: str = "text", pattern: str = PATTERN,
           round_trip: bool = False) -> DataFrame:
    """(id_col, ids): little-endian unsigned 32-bit ids of every whole text, as the tokenizers library gives them without
    truncation, padding and template tokens; strings of added tokens in a text get their ids.

    Null and empty texts have no ids (empty bytes). Keys are kept as they are, null or repeated, and every row gives one row; an
    empty table gives none. A very long text or word takes time in proportion. Other columns are ignored, whatever their names.
    ``shared`` comes from :func:`tables`. With ``round_trip`` the ids are decoded again in the same task, as ``decoded``.
    """

    def run(batches):
        encoder = _encoder(shared, pattern)
        for batch in batches:
            keys, texts, at = batch.column(0), batch.column(1), 0
            while at < len(texts):
                part, stop, size = [], at, 0
                while stop < len(texts) and (stop == at or size < SLICE):
                    part.append(texts[stop].as_py())
                    size += len(part[-1] or "")
                    stop += 1
                ids = encoder.encode(part)
                columns = [keys.slice(at, stop - at), pa.array(ids, pa.binary())]
                if round_trip:
                    columns.append(pa.array([to_text(x, encoder.vocabulary.by_id) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)
                at = stop

    slim = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
    kind = slim.schema["id_"].dataType.simpleString()
    names = ["id_", "ids", *["decoded"] * round_trip]
    schema = f"id_ {kind}, ids binary" + ", decoded string" * round_trip
    return slim.mapInArrow(run, schema).select(F.col("id_").alias(id_col), *names[1:])


def decode(shared):
    """A column function: bytes of ids -> their text (null for null), added tokens kept; bytes that are not UTF-8 are replaced."""

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: to_text(x, shared.value.by_id))

    return text
