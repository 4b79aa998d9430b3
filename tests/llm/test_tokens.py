"""BPE against the library of the vocabulary, packing against its own conditions and the lower bound."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import awkward_texts, frame
from tokenizers import Tokenizer

from txnlens.llm import bpe, packing

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["\x1c\x1d a\x85b c  \n\n x", "½ ² Ⅷ٣ 𝟘 ǅ á 한국어 日本語 😀👩‍🚀", "'S 'll'LL don't", " " * 3000, "ab" * 3000, "é" * 777,
       "​ x\xa0y", "<|endoftext|>", "a\r\nb", "_under_score_ 1,234.5"]


@pytest.fixture(scope="module")
def shared(spark):
    return bpe.tables(spark, RANKS)


def test_bpe_equals_library_and_round_trips(spark, shared):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=shared.value.ranks, special_tokens={})
    rows = awkward_texts() + [(100 + i, t) for i, t in enumerate(ODD)]
    encoded = bpe.encode(frame(spark, rows), shared)
    got = encoded.select("doc_id", "ids", bpe.decode(shared)("ids").alias("data")).collect()
    want = sorted((str(k), library.encode_ordinary(t or ""), (t or "").encode()) for k, t in rows)
    assert sorted((str(r.doc_id), r.ids, bytes(r.data)) for r in got) == want
    assert bpe.encode(frame(spark, []), shared).isEmpty()


def test_plain_engine_splits_alike():
    import regex

    rng, general = random.Random(5), regex.compile(public_tokenizers.PATTERN)
    signs = [chr(c) for c in range(0x250)] + list(" " * 60) + list("'sltrevmd\n\t") * 6
    for _ in range(4000):
        text = "".join(rng.choices(signs, k=rng.randrange(30)))
        latin = "".join(c for c in text if bpe._NOT_LATIN.search(c) is None)
        assert bpe._LATIN.findall(latin) == general.findall(latin)


def test_perfect_hash_is_minimal_and_exact():
    keys = [f"key{i}".encode() for i in range(3000)]
    table = bpe.PerfectHash(keys)
    assert sorted(table.find(keys).tolist()) == list(range(len(keys)))
    assert set(table.find([b"", b"key", b"key3000", b"other"]).tolist()) == {-1}
    assert bpe.PerfectHash([b"one"]).find([b"one", b"two"]).tolist() == [0, -1]


def test_vocabulary_equals_tokenizers_library(spark):
    library = Tokenizer.from_file(VOCABULARY)
    library.encode_special_tokens = True
    rows = awkward_texts() + [(100 + i, t) for i, t in enumerate(ODD)]
    got = defaultdict(list)
    for r in packing.pieces(frame(spark, rows), VOCABULARY).orderBy("piece").collect():
        got[str(r.id_)].append((r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()))
    want = defaultdict(list)
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want[str(key)] += [(k, s, ids[s:s + n]) for k, (s, n) in enumerate(packing.cut(len(ids), 1024))]
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_cut():
    assert packing.cut(1, 8) == [(0, 1)] and packing.cut(8, 8) == [(0, 8)]
    assert packing.cut(9, 8) == [(0, 1), (1, 8)] and packing.cut(24, 8) == [(0, 8), (8, 8), (16, 8)]


@pytest.mark.parametrize("capacity", [16, 1024])
def test_pack(spark, capacity):
    rows = awkward_texts()
    out = packing.pack(frame(spark, rows), VOCABULARY, capacity=capacity).collect()
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
        assert r.length * 4 == len(r.ids)
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in out)
    assert -(-total // capacity) <= len(bins) <= -(-total // capacity) + 2
    assert packing.pack(frame(spark, []), VOCABULARY).isEmpty()


def _best(room, counts):
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= room}
    return max(sums)


def test_fullest_combination_is_the_fullest():
    rng = random.Random(4)
    for _ in range(200):
        counts = {rng.randint(1, 20): rng.randint(1, 4) for _ in range(rng.randint(0, 6))}
        room = rng.randint(0, 40)
        chosen = packing.fullest(room, counts)
        assert all(n <= counts[length] for length, n in chosen)
        assert sum(length * n for length, n in chosen) == _best(room, counts)


def test_plan_uses_every_piece_once():
    rng = random.Random(8)
    counts = {length: rng.randint(1, 500) for length in rng.sample(range(1, 1025), 400)}
    planned = packing.plan(counts)
    used = defaultdict(int)
    for bins, inside in planned:
        assert sum(length * n for length, n in inside) <= 1024
        for length, n in inside:
            used[length] += bins * n
    assert dict(used) == counts
    total = sum(length * n for length, n in counts.items())
    assert sum(b for b, _ in planned) <= 1.03 * max(total / 1024, sum(n for length, n in counts.items() if length > 512))
