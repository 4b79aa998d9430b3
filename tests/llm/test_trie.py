"""BPE over the trie of words, against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward_texts, frame
from tokenizers import Tokenizer

from txnlens.llm import triebpe

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["\x1c\x1d a\x85b c  \n\n x", "½ ² Ⅷ٣ 𝟘 ǅ á 한국어 日本語 😀👩‍🚀", "'S 'll'LL don't", " " * 3000, "ab" * 3000, "é" * 777, "=" * 5000,
       "​ x\xa0y", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endof", "a\r\nb", "word\x00 word\x00\x00"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def vocabulary():
    return triebpe.Vocabulary(VOCABULARY)


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def test_equals_library_on_any_rows(spark, library):
    shared = triebpe.tables(spark, VOCABULARY)
    rows = awkward_texts() + [(100 + i, t) for i, t in enumerate(ODD)]
    encoded = triebpe.encode(frame(spark, rows), shared, round_trip=True)
    assert encoded.columns == ["doc_id", "ids", "decoded"]
    got = encoded.select("doc_id", "ids", "decoded", triebpe.decode(shared)("ids").alias("text")).collect()
    assert all(r.text == r.decoded for r in got)
    want = []
    for key, text in rows:
        found = library.encode(text or "", add_special_tokens=False).ids
        want.append((str(key), found, library.decode(found, skip_special_tokens=False)))
    assert sorted((str(r.doc_id), ids(r.ids), r.text) for r in got) == sorted(want)
    assert triebpe.encode(frame(spark, []), shared).isEmpty()


@pytest.mark.parametrize("limit", [1, 10**9])
def test_equals_library_on_random_texts(vocabulary, library, limit, monkeypatch):
    monkeypatch.setattr(triebpe, "WORDS", limit)  # with 1 the trie starts anew at every batch
    rng, encoder, tokens = random.Random(3), triebpe.TrieEncoder(vocabulary), list(vocabulary.ids)
    batches = [["".join(rng.choices("aab  \n-=_*'s", k=rng.randrange(120))) for _ in range(1500)],
               [" ".join("".join(rng.choices("abcdeéthinrsoug", k=rng.randrange(1, 14))) for _ in range(30)) for _ in range(1500)],
               ["".join(rng.choice(tokens).decode("utf-8", "ignore") for _ in range(8)) for _ in range(3000)],
               ["".join(chr(rng.choice([rng.randrange(160, 0x3000), rng.randrange(0x4e00, 0x9fff)])) for _ in range(60)) for _ in range(500)]]
    for texts in batches + batches[:1]:
        assert [ids(x) for x in encoder.encode(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_every_character_is_split_as_the_library_does(vocabulary, library):
    encoder = triebpe.TrieEncoder(vocabulary)
    characters = [chr(c) for c in [*range(0x3200), *range(0xf900, 0x10400), *range(0x1e000, 0x1f000)]]
    split = library.pre_tokenizer.pre_tokenize_str
    for i in range(0, len(characters), 10):
        text = "\n".join(f"a{c}a 1{c}1 -{c}- {c}  {c}" for c in characters[i:i + 10])
        assert [text[a:b] for _, (a, b) in split(text)] == encoder.split(text)


def test_neighbours_stay_apart_exactly_if_merging_keeps_them(vocabulary, library):
    rng, tokens = random.Random(4), [t for t in vocabulary.tokens if t.isalpha()]
    pairs = [(rng.choice(tokens), rng.choice(tokens)) for _ in range(20_000)]
    alone = library.encode_batch([(a + b).decode() for a, b in pairs], add_special_tokens=False)
    for (a, b), found in zip(pairs, alone, strict=True):
        want = found.ids == [vocabulary.tokens[a], vocabulary.tokens[b]]
        assert vocabulary.apart(vocabulary.tokens[a], vocabulary.tokens[b]) == want


def test_shared_prefixes_are_computed_once(vocabulary):
    encoder = triebpe.TrieEncoder(vocabulary)
    made = []
    last = encoder._last
    encoder._last = lambda word, end, *rest: made.append(word[:end]) or last(word, end, *rest)
    encoder.encode(["zyxwvu zyxwv zyxwvab"])
    encoder.encode([" zyxwvabc zyxwvu"])
    assert len(made) == len(set(made)) == len(encoder.last) - 1


def test_only_prefixes_at_which_a_token_may_begin_become_nodes(vocabulary, library):
    encoder = triebpe.TrieEncoder(vocabulary)
    assert [ids(x) for x in encoder.encode([" international"])] == [library.encode(" international", add_special_tokens=False).ids]
    assert len(encoder.last) - 1 == 1


def test_words_at_hand_stay_known_when_the_tables_start_anew(vocabulary, library, monkeypatch):
    monkeypatch.setattr(triebpe, "WORDS", 4)
    encoder, asked = triebpe.TrieEncoder(vocabulary), []
    resolve = encoder.resolve
    encoder.resolve = lambda pieces: asked.append(set(pieces)) or resolve(pieces)
    texts = ["zyxwvu qqxjz bbkkd", " qqxjz vvwwq ppzzk", "zyxwvu"]
    got = [ids(encoder.encode([t])[0]) for t in texts]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert asked == [{"zyxwvu", " qqxjz", " bbkkd"}, {" vvwwq", " ppzzk"}, {"zyxwvu"}]
