"""Phrase collocations against counts by brute force, with stretches of the stream that end inside phrases."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from helpers import CLASH, awkward_texts
from pyspark.sql import functions as F

from txnlens.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, longest, top):
    n, f, out = Counter(), Counter(), {}
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    frequent = {g: a for g, a in f.items() if a >= least}
    dropped = {(g[0], *g[i:j]) for g, a in frequent.items() for i in range(1, len(g)) for j in range(i + 1, len(g) + 1)
               if j - i < len(g) - 1 and 100 * a >= 80 * f[(g[0], *g[i:j])]}
    for g, a in frequent.items():
        if len(g) > 2 and g not in dropped:
            cuts = [(2_000_000 * a // (f[g[:k + 1]] + f[(g[0], *g[k + 1:])]), k, f[g[:k + 1]], f[(g[0], *g[k + 1:])])
                    for k in range(1, len(g) - 1)]
            score, _, left, right = min(cuts)
            out.setdefault(g[0], []).append((-score, -a, " ".join(g[1:]).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -score) for lang, found in out.items()
                  for i, (score, a, p, left, right) in enumerate(sorted(found)[:top]))


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.withColumns({c: F.lit(None).cast("string") for c in (*CLASH, "part", "n", "words", "prefix", "rank", "a", "phrase")})


def texts(seed, n):
    rng = random.Random(seed)
    pool = ["The", "the", "of", "é", "a\x00", "a", "a\x01", "\x00", "x\x01\x02", "zz\x1f", "Ä", "b\xa0c", "word"]
    rows = [(i, "".join(rng.choice(pool) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "! "]) for _ in range(rng.randrange(80))),
             rng.choice(["en", "en", "en", None, "", "f\x00r", "und"])) for i in range(n)]
    return rows + [(900 + i, "the the the the the the", "en") for i in range(60)] + [(None, None, None), (None, "", "en"), (1, "one", "xx")]


def result(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("partitions", [1, 3, 23])
def test_equals_brute_force(spark, partitions, monkeypatch):
    monkeypatch.setattr(collocations, "STEP", 1)  # bounds from every window: stretches end inside the most common phrases
    rows = texts(5, 120) + [(i, t, "en") for i, t in awkward_texts()]
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, partitions)
    try:
        got = result(collocations.collocations(frame(spark, rows).repartition(5), least=3, top=40))
        three = result(collocations.collocations(frame(spark, rows), least=6, longest=3, top=10**6))
    finally:
        spark.conf.set(key, before)
    want = brute(rows, 3, 4, 40)
    assert [x for x in got if x not in want][:3] == [] == [x for x in want if x not in got][:3]
    assert got == want and len(got) > 100
    assert three == brute(rows, 6, 3, 10**6)


def test_nothing_frequent_and_empty_tables(spark):
    for rows in ([], [(1, None, "en"), (2, "", None)], [(1, "a b c", "en")]):
        assert collocations.collocations(frame(spark, rows)).isEmpty()


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 40)
    text = "one two three four. five six seven, eight nine ten\neleven twelve thirteen fourteen fifteen sixteen seventeen! x y z"
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text])], ["lang_", "text_"])
    chunks = [c for chunk in collocations._chunks([batch]) for c in chunk]
    assert len(chunks) > 1 and b"".join(d for _, d in chunks) == text.encode() and all(d[-1:] in b".,\n!" for _, d in chunks[:-1])


def test_runs_do_not_depend_on_the_batches():
    rng = random.Random(2)
    keys = sorted({b"\x00".join([b"en", *rng.choices([b"a", b"ab", b"b", b"\x01\x01"], k=rng.randrange(1, 5))]) for _ in range(300)})
    counts = [rng.randrange(1, 9) for _ in keys]
    found = []
    for size in (1, 3, 7, 1000):
        runs = collocations.Runs(4, 5)
        for i in range(0, len(keys), size):
            runs.add(pa.array(keys[i:i + size], pa.binary()), pa.array(counts[i:i + size]).to_numpy())
        found.append(sorted(runs.ended()))
    assert all(f == found[0] for f in found)
