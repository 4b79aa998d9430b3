"""Repeated bytes, repeated word windows, SimHash components: against brute force over whole small tables."""

import hashlib
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash
from helpers import WORD, awkward_texts, frame, passage, windows

from txnlens.llm import automaton, graph, induced, repeats, simhash


# ---------------------------------------------------------------- suffix sorting

def _brute_suffixes(text, limit):
    symbols = text.tolist()
    order = sorted(range(len(symbols)), key=lambda i: symbols[i:])
    common = [0]
    for a, b in zip(order, order[1:], strict=False):
        k = 0
        while k < limit and max(a, b) + k < len(symbols) and symbols[a + k] == symbols[b + k]:
            k += 1
        common.append(k)
    return order, common


@pytest.mark.parametrize("memory,base", [(10**7, 10**7), (16, 4)])
def test_induced_order_and_common_prefixes(memory, base):
    rng = np.random.default_rng(5)
    for trial in range(120):
        n, symbols = int(rng.integers(0, 90)), int(rng.integers(1, 5))
        text = rng.integers(1, symbols + 1, n)
        if trial % 3 == 0:
            text = np.tile(text[:n // 4], 4)
        text = np.r_[text, 0].astype(np.uint8)
        order, common = induced.suffix_array(text, 25, memory, base)
        want = _brute_suffixes(text, 25)
        assert (order.tolist(), common.tolist()) == want


def test_spill_files_are_used_and_removed(tmp_path, monkeypatch):
    monkeypatch.setattr(induced.tempfile, "tempdir", str(tmp_path))
    text = np.r_[np.random.default_rng(1).integers(1, 4, 400), 0].astype(np.uint8)
    with induced.Disk(32) as disk:
        assert len(list(induced.sort(text, 20, disk, 8))) and disk.files > 0
        assert any(tmp_path.iterdir())
    assert not any(tmp_path.iterdir())


def test_long_pieces_are_named_apart():
    rng = np.random.default_rng(3)
    for period in (1, 7, 300):
        piece = np.r_[rng.integers(2, 5, period), np.arange(5, 200)]
        text = np.r_[np.tile(np.r_[piece, 1], 90), piece[:-1], 1, 0].astype(np.uint8)
        text[len(piece) * 40] = 3
        for base in (10**7, 4):
            order, _ = induced.suffix_array(text, 25, 10**7, base)
            assert order.tolist() == sorted(range(len(text)), key=lambda i, data=text.tobytes(): data[i:])


def test_a_shard_takes_little_memory_for_each_byte():
    rng = np.random.default_rng(4)
    data = [bytes(rng.choice(np.frombuffer(b"etaoin shrdlu", np.uint8), 600)) for _ in range(1500)]
    shard = pd.DataFrame({"data": data, "n_": 1})
    tracemalloc.start()
    try:
        repeats.repeated_starts(shard, 400, induced.MEMORY, induced.BASE)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 60 * sum(map(len, data))


def test_a_large_anchor_has_a_shard_of_its_own():
    sizes = [(1, 40), (1, 40), (2, 10), (3, 60), (3, 60), (3, 60), (3, 60), (4, 30), (5, 70), (6, 1)]
    rows = pd.DataFrame({"anchor": [a for a, _ in sizes], "data": [b"x" * n for _, n in sizes]})
    for step in (1, 3, 10):
        found = [x["anchor"].tolist() for x in repeats.shards((rows[i:i + step] for i in range(0, len(rows), step)), 100)]
        assert found == [[1, 1, 2], [3, 3, 3, 3], [4, 5], [6]]
    assert list(repeats.shards(iter([]), 100)) == [] == list(repeats.shards(iter([rows[:0]]), 100))


# ---------------------------------------------------------------- repeated bytes

def _brute_bytes(rows, window):
    starts = Counter()
    for _, text in rows:
        data = (text or "").encode()
        starts.update(data[i:i + window] for i in range(len(data) - window + 1))
    out = Counter()
    for key, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - window + 1):
            if starts[data[i:i + window]] > 1:
                gone[i:i + window] = True
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        out[(key, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("window,how", [(400, {}), (60, {"gram": 16}), (60, {"gram": 16, "shard_bytes": 500, "memory": 64, "base": 16}),
                                        (60, {"gram": 16, "shard_contexts": 0})])
def test_repeated_bytes(spark, window, how):
    rows = awkward_texts()
    got = repeats.dedup(frame(spark, rows), window=window, **how).collect()
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got)
    assert got == _brute_bytes(rows, window)


def test_planted_passages_show_in_n_removed(spark):
    long, short = " ".join(passage("planted", 80)), " ".join(passage("brief", 52))
    assert len(long) >= 400 > len(short) + 20  # a passage of over 50 words may be shorter than a window: it stays

    def text(i, planted=""):
        return " ".join([*passage(f"head{i}", 60), planted, *passage(f"tail{i}", 60)])

    rows = [(i, text(i, (long, short, "")[i % 3])) for i in range(30)]
    got = {r.doc_id: r for r in repeats.dedup(frame(spark, rows)).collect()}
    for key, given in rows:
        assert got[key].n_bytes == len(given)  # the size of the input, whatever is removed
        assert len(bytes(got[key].kept)) == len(given) - got[key].n_removed
        assert len(long) <= got[key].n_removed < len(long) + 20 if key % 3 == 0 else got[key].n_removed == 0


# ---------------------------------------------------------------- repeated word windows

def _brute_words(rows, window):
    first = {}
    for key, text in rows:
        if key is not None:
            for w in windows(WORD.findall(text or ""), window):
                first[w] = min(key, first.get(w, key))
    out = Counter()
    for key, text in rows:
        words = WORD.findall(text or "")
        keep = [True] * len(words)
        for i, w in enumerate(windows(words, window)):
            if key is not None and first[w] < key:
                keep[i:i + window] = [False] * window
        kept = " ".join(w for w, k in zip(words, keep, strict=True) if k)
        out[(key, len(words), keep.count(False), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("window,gram,contexts", [(50, 16, 512), (12, 5, 512), (12, 5, 0)])
def test_repeated_windows(spark, monkeypatch, window, gram, contexts):
    rows = awkward_texts()
    plain = automaton.removed_spans
    monkeypatch.setattr(automaton, "removed_spans", lambda d, w, g: plain(d, w, g, shard_contexts=contexts, shard_words=100))
    got = automaton.dedup(frame(spark, rows), window=window, gram=gram)
    assert "length" in got.columns  # other columns pass through
    got = Counter((r.doc_id, r.dedup_.n_words, r.dedup_.n_removed, hashlib.sha256(r.dedup_.kept.encode()).hexdigest()) for r in got.collect())
    assert got == _brute_words(rows, window)


def test_automaton_matches_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(60):
        texts = [rng.integers(0, 3, rng.integers(0, 30)).tolist() for _ in range(5)]
        keys = rng.permutation(5).tolist()
        machine = automaton.SuffixAutomaton()
        for t, k in zip(texts, keys, strict=True):
            machine.add(t, k)
        machine.close()
        first = {}
        for t, k in zip(texts, keys, strict=True):
            for w in windows(t, 4):
                first[w] = min(k, first.get(w, k))
        for t in [*texts, rng.integers(0, 3, 30).tolist()]:
            assert machine.stream(t, 4) == [first.get(w) for w in windows(t, 4)]


# ---------------------------------------------------------------- SimHash

def _brute_fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(w) for w in windows(words, 3)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _brute_components(rows):
    prints = [_brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    low = defaultdict(lambda: None)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            r = find(i)
            low[r] = key if low[r] is None else min(low[r], key)
    return Counter((key, f"{p:016x}", low[find(i)]) for i, ((key, _), p) in enumerate(zip(rows, prints, strict=True)))


def test_simhash_components(spark):
    rows = awkward_texts()
    got = simhash.near_duplicates(frame(spark, rows)).withColumn("hex", simhash.hexadecimal("fp")).collect()
    assert Counter((r.doc_id, r.hex, r.component_id) for r in got) == _brute_components(rows)
    left = [r.doc_id for r in simhash.one_of_each(frame(spark, rows)).collect()]
    assert sorted(left, key=str) == sorted({r.root: r.component_id for r in got}.values(), key=str)


def test_index_finds_every_link(spark):
    rng = np.random.default_rng(9)
    centre = rng.integers(0, 2**63, 4, dtype=np.uint64)
    prints = {int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for c in centre for _ in range(150)}
    prints |= {int(centre[0]) ^ (1 << b) for b in range(64)} | {0, 2**64 - 1, 1, 3}
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    links = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    pairs = [((r.a & 2**64 - 1), (r.b & 2**64 - 1)) for r in links.collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)

    def parts(edges):
        root = {p: p for p in prints}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            root[find(a)] = find(b)
        return {frozenset(p for p in prints if find(p) == r) for r in {find(p) for p in prints}}

    every = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2]
    assert parts(pairs) == parts(every)
    assert len(pairs) < 28 * len(prints)


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(50)] + [(100, 99), (99, 98)]])
def test_components(spark, edges):
    got = {r.a: r.b for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for a, b in edges:
        for x in (a, b):
            root.setdefault(x, {x})
        if root[a] is not root[b]:
            root[a] |= root[b]
            for x in root[a]:
                root[x] = root[a]
    assert got == {x: min(s) for x, s in root.items() if len(s) > 1}


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert repeats.dedup(empty).isEmpty() and automaton.dedup(empty).isEmpty()
    assert simhash.near_duplicates(empty).isEmpty() and simhash.one_of_each(empty).isEmpty()
