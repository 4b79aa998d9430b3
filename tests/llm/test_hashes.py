"""Words and ranges that differ only by a pattern, texts that keep their form, settings and columns that stay as they were."""

import numpy as np
import pytest
from helpers import passage
from pyspark.sql import functions as F

import corpus_pipeline
from txnlens.llm import automaton, common, cotraining, rules, topk


def pattern(n, a="a", b="b"):
    """Two strings whose polynomial hashes agree modulo any power of two, for any odd base."""
    bits = [0]
    while len(bits) < n:
        bits += [1 - x for x in bits]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


def test_patterns_hash_apart():
    one, other = pattern(4096)
    hashes = common.word_spans(f"{one} {other} {one}\n{one[:-1]}".encode())[2]
    assert hashes[0] == hashes[2] and len(set(hashes.tolist())) == 3
    values = np.frombuffer((one + other + one).encode(), np.uint8).astype(np.uint64)
    found = common.range_hashes(values, np.array([0, 4096, 8192]), np.array([4096, 8192, 12288]))
    assert found[0] == found[2] != found[1]


def test_products_modulo_the_prime():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, common._PRIME, (2, 2000), dtype=np.uint64)
    a[:2], b[:2] = common._PRIME - 1, [common._PRIME - 1, 1]
    assert common._times(a, b).tolist() == [int(x) * int(y) % common._PRIME for x, y in zip(a, b, strict=True)]
    up, down = common._power_tables(70_000)
    assert all(int(up[i]) == pow(common._BASE, i, common._PRIME) and int(up[i]) * int(down[i]) % common._PRIME == 1
               for i in (0, 1, 2, 65_535, 69_999))


def test_words_that_differ_by_a_pattern_are_not_removed(spark):
    one, other = pattern(1024)
    words = passage("p", 60)
    rows = [(1, " ".join([*words[:30], one, *words[30:]])), (2, " ".join([*words[:30], other, *words[30:]]))]
    got = automaton.dedup(spark.createDataFrame(rows, "doc_id long, text string")).select("dedup_.n_removed").collect()
    assert [r[0] for r in got] == [0, 0]
    assert rules.scan(" ".join([one, *words[:7], other, *words[:7]]))[0][4] == 0


def test_untouched_text_keeps_its_form(spark):
    code, common_words = "def f(x):\n    return x\n\nprint(f(1))\n", passage("q", 55)
    rows = [(1, code, 1), (2, "\t" + " ".join(common_words) + "\n", 2), (3, "kept  before\n" + "\n".join(common_words) + "\n kept\tafter ", 3),
            (4, None, 4), (5, "", 0), (3, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("dedup", F.lit("own"))
    out = corpus_pipeline.substring_dedup(spark, docs, "")
    assert out.columns == docs.columns
    want = [*rows[:2], (3, "kept  before\nkept\tafter ", 24), *rows[3:]]
    assert sorted(map(str, out.collect())) == sorted(str(r) for r in spark.createDataFrame(
        [(*w, "own") for w in want], docs.schema).collect())


@pytest.mark.parametrize("rows", [[], [(1, "some text", "en", "web", 9)]])
def test_columns_of_the_same_name_give_way_or_stay(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema).withColumns({c: F.lit("own") for c in ("dedup_", "rules_", "quality_", "kept_", "kept", "rules")})
    assert automaton.dedup(docs).select("dedup_.n_removed", "kept_").count() == len(rows)
    field = rules.LineField(np.zeros((2, 1)), np.zeros((2, 2)))
    assert "rules_" in rules.judge(docs, field).columns
    assert cotraining.classify(docs, None).select("quality_.score", "kept_").count() == len(rows)
    assert set(corpus_pipeline.free(docs, "kept")) and corpus_pipeline.free(docs, "kept") not in docs.columns


def test_top_k_leaves_the_session_as_it_was(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(30)], "vec_id long, embedding array<double>")
    assert topk.top_k(vectors, lambda k: k % 10 == 0).count() == 30
    assert spark.conf.get(key) == before
