"""Packing with added tokens in the texts: the ids of the tokenizers library with its own settings."""

import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
from helpers import awkward_texts, frame
from tokenizers import Tokenizer

from txnlens.llm import packing, queries

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
MARK = "<|endoftext|>"
TEXTS = [MARK, f"one {MARK} two", f"{MARK}{MARK}x", f"a  {MARK}  b\n{MARK}\n", f"<|{MARK}|>", "<|endoftext|", "<|ENDOFTEXT|>", f"é漢{MARK}🚀 's{MARK}'s",
         f"word {MARK} " * 900, f"12{MARK}34", "   " + MARK, MARK + "   "]


def _rows():
    return [r for r in awkward_texts() if r[0] is not None] + [(100 + i, t) for i, t in enumerate(TEXTS)]


def _want(rows):
    library, want = Tokenizer.from_file(VOCABULARY), defaultdict(list)
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want[key] += [(k, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())) for k, (s, n) in enumerate(packing.cut(len(ids), 1024))]
    return {k: sorted(v) for k, v in want.items()}


def _got(packed):
    got = defaultdict(list)
    for r in packed.collect():
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    return {k: sorted(v) for k, v in got.items()}


def test_stage_has_ids_of_the_library(spark):
    assert _got(corpus_pipeline.best_fit_packing(spark, frame(spark, _rows()), "")) == _want(_rows())


def test_query_has_ids_of_the_library(spark, tmp_path):
    frame(spark, _rows(), clash=False).write.parquet(f"{tmp_path}/documents.parquet")
    assert _got(queries.QUERIES["op4_best_fit_packing"](spark, str(tmp_path))) == _want(_rows())
