"""Small tables with awkward rows, and brute-force versions of what the operators compute."""

from __future__ import annotations

import re
import zlib

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = ("id_", "row_", "text_", "spans", "fp", "root", "ids", "part_", "rank_", "length", "kept", "y_", "h", "n_")


def word(i):
    """An invented word for a number."""
    return "".join("abcdefghij"[int(d)] for d in str(i)) + "x"


def passage(seed, n):
    return [word(zlib.crc32(f"{seed}-{i}".encode()) % 50_000) for i in range(n)]


def awkward_texts():
    """(id, text) rows: nulls, empty and wordless texts, repeats within and across, near copies, equal rows, long lines."""
    common = passage("common", 120)
    base = passage("base", 300)
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(passage("a", 40) + common + passage("b", 40))),
            (4, "\n".join([" ".join(passage("c", 60)), " ".join(common), " ".join(passage("d", 10))])),
            (5, " ".join(passage("e", 30) + common[20:90] + passage("f", 5))), (6, None), (7, ""), (8, " \t\n\x0b\x0c\r "),
            (9, "same " * 200), (10, "é ü ñ 漢字 🚀 x\x00y \x1c z\x85w\xa0v"), (11, "a" * 5000),
            (12, " ".join(base[:150] + ["changed"] + base[151:])), (13, " ".join(common[:50])), (14, " ".join(common[:49])),
            (15, "line one\nline two\nline one\n\nline one\n# $ % | < > & *"), (1, " ".join(base)), (1, "short text"),
            (None, " ".join(base)), (None, None), (16, "IT!! IS!! ALL!! SHOUTING!! " * 20), (17, "\n".join(["x | y | z"] * 30))]
    return rows


def frame(spark, rows, clash=True):
    """documents with extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(None).cast("string") for c in CLASH})
    return df


def windows(words, n):
    return [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
