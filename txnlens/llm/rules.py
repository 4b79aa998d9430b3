"""Quality rules: base counts of a document, and a line labeller that decides by the share of content.

Lines are labelled content or boilerplate by Viterbi decoding of a linear-chain conditional random field with two states.
The field is fitted on a bounded sample of labelled documents. Labels are given per document, so training pages are composed
of runs of lines from good and from bad documents: that shows the field both kinds of line and the changes between them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.llm.common import _SPACE, smallest_by_hash, small_batches, to_bytes, window_hashes, word_spans

MAX_LABELLED = 3000  # labelled documents that the field is fitted on
MAX_LINES = 100  # lines of each that training uses
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
CONTENT_SHARE = 0.5
SYMBOLS = b"#*$%&|<>"

_UPPER, _LETTER, _DIGIT, _SYMBOL, _SHOUT, _STOP, _OTHER, _CONT = range(8)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[ord("a"):ord("z") + 1] = _LETTER
_CLASS[0xC0:] = _LETTER
_CLASS[0x80:0xC0] = _CONT
_CLASS[ord("A"):ord("Z") + 1] = _UPPER
_CLASS[ord("0"):ord("9") + 1] = _DIGIT
_CLASS[list(SYMBOLS)] = _SYMBOL
_CLASS[list(b"!@_=~^\\{}[]")] = _SHOUT
_CLASS[list(b".,;:?")] = _STOP


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words covered by windows that occur twice or more in the text."""
    h = window_hashes(hashes, window)
    if len(h) < 2:
        return 0
    _, back, count = np.unique(h, return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[back] > 1)
    cover = np.zeros(len(hashes) + 1, np.int32)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def scan(text: str | None):
    """(base counts, features per line, words per line) of one document.

    Base counts: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words. Features are 0/1 columns, see FEATURES.
    """
    data = to_bytes(text)
    if not data:
        return (0, 0, 0, 0, 0), np.zeros((1, len(FEATURES)), np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)
    starts, _, hashes = word_spans(data)
    kinds = _CLASS[raw]
    breaks = np.flatnonzero(raw == 10)
    line_starts, line_ends = np.r_[0, breaks + 1], np.r_[breaks, len(raw)]
    n_lines = len(line_starts)
    line = np.repeat(np.arange(n_lines), np.diff(np.r_[line_starts, len(raw)]))
    space = _SPACE[raw]
    counts = np.bincount((line * 8 + kinds)[~space], minlength=8 * n_lines).reshape(n_lines, 8)
    words = np.bincount(line[starts], minlength=n_lines)
    lines = [data[a:b] for a, b in zip(line_starts.tolist(), line_ends.tolist(), strict=True)]
    seen: set[bytes] = set()
    again = np.zeros(n_lines, bool)
    for i in np.flatnonzero(words):
        again[i] = lines[i] in seen
        seen.add(lines[i])
    distinct = stutter = np.zeros(n_lines, np.int64)
    if len(hashes):
        at = line[starts]
        order = np.lexsort((hashes, at))
        new = np.r_[True, (hashes[order][1:] != hashes[order][:-1]) | (at[order][1:] != at[order][:-1])]
        distinct = np.bincount(at[order][new], minlength=n_lines)
        stutter = np.bincount(at[1:][(hashes[1:] == hashes[:-1]) & (at[1:] == at[:-1])], minlength=n_lines)
    chars = counts[:, :_CONT].sum(axis=1)
    base = (len(starts), int(chars.sum()), int(counts[:, _SYMBOL].sum()), int(again.sum()), repeated_words(hashes))
    return base, features(counts, words, distinct, chars, again, stutter), words


# Names of the 0/1 columns; thresholds stand in features().
FEATURES = ("any", "blank", "short", "medium", "long", "some upper", "much upper", "most upper", "digits", "many digits",
            "symbol", "symbols", "many symbols", "shouts", "many shouts", "no stop", "tiny words", "huge words", "few distinct",
            "very few distinct", "seen before", "stutter", "much stutter")


def features(counts, words, distinct, chars, again, stutter) -> np.ndarray:
    per_char = np.maximum(chars, 1)
    per_word = np.maximum(words, 1)
    upper, digits = counts[:, _UPPER] / per_char, counts[:, _DIGIT] / per_char
    symbols, shouts = counts[:, _SYMBOL] / per_word, counts[:, _SHOUT] / per_word
    length, variety, full = chars / per_word, distinct / per_word, words > 0
    columns = [np.ones(len(words), bool), ~full, full & (words < 4), (words >= 4) & (words < 12), words >= 12,
               upper > 0.2, upper > 0.4, upper > 0.7, digits > 0.1, digits > 0.4,
               symbols > 0.1, symbols > 0.3, symbols > 0.7, shouts > 0.3, shouts > 1.0,
               full & (counts[:, _STOP] == 0), full & (length < 2.5), length > 14, full & (variety < 0.5),
               full & (variety < 0.25), again,
               stutter / per_word > 0.2, stutter / per_word > 0.5]
    return np.stack(columns, axis=1).astype(np.uint8)


class LineField:
    """A linear-chain conditional random field over the states boilerplate (0) and content (1)."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move  # (features, 2), (2, 2)

    def label(self, x: np.ndarray) -> np.ndarray:
        """The most probable states of the lines (Viterbi)."""
        score = x @ self.emit
        (m00, m01), (m10, m11) = self.move.tolist()
        a, b = score[0].tolist()
        back = []
        for s0, s1 in score[1:].tolist():
            stay0, stay1 = a + m00 >= b + m10, b + m11 >= a + m01
            back.append((stay0, stay1))
            a, b = (a + m00 if stay0 else b + m10) + s0, (b + m11 if stay1 else a + m01) + s1
        state = int(b >= a)
        states = [state]
        for stay in reversed(back):
            if not stay[state]:
                state = 1 - state
            states.append(state)
        return np.array(states[::-1], np.int8)

    @classmethod
    def fit(cls, pages: list[tuple[np.ndarray, np.ndarray]], rounds: int = 150, rate: float = 0.1, l2: float = 1e-3):
        """Gradient ascent on the conditional likelihood; all pages have the same number of lines."""
        x = np.stack([p[0] for p in pages]).astype(np.float64)
        y = np.stack([p[1] for p in pages])
        n, steps, width = x.shape
        emit, move = np.zeros((width, 2)), np.zeros((2, 2))
        hot = np.eye(2)[y]
        seen_emit = np.einsum("ntf,nts->fs", x, hot)
        seen_move = np.einsum("nta,ntb->ab", hot[:, :-1], hot[:, 1:])
        moments = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(move), np.zeros_like(move)]
        for k in range(1, rounds + 1):
            score = x @ emit
            ahead, behind = np.zeros((n, steps, 2)), np.zeros((n, steps, 2))
            ahead[:, 0] = score[:, 0]
            for t in range(1, steps):
                ahead[:, t] = np.logaddexp.reduce(ahead[:, t - 1][:, :, None] + move, axis=1) + score[:, t]
            for t in range(steps - 2, -1, -1):
                behind[:, t] = np.logaddexp.reduce(move + (behind[:, t + 1] + score[:, t + 1])[:, None, :], axis=2)
            total = np.logaddexp.reduce(ahead[:, -1], axis=1)[:, None, None]
            state = np.exp(ahead + behind - total)
            pair = np.exp(ahead[:, :-1, :, None] + move + (behind[:, 1:] + score[:, 1:])[:, :, None, :] - total[..., None])
            lines = n * steps
            grads = [(seen_emit - np.einsum("ntf,nts->fs", x, state)) / lines - l2 * emit,
                     (seen_move - pair.sum(axis=(0, 1))) / lines - l2 * move]
            for i, (w, g) in enumerate(zip((emit, move), grads, strict=True)):
                moments[2 * i] = 0.9 * moments[2 * i] + 0.1 * g
                moments[2 * i + 1] = 0.99 * moments[2 * i + 1] + 0.01 * g * g
                w += rate * (moments[2 * i] / (1 - 0.9 ** k)) / (np.sqrt(moments[2 * i + 1] / (1 - 0.99 ** k)) + 1e-8)
        return cls(emit, move)


def compose(good: list[np.ndarray], bad: list[np.ndarray], n_pages: int = 400, lines: int = 24, seed: int = 7):
    """Training pages: runs of lines of good (content) and bad (boilerplate) documents in turn."""
    rng, pages = np.random.default_rng(seed), []
    pools = (bad, good)
    for _ in range(n_pages):
        x, y, state = [], [], int(rng.integers(2))
        while len(y) < lines:
            source = pools[state][rng.integers(len(pools[state]))]
            run = int(rng.integers(1, 9))
            at = int(rng.integers(max(1, len(source) - run + 1)))
            part = source[at:at + run]
            x.append(part)
            y.extend([state] * len(part))
            state = int(rng.integers(2)) if rng.random() < 0.5 else 1 - state
        pages.append((np.concatenate(x)[:lines], np.array(y[:lines])))
    return pages


# The field where labels of one of the two kinds are missing: it trusts a line unless symbols, capitals or repeats pile up.
def default_field() -> LineField:
    weight = dict.fromkeys(FEATURES, 0.0) | {
        "any": 1.0, "most upper": -2.0, "many digits": -1.0, "many symbols": -2.0, "symbols": -1.0, "many shouts": -2.0,
        "very few distinct": -1.5, "seen before": -1.0, "much stutter": -2.0}
    emit = np.array([[-weight[f] / 2, weight[f] / 2] for f in FEATURES])
    return LineField(emit, np.array([[0.5, -0.5], [-0.5, 0.5]]))


def fit_field(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              quality_col: str = "quality", max_labelled: int = MAX_LABELLED, max_lines: int = MAX_LINES) -> LineField:
    """Fit on at most ``max_labelled`` labelled documents (smallest hashes of their keys), ``max_lines`` lines of each."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col(quality_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("id_")).agg(F.min(quality_col).alias("quality_"))
    chosen = smallest_by_hash(known, "id_", max_labelled)
    slim = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
    sample = slim.join(F.broadcast(chosen), "id_").select("quality_", "text_")  # bounded by max_labelled rows

    def run(batches):
        for batch in batches:
            rows = [scan(t)[1][:max_lines].tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array(rows, pa.binary())], ["q", "x"])

    got = sample.select(F.col("quality_").cast("int"), "text_").mapInArrow(run, "q int, x binary").collect()
    lines = [(r["q"], np.frombuffer(r["x"], np.uint8).reshape(-1, len(FEATURES))) for r in got]
    lines.sort(key=lambda p: (p[0], p[1].tobytes()))  # the same order on every run
    good, bad = [x for q, x in lines if q == 1], [x for q, x in lines if q == 0]
    if not good or not bad:
        return default_field()
    return LineField.fit(compose(good, bad))


_OUT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
        "content_share double, kept boolean")


def judge(docs: DataFrame, field: LineField, text_col: str = "text", share: float = CONTENT_SHARE,
          into: str = "rules_") -> DataFrame:
    """The rows of ``docs`` with a struct column ``into``: base counts, ``content_share`` and ``kept``.

    A null or wordless text fails the base rules. Blank lines belong to the state of their neighbours and count no words.
    Repeated rows are judged each, a very long text is judged whole, an empty table gives no rows. All columns pass through
    unchanged, but for an input column named ``into``, which gives way.
    """
    small_batches(docs.sparkSession)
    emit, move = field.emit, field.move

    @F.pandas_udf(_OUT)
    def verdict(texts: pd.Series) -> pd.DataFrame:
        decoder, rows = LineField(emit, move), []
        for text in texts:
            base, x, words = scan(text)
            failed = base[0] < MIN_WORDS or 100 * base[4] > MAX_REPEAT_PERCENT * base[0]
            content = float(words[decoder.label(x) == 1].sum() / base[0]) if base[0] else 0.0
            rows.append((*base, failed, content, not failed and content >= share))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _OUT.split(", ")])

    return docs.withColumn(into, verdict(F.col(text_col)))
