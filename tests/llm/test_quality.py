"""Classifier, line rules and page extraction: held-out accuracy, brute-force counts, awkward rows."""

from collections import Counter

import numpy as np
import pytest
from helpers import SF, WORD, awkward_texts, frame, windows

from txnlens.llm import cotraining, html, rules


# ---------------------------------------------------------------- rules

def _brute_base(text):
    words, where, covered = WORD.findall(text or ""), {}, set()
    for i, w in enumerate(windows(words, 8)):
        where.setdefault(w, []).append(i)
    for at in where.values():
        if len(at) > 1:
            for i in at:
                covered.update(range(i, i + 8))
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(map((text or "").count, "#*$%&|<>")), again, len(covered)


def test_base_counts(spark):
    rows = awkward_texts()
    out = rules.judge(frame(spark, rows), rules.default_field())
    assert "kept" in out.columns and "length" in out.columns
    got = Counter((r.doc_id, *r.rules_[:6]) for r in out.collect())
    want = Counter()
    for key, text in rows:
        base = _brute_base(text)
        want[(key, *base, base[0] < 20 or 100 * base[4] > 30 * base[0])] += 1
    assert got == want
    assert rules.judge(frame(spark, []), rules.default_field()).isEmpty()


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(2)
    for _ in range(50):
        n, width = int(rng.integers(1, 8)), 4
        field = rules.LineField(rng.normal(size=(width, 2)), rng.normal(size=(2, 2)))
        x = rng.integers(0, 2, (n, width))

        def score(labels, field=field, x=x):
            s = sum((x[i] @ field.emit)[y] for i, y in enumerate(labels))
            return s + sum(field.move[a, b] for a, b in zip(labels, labels[1:], strict=False))

        best = max(score([k >> i & 1 for i in range(n)]) for k in range(2 ** n))
        assert score(field.label(x).tolist()) == pytest.approx(best)


def test_field_tells_lines_apart():
    good = [rules.scan("Some words of a plain sentence stand here, and they go on.\n" * 3)[1]] * 5
    bad = [rules.scan("A!! B!! C!! D!!\nE | F | G | H |\n### $$$ %%%")[1]] * 5
    field = rules.LineField.fit(rules.compose(good, bad, n_pages=60))
    mixed = rules.scan("Plain words make a sentence that is long enough to read.\nA!! B!! C!! D!!\n" * 2)[1]
    assert field.label(mixed).tolist()[:4] == [1, 0, 1, 0]


def test_rules_on_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = rules.judge(docs, rules.fit_field(docs, labels)).join(labels, "doc_id").select("quality", "rules_.*").collect()
    clean = [r for r in out if r.quality == 1 and not r.base_failed]
    junk = [r for r in out if r.quality == 0]
    assert sum(r.kept for r in clean) >= 0.98 * len(clean)
    assert sum(r.kept for r in junk) <= 0.2 * len(junk)


# ---------------------------------------------------------------- classifier

def test_classifier_on_held_out_labels(spark):
    folder = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    train, held = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    model = cotraining.fit(docs, train)
    out = cotraining.classify(docs, model).join(held, "doc_id").select("quality", "kept_").collect()
    right = sum(r.kept_ == bool(r.quality) for r in out)
    clean = [r for r in out if r.quality == 1]
    assert right >= 0.95 * len(out) and sum(r.kept_ for r in clean) >= 0.98 * len(clean)


def test_views_teach_each_other():
    rng = np.random.default_rng(0)

    def sample(n):
        y = rng.integers(0, 2, n)
        view = lambda noise: np.c_[np.ones(n), (2 * y - 1)[:, None] + noise * rng.normal(size=(n, 3))]
        return (view(0.8), view(0.8)), y

    views, y = sample(40)
    held, held_y = sample(400)
    pools, _ = sample(600)
    test, test_y = sample(500)
    model = cotraining.co_train(views, y, held, held_y, pools)
    assert sum(map(sum, model.log)) > 100
    assert ((model.score(*test) > 0.5) == test_y).mean() > 0.95


def test_classifier_with_awkward_rows(spark):
    docs = frame(spark, awkward_texts())
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (3, 7)], "doc_id long, quality int")
    model = cotraining.fit(docs, labels)
    assert model is None and cotraining.classify(docs, model).where("kept_").count() == len(awkward_texts())
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 18)], "doc_id long, quality int")
    out = cotraining.classify(docs, cotraining.fit(docs, labels))
    assert out.where("quality_.score IS NOT NULL").count() == len(awkward_texts())
    assert cotraining.fit(frame(spark, []), labels) is None
    assert cotraining.classify(frame(spark, []), None).isEmpty()


# ---------------------------------------------------------------- pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="page has-sidebar">
<div id="cookie-notice">We use cookies, okay? Yes, fine.</div><header><h1>Site</h1></header><nav><a href=1>Home</a></nav><!-- x <p>no</p> -->
<div class="wrap"><div class="main-col"><h2>My  title</h2><p>First paragraph, with some text.
It goes on &amp; on.</p><p>Second <b>para</b>graph<br>more &lt;text&gt; here, yes.</p><ul><li>one item<li>two item</ul>
<div class="share-buttons">Share this</div><form>Your <input> mail</form><section class="comments"><div class="comment-body">
<p>Nice post! I really, really liked it. Thanks a lot.</p></div></section></div>
<div class="sidebar"><p>Related things, you know. Lots of text, here.</p></div></div>
<div class="ad">Buy now, pay later. Really.</div><footer>&copy; 2020</footer><script>var x="<p>no</p>"</script></body></html>"""


def test_main_text():
    assert html.main_text(PAGE) == ("My title\nFirst paragraph, with some text. It goes on & on.\nSecond paragraph more <text> here, yes.\n"
                                    "one item\ntwo item")
    for text, want in [("", ""), (None, ""), ("plain", "plain"), ("a < b", "a < b"), ("<p>a<p>b", "a\nb"), ("</div>x", "x"),
                       ("<script>x", ""), ("<!-- x", ""), ("<p>&nbsp;</p>", ""), ("<b>" * 2000 + "x", "x"), ("<p>x&#233;&eacute;</p>", "xéé")]:
        assert html.main_text(text) == want


def test_extract(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<p>x</p>" * 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS c0_", "3 AS text_", "4 AS html_")
    out = html.extract(pages)
    assert sorted(out.columns) == sorted(pages.columns)
    assert Counter((r.page_id, r.url, r.text) for r in out.collect()) == Counter((i, u, html.main_text(h)) for i, u, h in rows)
    assert html.extract(pages.limit(0)).isEmpty()


def test_pages_of_the_supplied_table(spark):
    """Their articles stand in one element, so a regular expression finds the same blocks."""
    import html as entities
    import re

    for page in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert html.main_text(page.html) == "\n".join(b for b in blocks if b)
