"""Main text of web pages by tag-path ratios.

A page is read into text nodes, each with its root-to-leaf path of tags (with class and id). Text length and punctuation are
summed per path; a path's two ratios are these sums over its nodes. The ratios are smoothed over the nodes in page order and
fused; nodes whose fused value reaches a threshold from the page's own spread are content nodes. The deepest element that
holds nearly all of their text is the article; its blocks are the result, without the parts that are never article text.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.llm.common import small_batches

SPREAD = 1.0  # a content node's fused ratio reaches this many standard deviations ...
PEAK = 0.25  # ... or this share of the highest
SHARE = 0.9  # of the content nodes' text that the article holds

# Elements by their role in the markup.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "svg", "math", "iframe", "object", "select", "canvas",
       "audio", "video", "xmp", "noframes", "noembed"}
LITTLE, LEAST_ARTICLE = 0.1, 200  # share of the content outside named elements, and characters of content, to take a name back
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
          "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr", "br"}
NEVER = {"nav", "header", "footer", "aside", "form", "button", "dialog", "menu", "head", "fieldset", "datalist", "option"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "form"}
HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|adsense|sponsor(?:ed|s)?|promo(?:tion|s)?|banner|cookies?|consent|gdpr|notices?|popup|modal|"
    r"overlay|newsletter|subscribe|subscription|signup|login|sidebar|side|aside|widgets?|comments?|replies|disqus|respond|share|sharing|"
    r"social|related|recommended|menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|topbar|toolbar|pagination|pager|"
    r"search|tags|skip|copyright|legal)(?:$|[\s_-])", re.I)
_LAYOUT = re.compile(r"(?:has|with|without|no|hide|show)[_-]", re.I)
_CONTENT = re.compile(r"(?:article|post|entry|main|page|story|body|text)?[_-]?(?:article|post|entry|content|body|story|text)", re.I)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)[^>]*>|<|[^<]+",
                    re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?¡¿…、。，？！]")


class Element:
    __slots__ = ("name", "parent", "path", "never", "hint", "depth")

    def __init__(self, name, parent, label, never, hint=False):
        self.name, self.parent, self.never, self.hint = name, parent, never or (parent is not None and parent.never), hint
        self.path = (parent.path if parent else "") + ">" + label
        self.depth = parent.depth + 1 if parent else 0


def attributes(text: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(text)} if text.strip() else {}


def aside(mark: str) -> bool:
    """Whether classes and id name a part of a page that is not the article."""
    names = mark.split()
    return any(HINT.search(n) and not _LAYOUT.match(n) for n in names) and not any(_CONTENT.fullmatch(n) for n in names)


def nodes(html: str):
    """(element, text, block number) of the text nodes in page order; text with references decoded."""
    root = Element("", None, "", False)
    here, out, block, at = root, [], 0, 0
    while at < len(html):
        m = _TOKEN.match(html, at)
        at = m.end()
        token = m.group(0)
        name = m.group(2) or m.group(5)
        if name is None:
            if token[0] != "<" or token == "<":
                out.append((here, entities.unescape(token), block))
            continue
        name, closing = name.lower(), m.group(1) or m.group(4)
        if name not in INLINE:
            block += 1
        if closing:
            node = here
            while node is not root and node.name != name:
                node = node.parent
            if node is not root:
                here = node.parent
            continue
        if name == "br":
            out.append((here, " ", block))
        if name in VOID:
            continue
        if name in RAW:
            if not (m.group(3) or "").endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if name not in INLINE:
            node = here  # an open paragraph ends where a block begins; list items and cells end at the next one
            ends = CLOSED_BY.get(name, set()) | {"p"}
            while node is not root and node.name not in ends and node.name in INLINE:
                node = node.parent
            if node is not root and node.name in ends:
                here = node.parent
        given = attributes(m.group(3) or "")
        mark = f"{given.get('class', '')} {given.get('id', '')}".strip()
        hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "")
        never = name in NEVER or given.get("role", "").lower() in ROLES or hidden
        hint = name not in ("body", "html", "article", "main") and aside(mark)
        here = Element(name, here, name + ("." + mark if mark else ""), never, hint)
    return out


def smooth(values: np.ndarray) -> np.ndarray:
    """Gaussian smoothing over the neighbours in page order."""
    kernel = np.exp(-0.5 * np.arange(-2, 3) ** 2)
    return np.convolve(values, kernel)[2:-2] / np.convolve(np.ones(len(values)), kernel)[2:-2]


def content_nodes(texts: list[str], paths: list[str]) -> np.ndarray:
    """Which nodes are content by the fused ratios of their paths."""
    _, path = np.unique(np.array(paths, dtype=object).astype(str), return_inverse=True)
    size = np.array([len(t.strip()) for t in texts], float)
    marks = np.array([len(_PUNCTUATION.findall(t)) for t in texts], float)
    count = np.bincount(path)
    text_ratio = np.bincount(path, weights=size) / count
    mark_ratio = np.bincount(path, weights=marks) / count
    fused = smooth(np.log1p(text_ratio[path])) * smooth(np.log1p(mark_ratio[path]))
    fused = np.where(size > 0, fused, 0)
    return fused >= min(SPREAD * fused.std(), PEAK * fused.max()) if fused.max(initial=0) > 0 else size > 0


def weights(solid, chosen) -> tuple[dict, int]:
    """({id: [element, characters of content nodes in it]}, all characters of content nodes)."""
    weight: dict[int, list] = {}
    total = 0
    for (element, text), take in zip(solid, chosen, strict=True):
        if take:
            size = len(text.strip())
            total += size
            while element is not None:
                weight.setdefault(id(element), [element, 0])[1] += size
                element = element.parent
    return weight, total


def hinted(element) -> bool:
    """Whether the element or one around it is named like a part of a page that is not the article."""
    while element is not None:
        if element.hint:
            return True
        element = element.parent
    return False


def release(solid) -> None:
    """Take back hints that the ratios contradict.

    Names only say what an element is called. Where next to no content is left outside the elements so named, the one among them
    with the most content is a wrapper of the article; its name is ignored, those inside it are looked at again.
    """
    chosen = content_nodes([t for _, t in solid], [e.path for e, _ in solid])
    weight, total = weights(solid, chosen)
    while True:
        outside = sum(len(t.strip()) for (e, t), take in zip(solid, chosen, strict=True) if take and not hinted(e))
        named = [(w, -e.depth, e) for e, w in weight.values() if e.hint]
        if not named or outside >= LITTLE * total:
            return
        size, _, wrapper = max(named, key=lambda x: x[:2])
        if size < LEAST_ARTICLE:
            return
        wrapper.hint = False


def main_text(html: str | None) -> str:
    """The article of a page: blocks in page order joined by newlines, white space inside a block turned into one space."""
    if not html:
        return ""
    found = [(e, t, b) for e, t, b in nodes(html) if not e.never]
    every = [(e, t) for e, t, _ in found if t.strip()]
    if every:
        release(every)
    found = [(e, t, b) for e, t, b in found if not hinted(e)]
    solid = [(e, t) for e, t, _ in found if t.strip()]
    if not solid:
        return ""
    weight, total = weights(solid, content_nodes([t for _, t in solid], [e.path for e, _ in solid]))
    article = max((e for e, w in weight.values() if w >= SHARE * total and e.name not in INLINE and e.name != "p"),
                  key=lambda e: e.depth)
    inside: dict[int, bool] = {id(article): True}

    def within(element):
        trail = []
        while element is not None and id(element) not in inside:
            trail.append(element)
            element = element.parent
        value = inside[id(element)] if element is not None else False
        for e in trail:
            inside[id(e)] = value
        return value

    blocks: dict[int, list[str]] = {}
    for element, text, block in found:
        if within(element):
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """The rows of ``pages`` with the main text of each in ``out_col``; a column of that name is replaced.

    A null or empty page, or one without text, gives an empty text. Broken markup never fails: a "<" that starts no tag is
    text, open elements end with the page. All other columns pass through; an empty table gives no rows.
    """
    small_batches(pages.sparkSession)

    def run(batches):
        for batch in batches:
            texts = pa.array([main_text(h) for h in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([texts, *batch.columns[1:]], ["text_", *batch.schema.names[1:]])

    rest = [c for c in pages.columns if c != out_col]
    named = pages.select(F.col(f"`{html_col}`").alias("html_"), *[F.col(f"`{c}`").alias(f"c{i}_") for i, c in enumerate(rest)])
    fields = ", ".join(f"c{i}_ {named.schema[f'c{i}_'].dataType.simpleString()}" for i in range(len(rest)))
    out = named.mapInArrow(run, "text_ string" + (", " + fields if fields else ""))
    return out.select(*[F.col(f"c{i}_").alias(c) for i, c in enumerate(rest)], F.col("text_").alias(out_col))
