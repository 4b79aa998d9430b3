"""Articles inside elements whose names are also those of page furniture."""

import pytest

from txnlens.llm import html

ARTICLE = [f"Sentence {i} of the article, with some words in it; it goes on, and ends here." for i in range(8)]
BODY = "".join(f"<p>{x}</p>" for x in ARTICLE)
AROUND = ("<nav><a>Home</a><a>News</a></nav><div class='cookie-notice'>We use cookies. Accept?</div>{}"
          "<div class='comments'><p>First comment, short.</p></div><footer>Imprint, legal.</footer>")


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "right-sidebar main", "layout-2col-sidebar", "page-wrapper side-menu-open",
                                  "entry-header", "post-tags", "article-share-wrap", "legal-news", "search-results"])
def test_wrappers_keep_their_article(name):
    inner = f"<div class='{name}'><div class='post'>{BODY}</div><div class='sidebar'><p>Other things, in short.</p></div></div>"
    assert html.main_text(AROUND.format(inner)) == "\n".join(ARTICLE)
    assert html.main_text(AROUND.format(f"<div class='{name}'><div class='sidebar-wrap'>{BODY}</div></div>")) == "\n".join(ARTICLE)


def test_names_still_tell_where_there_is_an_article():
    long = "".join(f"<p>Comment {i}, longer than the article; it has commas, too.</p>" for i in range(60))
    page = f"<div class='post'>{BODY}</div><div class='comments'>{long}</div><div class='related'><article><p>Another, one.</p></article></div>"
    assert html.main_text(page) == "\n".join(ARTICLE)


def test_pages_of_furniture_alone_stay_empty():
    assert html.main_text("<nav><a>Home</a></nav><div class='cookie-notice'>We use cookies, as all do. Accept?</div>") == ""
