"""Main text of invented pages: compound names, wrappers, pages without an article, deep and broken ones."""

import os
import re
import time
import tracemalloc

import pyarrow.parquet as pq
import pytest

from weirstone.llm.path_ratios import main_text

FOLDER = os.environ.get("TEST_LLM_DIR", "/root/testdata/sf0.01")
TEXT = "<p>" + "This is what the page tells, with some words, and signs. " * 8 + "</p>"
SAID = " ".join(re.sub(r"<[^>]*>", " ", TEXT * 3).split())
NAMES = (
    "comment-list post-comments user-comment comments-area CommentThread cookie-notice related-posts site-footer share-buttons "
    "reader-responses newsletter_signup"
).split()


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("around", ["article", "div", "section"])
def test_compound_names_go_wherever_they_stand(name, around):
    long = f"<p>{'What a reader said, really. ' * 25}</p><p>And another one.</p>"
    page = f"<html><body><{around}><h1>Head line</h1>{TEXT * 3}<div class='x {name}'>{long}</div></{around}></body></html>"
    assert main_text(page) == f"Head line {SAID}"


@pytest.mark.parametrize("name", ["layout right-sidebar", "has-comments", "no-footer", "page-with-nav"])
def test_wrappers_of_a_page_hide_nothing(name):
    for inner in (TEXT * 3, f"<article>{TEXT * 3}</article>", f"<div>{TEXT * 3}</div>"):
        assert main_text(f"<body class='{name}'><div class='{name}'>{inner}</div><footer>The foot.</footer></body>") == SAID
    assert main_text(f"<form action='/'>{TEXT * 3}</form>") == SAID


def test_paths_choose_the_nodes_without_an_article():
    """The given pages give the same text when no element says where the article is."""
    pages = pq.read_table(f"{FOLDER}/pages.parquet", columns=["html"]).column(0).to_pylist()
    tag = re.compile(r"<(/?)(?:article|main)\b[^>]*>")
    for page in pages:
        assert main_text(tag.sub(r"<\1div>", page or "")) == main_text(page)


def test_different_names_are_different_paths():
    rows = "".join(f"<div class='a b c d {n}'><p>{t}</p></div>" for n, t in (("zz", "Menu"), ("yy", TEXT)))
    assert main_text(f"<body><div>{rows * 3}</div></body>").count("some words") == 24


@pytest.mark.parametrize(
    "page,end",
    [("<div>" * 200_000 + TEXT, 456), ("<b>" * 8_000 + "</i>" * 80_000 + TEXT, 456), ("<b>" * 20_000 + "<p>x " * 20_000, 39_999)],
)
def test_deep_and_unclosed_pages_take_memory_and_time_by_length(page, end):
    start = time.perf_counter()
    out = main_text(page)
    assert time.perf_counter() - start < 15 and len(out) == (len(SAID) // 3 if end == 456 else end)
    tracemalloc.start()
    try:
        main_text(page)
        assert tracemalloc.get_traced_memory()[1] < 100 << 20
    finally:
        tracemalloc.stop()
