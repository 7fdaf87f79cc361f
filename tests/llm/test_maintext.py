import html
import re

import numpy as np
import pytest
from llm_helpers import SF
from pyspark.sql import functions as F

from chromasea.llm import maintext as mt
from chromasea.llm.queries import QUERIES

PAGES = "page_id long, url string, html string"
LONG = "A paragraph of many words stands here, and it goes on for a while. "


def plain(page):
    """The article of the given pages, cut out by patterns."""
    found = re.search(r"<article>(.*)</article>", page, re.S)
    text = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", found.group(1)))
    return " ".join(html.unescape(text).split())


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("   \n", ""), ("plain text &amp; more", "plain text & more"), ("<p>a<b>b</b>c&#33;&nbsp; d<br>e</p><p>f", "abc! d e f"),
    ("<script>var a = '<p>no</p>'</script><p>yes</p><style>p{}</style>", "yes"), ("<!-- no --><p>5 < 6", "5 < 6"),
    ("<nav>menu</nav><form><p>form</p></form>", ""),
    (f"<nav><a>1</a><a>2</a><article><p>{LONG}</p></article>", LONG.strip()),
    (f"<div class='ad'>{LONG}{LONG}</div><article><h1>T</h1><p>x</p></article><footer>{LONG}</footer>", "T x"),
    (f"<main><article><header><h2>T</h2><p>by</p></header><p>{LONG}</p><span class='ad'>no <span>no</span> no</span><p>Short.</p>"
     f"<aside>{LONG}</aside></article><section id='comments'><article class='comment'>{LONG}</article></section></main>", f"T {LONG}Short."),
    (f"<div class='menu'><a>a</a> <a>b</a></div><div id='page'><div><p>{LONG}</p><p>Ok.</p><p>{LONG}</p></div></div><div><a>x</a><a>y</a><a>z</a></div>", f"{LONG}Ok. {LONG.strip()}"),
    ("<title>no</title><body><header>no</header><div role='navigation'>no</div><p>yes</p><noscript>no</noscript>", "yes"),
])
def test_pages(page, text):
    assert mt.main_text(page) == text


def test_long_and_deep_pages():
    assert mt.main_text("<p>" + "word " * 300_000) == ("word " * 300_000).strip()
    assert mt.main_text("<div>" * 20_000 + "x") == "x"
    assert mt.main_text("<p>a</p>" * 20_000) == " ".join(["a"] * 20_000)


def test_smoothing_and_threshold():
    assert np.allclose(mt.smoothed(np.full(9, 4.0)), 4.0)
    ratios = np.array([2.0, 1, 2, 300, 280, 20, 310, 1, 2, 1])
    chosen = mt.content_lines(ratios)
    assert chosen[[3, 4, 5, 6]].all() and not chosen[[0, 1, 9]].any()
    assert mt.content_lines(np.array([5.0])).all()


def test_table_with_nulls_repeats_and_other_columns(spark):
    rows = [(1, "u", "<p>a b</p>"), (1, "u", "<p>a b</p>"), (None, None, None), (2, None, "")]
    df = spark.createDataFrame(rows, PAGES).withColumn("text", F.lit(1)).withColumn("n_chars", F.lit("clash"))
    assert sorted((tuple(r) for r in mt.extract(df).collect()), key=str) == sorted([(1, "u", "a b", 3), (1, "u", "a b", 3), (None, None, "", 0), (2, None, "", 0)], key=str)
    assert mt.extract(spark.createDataFrame([], PAGES)).collect() == []


def test_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op12_main_text"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        text = plain(pages[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, text, len(text))
