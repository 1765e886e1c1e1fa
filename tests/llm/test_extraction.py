"""Blocks of odd markup, held-out labelled pages, pages given and edge rows."""

import time
import tracemalloc
from collections import Counter

import pytest

from conftest import SF_SMALL
from wardstar.llm import extraction as X
from wardstar.llm.dom import leaf_blocks
from wardstar.llm.labelled_pages import labelled_pages


def texts(page):
    return [b.text for b in leaf_blocks(page)]


def test_leaf_blocks():
    assert texts("<p>a <b>b<br>c</b>d &amp; &eacute;&#x41;</p>\n<div>e\n\t f<div>g</div>h</div>") == ["a b cd & éA", "e f", "g", "h"]
    assert texts("x<script>var a = '<p>no</p>';</script>y<style>p{}</style><!-- <p>no</p> -->z") == ["xyz"]
    assert texts("<p>one<p>two<ul><li>three<li>four</ul>five") == ["one", "two", "three", "four", "five"]
    assert texts("<head><title>no</title></head><body>a < b &lt; c</body>") == ["a < b < c"]
    assert texts("<p title='a>b'>c</p><p") == ["c"] and texts("<script>never closed <p>x") == [] and texts(None) == texts("") == []
    blocks = leaf_blocks('<div class="Top-nav x"><a href="#">go</a> on</div><article><p>x')
    assert blocks[0].names == ("top", "nav", "x") and blocks[0].linked == 2 and blocks[1].path == ("article", "p")


def test_text_of_broken_and_embedded_markup_stays():
    assert texts("<p>if a < b then c <d") == ["if a < b then c"] and texts("<p>1 < 2, 3 <4 and <") == ["1 < 2, 3 <4 and <"]
    assert texts("<p>a</p") == texts("<p>a<!-- b") == texts("<p>a<!b") == ["a"]
    for tag in ("svg", "object", "video", "audio", "canvas", "noscript", "iframe", "template", "select"):
        assert texts(f"<p>a</p><{tag} class='x'><p>b</p><p>c") == ["a", "b", "c"], tag
    for tag in ("svg", "video", "audio", "canvas", "iframe", "template", "select"):
        assert texts(f"<p>a</p><{tag}><p>no</p></{tag}><p>c") == ["a", "c"], tag
        assert texts(f"<{tag}><p>a</p><{tag}>no</{tag.upper()} ><p>c</p><{tag}/>d") == ["a", "c", "d"], tag
        assert texts(f"<{tag}>no<{tag}>no</{tag}>no<script>'</{tag}>'</script>no</{tag}>yes") == ["yes"], tag
    for tag in ("script", "style", "title", "textarea"):
        assert texts(f"<p>a</p><{tag}><p>no</p><{tag}>no") == ["a"], tag
    assert texts("<p>so <math display='inline'><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow></math> holds</p>") == ["so x=1 holds"]
    assert texts("<p>see <object data='x'>a plan</object> <noscript>or this</noscript></p>") == ["see a plan or this"]


def test_held_out_labelled_pages():
    pages = [leaf_blocks(p) for p in labelled_pages(300, seed=99)]
    plain = [[b._replace(text=b.text.removeprefix(X.MARK)) for b in blocks] for blocks in pages]
    hit = said = there = 0
    for blocks, got in zip(pages, X.main_blocks(plain, X.learn())):
        want = Counter(b.text[1:] for b in blocks if b.text.startswith(X.MARK))
        hit, said, there = hit + (want & Counter(got)).total(), said + len(got), there + want.total()
    assert hit / said > 0.98 and hit / there > 0.98


def test_registered_query(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    want = {p.page_id: "\n\n".join(b.text for b in leaf_blocks(p.html) if "article" in b.path) for p in pages}
    out = X.op4_html_extraction(spark, SF_SMALL).collect()
    assert sorted(r.page_id for r in out) == sorted(want) and all(r.n_chars == len(r.text) for r in out)
    assert sum(r.text == want[r.page_id] for r in out) / len(out) > 0.98


def test_edges(spark):
    article = "<article><h1>Head</h1><p>Some words of the text, and more of them.</p></article>"
    rows = [(1, "u", None, "a"), (2, None, "", None), (None, "u", article, None), (3, "u", article, None), (3, "u", article, None),
            (4, "u", f"<nav><ul><li><a href='/'>Home</a></li></ul></nav>{article}<footer>© 2024 All rights reserved.</footer>", None),
            (5, "u", "<article>" + "<p>A paragraph of words that goes on. </p>" * 20000 + "</article>", None), (6, "u", "<nav><a href='/'>Home</a></nav>", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = X.extract(df).collect()
    assert len(out) == 8 and out[0].text == out[1].text == "" and out[7].text == ""
    assert all(out[i].text == "Head\n\nSome words of the text, and more of them." for i in (2, 3, 4, 5))
    assert out[6].n_blocks == 20000
    assert X.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("page, blocks", [
    ("<div>x" * 100_000, 100_000),
    ("<div class='a b'><p>x" * 50_000 + "</q>" * 100_000, 50_000),
    ("x" + "<a " * 350_000, 1),
    ("x" + "<a " * 350_000 + ">", 1),
    ("x" + "<a b='>'" * 100_000 + '"', 1),
    ("x" + '<a b="' * 150_001 + ">", 1),
    ("x" + "<head>" * 100_000, 1),
    ("x<!-- " * 100_000, 1),
])
def test_hostile_pages_take_time_and_memory_by_their_size(page, blocks):
    tracemalloc.start()
    begin = time.process_time()
    found = leaf_blocks(page)
    took, peak = time.process_time() - begin, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == blocks and took < 20 and peak < 200 << 20


def test_a_missing_quote_leaves_no_markup():
    assert texts('<p class="x>Hello world</p><p>more') == ["Hello world", "more"]
    assert texts("<p title=it's>a</p><p title='a>b'>c</p><p class = \"d>e\">f") == ["a", "c", "f"]
    assert texts("a<!-- b > c") == ["a"]
