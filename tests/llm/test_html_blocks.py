import html
import re

import pytest

from colloquy.llm import html_blocks as hb
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def tree():
    return hb.fit()


def plain(page):
    """The article of the synthetic pages, read with patterns."""
    out = []
    for x in re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*?)</article>", page, re.S).group(1)):
        x = " ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split())
        out += [x] if x else []
    return "\n".join(out)


def test_query_equals_the_article_of_every_page(spark, queries):
    sf = SF.replace("0.001", "0.01")
    want = sorted((r["page_id"], r["url"], plain(r["html"]), len(plain(r["html"])))
                  for r in spark.read.parquet(f"{sf}/pages.parquet").collect())
    assert sorted(tuple(r) for r in queries["op6_text_blocks"](spark, sf).collect()) == want


def used(tree):
    return set() if tree.low is None else {hb.FEATURES[tree.feature]} | used(tree.low) | used(tree.high)


def test_tree_splits_on_neighbours(tree):
    assert used(tree) & {"words_before", "words_after"} and used(tree) & {"links_before", "links_after"}


def test_unmarked_pages(tree):
    menu = "<ul>" + "<li><a href=x>one two</a></li>" * 4 + "</ul>"
    prose = ["Title of it", "sentence " * 30, "A break", "more " * 45, "words " * 22]
    page = menu + "".join(f"<div>{x}</div>" for x in prose) + menu + "<div>A word</div>" + menu
    assert hb.main_text(page, tree).split("\n") == [x.strip() for x in prose]


def test_tree_learns_its_table(tree):
    for page, labels in hb.labelled_pages():
        assert tree.predict(hb.block_features(hb.blocks(page))).tolist() == labels


@pytest.mark.parametrize("page,want", [
    ("<p>One.</p><p>Two &amp; <b>three</b>\n four</p>", "One.\nTwo & three four"),
    ("<nav><a href=x>read the whole long story here now</a></nav><article><p>Hi</p><div class='share'>post</div>"
     "<p><a href=x>link only</a></p><form><p>name</p><input></form><section id=comments><p>" + "nice " * 50 +
     "</p></section></article><footer>f</footer>", "Hi\nlink only"),
    ("<div class='cookie-notice'><p>" + "n " * 40 + "</p></div><main><p>A&nbsp;B&lt;c&gt;&#233;</p>tail<br>more</main>",
     "A B<c>é\ntail more"),
    ("<article><p>a<p>b<ul><li>c<li>d</ul><table><tr><td>e<td>f</table></article>", "a\nb\nc\nd\ne\nf"),
    ("<article><script>var x='<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes</p></article>", "yes"),
    ("<article><p>unclosed <b>bold", "unclosed bold"),
    ("<article><p>a <textarea>no</textarea><select><option>no</select>b</p></article>", "a\nb"),
    ("", ""), ("<<<>>>", "<<<>>>"), ("<body class='has-sidebar'><article><p>x</p></article>", "x"),
    ("<div class='content has-sidebar'><article><p>x</p></article></div>", "x"),
    ("<div class='layout-with-sidebar'><article><p>x</p></article></div>", "x"),
    ("<div id=page class='site no-header'><article><p>x</p></article></div>", "x"),
    ("<div class='social-history'><article><p>x</p></article></div>", "x"),
    ("<div class='site-header page'><p>top</p></div><div class=sidebar><article><p>x y</p></article></div>", "x y"),
    ("<div class=sidebar><main><p>x</p></main></div>", "x"),
    ("<article><p>x</p></article><div class=sidebar><article><p>teaser</p></article></div>", "x"),
    ("<article><p>x</p></article><section class='comment-list'><article><p>no</p></article></section>", "x"),
    ("<section class=related><article><p>no</p></article></section><article><p>x</p></article>", "x"),
    ("<article><header><h1>T</h1><p>by</p></header><p class='notice-period'>a</p><p class='legal-text'>b</p></article>",
     "T\na\nb"),
    ("<header><h1>Site</h1></header><article><p>x <math><mi>y</mi><annotation>q</annotation></math> z</p></article>", "x y z"),
    ("<article><div class=CookieNotice>no</div><div class='post-footer'>no</div><aside>no</aside><p>x</p></article>", "x"),
    ("<article><div hidden>no</div><div style='display:none'>no</div><p>x</p></article>", "x"),
])
def test_kinds_of_parts(tree, page, want):
    if page.startswith("<<<"):
        hb.main_text(page, tree)  # only that it does not fail
    else:
        assert hb.main_text(page, tree) == want


def test_edge_rows(spark):
    schema = "page_id long, url string, html string, text string"
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<article>é</article>", "x"),
            (3, "u", "<article>" + "<p>word</p>" * 20_000 + "</article>", "x"), (3, "u", "<b>" * 20_000, "x"),
            (4, "u", "<article>a</article>", None), (4, "u", "<article>a</article>", None)]
    out = hb.extract(spark.createDataFrame(rows, schema))
    got = sorted((str(r["page_id"]), len(r["text"]), r["n_chars"]) for r in out.collect())
    assert got == sorted([("1", 0, 0), ("2", 0, 0), ("None", 1, 1), ("3", 20_000 * 5 - 1, 20_000 * 5 - 1), ("3", 0, 0),
                          ("4", 1, 1), ("4", 1, 1)])
    assert hb.extract(spark.createDataFrame([], schema)).count() == 0
