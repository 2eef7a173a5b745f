import html
import re

import pytest

from claimloom.llm.html_text import extract, main_text

PAGE = """<!doctype html><html><head><title>T</title><style>p{x:1}</style></head><body class="has-sidebar">
<header class="top"><a href="/">Site</a></header><nav><ul><li><a>Menu one</a></ul></nav>
<div id="cookie-notice">We use cookies on this site, click here to agree.</div>
<main><article class="post has-comments"><header><h1>The   title</h1></header>
<p>First &lt;para&gt; with <b>bold</b> and a <a href="x>y">link</a>.<p>Be.<div class="ad">Buy now!</div><p>A<br>B</p>
<script>var t = "</p><p>no"; if (a<b) {}</script><ul><li>item one</li><li>item two</ul>
<aside>related things</aside><form><label>name</label><input></form></article>
<section class="comments"><article class="comment"><p>Reader comment, quite long, with many words in it.</p></article></section></main>
<footer>&copy; site</footer></body></html>"""


def test_a_page_with_everything():
    assert main_text(PAGE) == "The title\n\nFirst <para> with bold and a link.\n\nBe.\n\nA B\n\nitem one\n\nitem two"


def test_pages_without_an_article_element():
    page = """<body><div class="menu"><a>one</a><a>two</a></div><div>Home</div><p>One long sentence here, for you to read.</p><p>Ok.</p>
    <div class="sidebar"><p>side text that is long enough</p></div><p>More text of the page after that.</p><div class="footer">end</div>"""
    assert main_text(page) == "Home\n\nOne long sentence here, for you to read.\n\nOk.\n\nMore text of the page after that."


def test_broken_markup():
    assert main_text("<head><title>x<body><article><p>text & more &amp; 'quote</article>") == "text & more & 'quote"
    assert main_text("<article><div class=ad><div>in</div>ad</div><p>out</article>") == "out"
    assert main_text("<article><p>a < b and c > d <!-- x --> e<![CDATA[f]]></article>") == "a < b and c > d ef"
    assert main_text("<article>") == main_text(None) == main_text("") == main_text("<nav>x</nav>") == ""


@pytest.mark.parametrize(
    ("before", "after"),
    [
        ('<div class="page has-sidebar">', "</div>"), ('<div class="no-sidebar">', "</div>"), ('<div id="content-sidebar-wrap">', "</div>"),
        ('<section class="search-result-page">', "</section>"), ("<form id=aspnetForm>", "</form>"), ("<form><fieldset>", "</fieldset></form>"),
        ('<main><div class="content-sidebar-wrap">', "</div></main>"), ('<div class="page hidden wide">', "</div>"), ("<div hidden>", "</div>"),
    ],
)
def test_names_around_the_article(before, after):
    side = '<div class="sidebar"><p>Side text, longer than the whole article is, and then some more of it.</p></div>'
    inner = f'<article class="post"><h1>Title</h1><p>One text.</p></article>{side}'
    comments = '<div class="comments"><article class="comment">Not this.</article></div>'
    assert main_text(f"<body>{before}{inner}{comments}{after}<footer>end</footer>") == "Title\n\nOne text."
    plain = inner.replace("article", "div").replace("One text.", "One text of some length, with more words than there are beside it, as pages have it.")
    assert main_text(f"<body>{before}{plain}{after}<footer>end</footer>").startswith("Title\n\nOne text of")


def test_articles_with_names_of_chrome():
    assert main_text('<body><article class="related-12 post"><p>The text.</p></article>') == "The text."
    two = '<article class="related-12 post"><p>Other.</p></article>'
    assert main_text(f"<body><article><p>The text.</p></article>{two}") == "The text."
    assert main_text('<div class="cookie-notice">We use cookies on this site.</div>') == ""


def test_windows_choose_inside_an_article():
    links = "".join(f'<li><a href="/{i}">Another story of this site, number {i}</a></li>' for i in range(5))
    body = '<h1><a href="/x">Linked title</a></h1><p>First text.</p><p><a href="/y">A line in a link.</a></p><p>Last text, of more words.</p>'
    want = "Linked title\n\nFirst text.\n\nA line in a link.\n\nLast text, of more words."
    assert main_text(f"<article>{body}<div class=tail><ul>{links}</ul></div></article>") == want
    assert main_text(f"<main><ul class=latest>{links}</ul>{body}</main>") == want
    between = main_text(f"<article>{body}<ul>{links}</ul><p>After the list.</p></article>")
    assert between == f"{want}\n\nAfter the list."
    assert main_text(f"<article><ul>{links}</ul></article>").count("Another story") == 5  # the article itself is links
    assert main_text("<article>42</article>") == "42"


def test_a_short_article_beside_the_text():
    text = "The text of this page stands in no article, and it is much longer than the teaser is. " * 3
    assert text.strip() in main_text(f"<body><div><p>{text}</p></div><article><p>Read this.</p></article>")


def test_sample_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in extract(pages).collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.DOTALL)[1]
        blocks = re.split(r"</?(?:p|h1)[^>]*>", article)
        blocks = [" ".join(html.unescape(re.sub(r"<!--.*?-->|</?b>", "", b.replace("<br>", "\n"))).split()) for b in blocks]
        assert r.text == "\n\n".join(b for b in blocks if b)


def test_edges(spark):
    long = "<article>" + "<p>x y</p>" * 20_000 + "</article>"
    rows = [(1, "u", None, "clash"), (1, "u", None, "clash"), (None, None, "", None), (2, None, long, "z")]
    got = extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()
    assert [r.text for r in got[:3]] == ["", "", ""] and len(got[3].text) == 20_000 * 5 - 2
    assert extract(spark.createDataFrame([], "page_id bigint, html string")).count() == 0


def test_formulas_stand_in_their_sentence():
    page = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x = 2</annotation></math> be the first prime number there is.</p></article>"
    assert main_text(page) == "Let x=2 be the first prime number there is."


def test_short_pages_keep_their_lines():
    assert main_text("<body><div>Closed.</div><div></div><div></div><div></div><div>Call us</div></body>") == "Closed.\n\nCall us"
    assert main_text("<body><nav><a href=x>Home</a></nav><div><a href=y>About</a></div></body>") == ""


def test_windows_part_nameless_menus_from_text():
    """No class, no article: link lists and scattered words stand apart from the text by their windows alone."""
    menu = "".join(f"<div><div><a href=/{i}>Item {i}</a></div></div>" for i in range(12))
    crumbs = "<div>Sign</div><div><a href=q>all of the pages</a></div><div><a href=r>of this whole site</a></div><div><a href=s>are here as links</a></div>"
    body = "".join(f"<p>Sentence number {i} of a text that goes on for a while and says something.</p>" for i in range(6))
    page = f"<html><body><div>{menu}{crumbs}</div><div>{body}</div><div>{menu}</div></body></html>"
    text = main_text(page)
    assert text.count("Sentence number") == 6 and "Item" not in text and "Sign" not in text
