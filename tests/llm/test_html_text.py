"""Main text of pages."""

import pytest

from trackline.llm.html_text import extract, lines, main_text

PAGE = """<html><head><title>T</title><style>p{}</style></head><body>
<div id="page-header"><p>The site's own long banner text, which is not part of it</p></div>
<nav><ul><li><a href="/">Home</a><li><a href="/x">More</a></ul></nav>
<div class="cookie-notice"><p>We use cookies and tell you so at length, as the law wants it.</p></div>
<div class="content has-sidebar"><h1>Title &amp; more</h1><p>First <b>bold</b>ly with a <a href=x>link</a>.<p>Second<br>line
&lt;b&gt; 1 &lt; 2 &#233;&nbsp;x</p><div class="advert"><p>Buy now</p></div><ul><li>One<li>Two</ul>
<span class="share-button">Share</span><p>The last one, the end of the article's text.</p></div>
<aside>Beside</aside><section id="comments"><p>Nice post! I really loved reading all of that, thanks a lot</p></section>
<form><input name=q>Find<button>Go</button></form><footer>Foot</footer><script>var x = "</p>";</script></body></html>"""


def test_page_without_marked_article():
    assert main_text(PAGE) == (
        "Title & more First boldly with a link. Second line <b> 1 < 2 é x One Two The last one, the end of the article's text."
    )


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), (" \n", ""), ("<p>", ""), ("<article></article>", ""), ("plain text", "plain text"),
        ("<article><p>Hi</p><aside>no</aside> tail", "Hi tail"), ("<script>x</script>abc<", "abc<"), ("a <!-- c", "a"),
        ("<article><header><h1>Head</h1></header><p>Body</article><p>Outside, much longer than what is inside</p>", "Head Body"),
        ("<article>A<div class=ad>x<article>B</article>", "A"), ("<main><p>x &am; &amp &copy;</main>", "x &am; & ©"),
        ("<article><P CLASS='Ad'>x</P><p hidden>y<p>z</article>", "z"), ("<article><p>a<!-- > --><![CDATA[q]]>b</article>", "ab"),
        ("<nav>only a menu</nav>", ""), ("<article>a<textarea>b</textarea>c</article>", "ac"),
    ],
)
def test_cases(page, text):
    assert main_text(page) == text


def test_weak_stretches_are_left():
    filler = "".join("<div></div><nav>x</nav><nav>y</nav><nav>z</nav>" for _ in range(2))
    page = f"<body><p>tiny</p>{filler}<p>{'long text ' * 30}</p><p>short</p><p>{'more text ' * 20}</p>{filler}<p>end</p></body>"
    assert main_text(page) == " ".join(f"{'long text ' * 30} short {'more text ' * 20}".split())


def test_long_page():
    page = "<article>" + "<p>word &amp; word</p>" * 20_000
    assert main_text(page) == " ".join(["word & word"] * 20_000)


def test_lines_are_blocks():
    assert [(x.text, x.linked, x.apart) for x in lines("<p>a<a href=1>bc</a><p>d<nav>e</nav>")] == [
        ("abc", 2, False), ("d", 0, False), ("e", 0, True),
    ]


def test_rows(spark, sf_dir):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (3, "", "", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    text = main_text(PAGE)
    want = [(1, "u", text, len(text))] * 2 + [(None, None, "", 0), (3, "", "", 0)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert extract(pages.limit(0)).collect() == []


def test_given_pages(spark, sf_dir):
    """The given pages mark their article; there the blocks are known without any tree."""
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in extract(pages).collect()}
    for row in pages.collect():
        inside = re.sub(r"</?b>", "", re.search(r"<article>(.*)</article>", row.html, re.DOTALL)[1])
        blocks = [" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:p|h1|br)>", inside)]
        assert got[row.page_id] == " ".join(x for x in blocks if x)


LINK = "<a href=/x>%s</a>"


@pytest.mark.parametrize("tag", ["article", "div"])
def test_linked_title_and_list(tag):
    items = "".join(f"<li>{LINK % f'Source {n}'}</li>" for n in range(6))
    page = f"<nav>{LINK % 'Home'}</nav><{tag}><h1>{LINK % 'Title'}</h1><p>Body of it</p><ul>{items}</ul></{tag}><footer>Foot</footer>"
    assert main_text(page) == " ".join(["Title Body of it", *[f"Source {n}" for n in range(6)]])


def test_names_inside_an_article_count_by_what_they_name():
    page = (
        '<article><p>one</p><div class="related-work">two</div><h2 class="widget-title">three</h2>'
        '<section id="search-methods"><p>four</p></section><div class="share-buttons">no</div><div id="ad-slot-3">no</div>'
        '<p class="cookie-notice">no</p><div class="comments"><p>no</p></div><span class="ad">no</span>'
        '<div class="relatedArticles">no</div><p class="notice-period">five</p></article>'
    )
    assert main_text(page) == "one two three four five"


def test_article_of_links():
    page = f"<nav>{LINK % 'Home'}</nav><article><h2>{LINK % 'One'}</h2><p>{LINK % 'Two'}</p><aside>{LINK % 'x'}</aside></article>"
    assert main_text(page) == "One Two"


def test_short_paragraphs_beyond_apart_lines():
    adverts = "".join(f'<div class="advert"><p>Buy {n}</p></div>' for n in range(4))
    first, long, last = "A short introduction.", "many words " * 200, "The closing paragraph."
    page = f"<body><p>{first}</p>{adverts}<p>{long}</p>{adverts}<p>{last}</p></body>"
    assert main_text(page) == f"{first} {long.strip()} {last}"


def test_given_pages_without_mark(spark, sf_dir):
    """With div instead of article, every line of the marked text is still there."""
    for row in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        bare = row.html.replace("<article>", "<div>").replace("</article>", "</div>")
        inside = [x.text for x in lines(row.html) if x.main and not x.apart]
        got = main_text(bare)
        assert all(x in got for x in inside)
