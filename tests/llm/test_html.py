"""Main text of pages: the given tables against a plain reading, and odd markup."""

import html
import re

import pytest

from creditpath.llm.html_extract import extract, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/x">X</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, many, many of them, and more, and more, on this page.</p></div>
<div id="content"><h1>Title &amp; more</h1><p>First&nbsp;one,
 with   blanks.<p>Second <b>bold<i>er</b> text &lt;kept&gt; <a href="#">a link</a>.
<ul><li>item one<li>item two</ul><!-- <p>comment</p> --><form><p>Subscribe, now, please<input></form>
<div class="ad"><p>Buy this, that, and the other thing</p></div><aside><p>Side, bar, text</p></aside>
<div class="comments"><p>Nice, article, thanks, a lot</p></div></div><footer><p>Foot, er</p></footer></body></html>"""


def test_article_without_the_rest():
    assert main_text(PAGE).split("\n") == [
        "Title & more", "First one, with blanks.", "Second bolder text <kept> a link.", "item one", "item two",
    ]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        ("<p>a</p", "a"),
        ("<div><p>one<br>two</div>", "one two"),
        ("<div><p>cut &am", "cut &am"),
        ("<div><p>a &amp b &#65; &#x42; &eacute;", "a & b A B é"),
        ("<div><p>x</p><script>never ends", "x"),
        ("<div><p>x<!-- never ends", "x"),
        ("<div><p>1 < 2 <3</p></div>", "1 < 2 <3"),
        ("<div><p title='a > b'>q</p></div>", "q"),
        ("<div><p title='open>q</p></div>", "q"),
        ("<article><h1>only a title</h1></article>", "only a title"),
        ("<nav><p>menu, only</p></nav>", ""),
        ("<DIV><P>Upper</P></DIV>", "Upper"),
        ("</p></div><div>x<p>y</div></b>", "x\ny"),
        ("<main><section><p>a, b</section><section><p>c</section></main><div>other</div>", "a, b\nc"),
        ("<div>text in a div</div>", "text in a div"),
    ],
)
def test_odd_markup(page, text):
    assert main_text(page) == text


def test_deep_and_long_pages():
    assert main_text("<div>" * 30_000 + "<p>x") == "x"
    assert main_text("<p>" + "word " * 200_000).startswith("word word")
    assert main_text("<b>" * 20_000 + "</i>" * 20_000 + "<div><p>x") == "x"
    assert main_text('<p a="' * 5_000) == ""


LONG = "A sentence of the article, with commas, and more words. " * 8


@pytest.mark.parametrize(
    "names",
    ["post has-sidebar", "no-sidebar content", "content-with-sidebar", "article search-result", "widget", "single related", "no-sidebar"],
)
@pytest.mark.parametrize("tag", ["article", "main", "div", "section"])
def test_article_in_a_container_with_a_doubtful_name(tag, names):
    page = f'<body><nav><a href=x>Home</a></nav><{tag} class="{names}"><h1>Title</h1><p>{LONG}</p><p>End.</p></{tag}></body>'
    assert main_text(page).split("\n") == ["Title", LONG.strip(), "End."]


@pytest.mark.parametrize("tag", ["div", "header"])
def test_header_of_an_article(tag):
    page = f'<article><{tag} class="entry-header"><h1><a href="/x">Title</a></h1></{tag}><p>{LONG}</p></article>'
    assert main_text(page).split("\n") == ["Title", LONG.strip()]


def test_names_leave_out_what_is_short_or_links():
    links = "".join(f"<li><a href=/{i}>Some other story of this site {i}</a></li>" for i in range(20))
    menu = '<div class="main-menu"><ul>' + links + "</ul></div>"
    page = f'<div class="content">{menu}<p>{LONG}</p><div class="related"><ul>{links}</ul></div><div class="share">Share this</div></div>'
    assert main_text(page) == LONG.strip()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div id=wrap><h1>T</h1><p>Lead</p><div class=content><p>{LONG}</p><p>{LONG}</p></div><p>End</p></div>", ["T", "Lead", LONG, LONG, "End"]),
        (f"<div><h2>H</h2><ul><li>one<li>two</ul><div><p>{LONG}</p><p>{LONG}</p></div><section><p>Short.</p></section></div>", ["H", "one", "two", LONG, LONG, "Short."]),
        (f"<div>Before, <b>bold</b> <a href=x>l</a><div><p>{LONG}</p><p>{LONG}</p></div>after</div>", ["Before, bold l", LONG, LONG, "after"]),
        (f"<body>{LONG}<br>{LONG}<br><br>The end</body>", [LONG + LONG + "The end"]),
        (f"<html>{LONG}", [LONG]),
        (LONG, [LONG]),
        ("short text", ["short text"]),
        (f"<center>{LONG}</center>", [LONG]),
        (f"<body><span>{LONG}</span><div><p>small</p></div></body>", [LONG, "small"]),
        (f"<body><nav>menu</nav>{LONG}<div class=share>Share</div></body>", [LONG]),
        ("<h1>only</h1><h2>headings</h2>", ["only", "headings"]),
        (f"<body><ul><li><a href=x>A</a><li><a href=y>B</a></ul><div><p>{LONG}</p></div></body>", [LONG]),
        (f"<body>By, the way<article><p>{LONG}</p></article><p>other</p></body>", [LONG]),
    ],
)
def test_text_beside_the_best_container_and_loose_text(page, text):
    assert main_text(page).split("\n") == [" ".join(t.split()) for t in text]


@pytest.mark.parametrize("size", [10, 500, 5_000])
@pytest.mark.parametrize(
    "names",
    ["comments", "post-comments", "comment-content", "comment-list", "cookie-notice", "notice", "sidebar", "page-footer", "site-footer",
     "sidebar-left", "article-replies", "ad", "ad-box", "main-menu", "disqus_thread", "entry related-posts ads", "consent"],
)
@pytest.mark.parametrize("tag", ["article", "main", 'div class="content"'])
def test_other_parts_inside_the_container(tag, names, size):
    """Whatever their length, also beyond the article's own."""
    other = f'<div class="{names}"><p>{("Well, said, all of it. " * 400)[:size]}</p><p>More, of, it.</p></div>'
    page = f"<body><{tag}><h1>Title</h1><p>{LONG}</p>{other}<p>{LONG}</p></{tag.split()[0]}></body>"
    assert main_text(page).split("\n") == ["Title", LONG.strip(), LONG.strip()]


@pytest.mark.parametrize("names", ["related", "social-share", "newsletter", "widget"])
def test_doubtful_parts_stay_out_of_an_article(names):
    page = f'<article><h1>Title</h1><p>{LONG}</p><div class="{names}"><p>Other, words, of the site.</p></div><p>{LONG}</p></article>'
    assert main_text(page).split("\n") == ["Title", LONG.strip(), LONG.strip()]


@pytest.mark.parametrize("names", ["sidebar", "menu wrapper", "notice"])
def test_frame_around_the_page(names):
    page = f'<body><div class="{names}"><main><h1>Title</h1><p>{LONG}</p></main></div><p>small, print</p></body>'
    assert main_text(page).split("\n") == ["Title", LONG.strip()]


def test_teasers_are_other_stories():
    teaser = f"<article><h2>Another</h2><p>{LONG[:150]}</p><a href=x>more</a></article>"
    text = f"<article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></article>"
    for page in (teaser + text, text + teaser, f"<main>{teaser}{text}{teaser}</main>", f"<div>{text}{teaser}</div>"):
        assert main_text(f"<body>{page}</body>").split("\n") == ["Title", LONG.strip(), LONG.strip()]
    page = f"<main><h1>Title</h1><article><p>{LONG}</p></article>{teaser}<p>End.</p></main>"
    assert main_text(page).split("\n") == ["Title", LONG.strip(), "End."]


def plain(page):
    m = re.search(r"<article>(.*?)(</article>|$)", page, re.S)
    parts = re.split(r"<p>|</p>|<h1>|</h1>", m.group(1) if m else "")
    lines = (" ".join(html.unescape(re.sub(r"<[^>]*>?", "", x)).split()) for x in parts)
    return "\n".join(x for x in lines if x)


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].text == plain(r.html)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_null_and_repeated_rows(spark):
    rows = [(1, None, None, "a"), (None, "u", "<div><p>x", "b"), (2, "u", "<div><p>x", "c"), (2, "u", "<div><p>x", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(pages).collect()
    assert sorted(r.text for r in got) == ["", "x", "x", "x"]
    assert extract(pages.limit(0)).count() == 0
