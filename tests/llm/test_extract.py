from __future__ import annotations

import pytest

from tallyloom.llm import extract
from tallyloom.llm.markup import pieces, plain_text

LONG = "A sentence of the article, with commas, that goes on for a while. And another one follows it here."
ARTICLE = f"<h1>The &amp; title</h1><p>{LONG}</p><p>Second <b>bold</b>ly <a href='/x'>linked</a> part; {LONG}<br>new line</p>"
WANT = f"The & title {LONG} Second boldly linked part; {LONG} new line"
AROUND = {
    "nav": "<nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>Blog, and more. Yes.</a></li></ul></nav>",
    "header": "<header><h1>Site name</h1><p>Motto, of the site.</p></header>", "footer": "<footer>&copy; someone. All rights reserved.</footer>",
    "aside": f"<aside><p>{LONG} {LONG}</p></aside>", "sidebar": f"<div class='left sidebar'><p>{LONG}</p></div>", "cookie": f"<div id=cookie-notice><p>We use cookies. {LONG}</p></div>",
    "ad": f"<div class=\"ad\">Buy now. {LONG}</div>", "form": "<form><label>Name</label><input value='x'><textarea>Some text</textarea></form>",
    "script": "<script>var t = \"</p><p>not text</p>\"; if (a<b) x();</script>", "style": "<style>p{margin:0}</style>", "comment": "<!-- a comment <p>x</p> -->",
    "comments": f"<section id='comments'><h2>Comments</h2><div class='comment'><p>{LONG} {LONG} {LONG}</p></div></section>",
    "menu": "<div class='main-menu'><a>One</a> <a>Two</a></div>", "role": f"<div role='complementary'><p>{LONG}</p></div>", "hidden": f"<div hidden><p>{LONG}</p></div>",
    "none": f"<div style='display: none'>{LONG}</div>", "camel": f"<div class='relatedPosts'>{LONG}</div>"}


@pytest.mark.parametrize("what", AROUND)
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div role='main'>{}</div>", "<div class='content'>{}</div>"])
def test_what_stands_around_goes(what, wrap):
    other = AROUND[what]
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{other}{wrap.format(ARTICLE)}{other}</body></html>"
    assert extract.main_text(page) == WANT


@pytest.mark.parametrize("what", [w for w in AROUND if w != "header"])
def test_what_stands_inside_goes(what):
    page = f"<html><body><article>{ARTICLE}{AROUND[what]}</article></body></html>"
    assert extract.main_text(page) == WANT


def test_everything_around_at_once():
    page = f"<body>{''.join(AROUND.values())}<div class='content'>{ARTICLE}</div>{''.join(AROUND.values())}</body>"
    assert extract.main_text(page) == WANT


def test_short_article_beside_long_advert():
    assert extract.main_text(f"<body><div class='ad'>{LONG * 5}</div><article><h1>T</h1><p><b>T<br></article><footer>f</footer></body>") == "T T"


def test_broken_markup():
    assert extract.main_text("<article><p><b>One.<br><p>Two &am</p></div><p>Thr&eacute;e &#33; &nbsp; x") == "One. Two &am Thrée ! x"
    assert extract.main_text("<article><p title='a > b'>x <i>y") == "x y"
    assert extract.main_text("<article><p>a < b and c<") == "a < b and c<"
    assert extract.main_text("just text, no tags") == "just text, no tags"
    assert extract.main_text("<p>never closed <script>var x") == "never closed"
    assert extract.main_text("<article><p>x</p><p unclosed='1") in ("x", "x unclosed='1")


def test_nothing():
    for page in ("", " \n", "<html></html>", "<nav>menu</nav>", "<!-- x -->"):
        assert extract.main_text(page) == ""


def test_several_articles_stay_in_order():
    page = f"<main><article><p>First. {LONG}</p></article><article><p>Second. {LONG}</p></article></main>"
    assert extract.main_text(page) == f"First. {LONG} Second. {LONG}"


def test_pieces_of_lists_and_tables():
    assert plain_text("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>") == "a\nb\nc\nd\ne"
    assert [t for e, t, end in pieces("a<title>no</title>b") if not end] == ["a", "b"]


def test_rows(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>"), (2, None, None), (None, "u", ""), (1, "u", f"<article>{ARTICLE}</article>"),
            (3, "u", "<article>" + f"<p>{LONG}</p>" * 3000 + "</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in extract.main_texts(pages).collect()), key=repr)
    texts = [WANT, "", "", WANT, " ".join([LONG] * 3000)]
    assert got == sorted(((i, u, t, len(t)) for (i, u, _), t in zip(rows, texts)), key=repr)
    assert extract.main_texts(pages.limit(0)).collect() == []


def test_whole_table(spark):
    """The test pages have one form, which a plain pattern can read."""
    import html
    import re
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in extract.main_texts(pages).join(pages.select("page_id", "html"), "page_id").collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?(?:b|p)>", "", x)).split()) for x in re.split(r"</?h1>|</?p>|<br>", body)]
        assert r.text == " ".join(b for b in blocks if b)


PARAGRAPHS = [f"{k}. {LONG} {LONG} {LONG}" for k in "abc"]
INNER = "".join(f"<p>{x}</p>" for x in PARAGRAPHS)


@pytest.mark.parametrize("block", ["<blockquote>{}</blockquote>", "<pre>{}</pre>", "<ul><li>{}</ul>", "<table><tr><td>{}</table>", "<section id='s1'>{}</section>"])
@pytest.mark.parametrize("place", range(4))
def test_one_long_block_takes_nothing_from_the_others(block, place):
    long = " ".join([LONG] * 30)
    blocks = [f"<p>{x}</p>" for x in PARAGRAPHS]
    blocks.insert(place, block.format(long))
    want = list(PARAGRAPHS)
    want.insert(place, long)
    for page in ("<body><nav>menu</nav><div class=content>{}</div></body>", "<body><div><a href=/>Home</a> <a href=/b>Blog</a></div>{}</body>"):
        assert extract.main_text(page.format("".join(blocks))) == " ".join(want)


@pytest.mark.parametrize("wrap", [
    "<div class='page has-sidebar'>{}</div>", "<div id='layout-with-menu'><div class=content>{}</div><div class=sidebar>Other, things.</div></div>",
    "<div class='no-comments widget-area'><article>{}</article></div>", "<main class='sticky-header'>{}</main>", "<article class='post sharing-on'>{}</article>",
    "<article><div class='share-wide'>{}</div></article>", "<div class='search-page'><div class='post-with-related'>{}</div></div>"])
def test_words_about_the_layout_empty_no_page(wrap):
    for around in ("", f"<div class='comments'><div class='comment'>{LONG}</div></div>"):
        assert extract.main_text(f"<body>{wrap.format(INNER)}{around}</body>") == " ".join(PARAGRAPHS)


def test_comments_marked_up_as_articles_go():
    comments = "".join(f"<article class='comment'><p>{LONG}</p></article>" for _ in range(9))
    for wrap in ("<article>{}</article>", "<div class='content'>{}</div>"):
        assert extract.main_text(f"<body>{wrap.format(INNER)}<section id='comments'>{comments}</section></body>") == " ".join(PARAGRAPHS)


def test_short_blocks_between_stay():
    page = f"<body><div class=content><p>{LONG}</p><pre>x = 1</pre><p>{LONG}</p><p><b>Bold</b> start. {LONG}</p></div></body>"
    assert extract.main_text(page) == f"{LONG} x = 1 {LONG} Bold start. {LONG}"


def test_deep_pages():
    assert extract.main_text("<div>" * 5000 + LONG) == LONG


LIST = "".join(f"<li><a href='/{k}'>Other page {k}</a></li>" for k in range(5))
TEASER = "<article class=card><h3><a href='/t'>Other story</a></h3><p><a href='/t'>Read on</a></p></article>"


@pytest.mark.parametrize("inside", [f"<ul>{LIST}</ul>", f"<div class=x><h4><a href=/>More</a></h4><ul>{LIST}</ul></div>".replace("h4", "div"),
                                    "<div class=k>" + "".join(f"<div><a href='/{k}'>Topic {k}</a></div>" for k in range(5)) + "</div>",
                                    "<table>" + "".join(f"<tr><td><a href='/{k}'>Page {k}</a></td></tr>" for k in range(5)) + "</table>"])
@pytest.mark.parametrize("article", ["<article>{}</article>", "<main>{}</main>"])
def test_rows_of_links_in_an_article_go_by_the_ratios(inside, article, monkeypatch):
    page = f"<body>{article.format(f'<h1>Title</h1>{INNER}{inside}')}</body>"
    assert extract.main_text(page) == " ".join(["Title", *PARAGRAPHS])
    monkeypatch.setattr(extract, "_smooth", lambda values: values * 0 + 1)
    assert extract.main_text(page) != " ".join(["Title", *PARAGRAPHS])


@pytest.mark.parametrize("inside", ["<ul><li>First point</li><li>Second point</li><li>Third</li></ul>", "<blockquote>Short.</blockquote>", "<pre>x = 1</pre>", "<h2>Part</h2>",
                                    "<table><tr><td>1</td><td>2</td></tr></table>", "<dl><dt>a</dt><dd>b</dd></dl>", "<figure><figcaption>A tree</figcaption></figure>", "loose words"])
def test_short_text_in_an_article_stays(inside):
    want = " ".join([*PARAGRAPHS, plain_text(inside).replace("\n", " "), PARAGRAPHS[0]])
    assert extract.main_text(f"<article>{INNER}{inside}<p>{PARAGRAPHS[0]}</p></article>") == want


def test_short_article_stays_and_teasers_go():
    short = "<article><p>A short one, but a text of its own.</p></article>"
    page = f"<body><article>{INNER * 5}</article>{short}<div>{TEASER * 3}</div></body>"
    assert extract.main_text(page) == " ".join([*PARAGRAPHS * 5, "A short one, but a text of its own."])
