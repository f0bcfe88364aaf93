import html as references
import re
import time

import pytest

from ledgerlens.llm.extraction import extract, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a = "</p><p>no</p>";</script></head><body class="home">
<header><h2>Site name, and a slogan.</h2></header><nav><ul><li><a href="/">Home</a></li><li><a href="/x">More, of it.</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies, a lot of them, in every way we can think of. Do you agree, or not?</p></div>%s
<aside><p>Read this as well, it is long enough to look like text. Yes, really.</p></aside>
<div id="comments"><article class="comment"><p>First! I liked it, though not all of it, and I have a lot to say about it. It was long, too.</p></article></div>
<form><label>Your name, please.</label><input><textarea>Say something.</textarea></form><footer>&copy; 2024, all rights reserved. Call us.</footer></body></html>"""
BODY = "<h1>A title &amp; more</h1><p>It began, as <b>these</b>\n things do, with a <i>w</i>ord.<br>It went on; and on.</p><p>Short.</p><ul><li>one<li>two</ul><p>The end came late, after a long time, and nobody was there to see it. Nobody at all."
TEXT = "A title & more It began, as these things do, with a word. It went on; and on. Short. one two The end came late, after a long time, and nobody was there to see it. Nobody at all."


@pytest.mark.parametrize("around", ["<article>{}</article>", "<main>{}</main>", "<div id=content>{}</div>", "<section><div><div class='text'>{}</div></div></section>", "<div role='main'>{}</div>"])
def test_article(around):
    assert main_text(PAGE % around.format(BODY)) == TEXT


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("   ", ""),
        ("just text &lt;3 &#x41;&eacute;&nbsp;!", "just text <3 Aé !"),
        ("<p>a<p>b<script>x</p>", "a b"),
        ("<p>x</p><!-- <p>no</p>", "x"),
        ("<nav><a href=x>only a menu</a></nav>", ""),
        ("<article><p>one<b>two</p><p>three</b>four</p></article>", "onetwo threefour"),
        ("<article><p title='a > b'>in</p><p title=it's>side</p></article><div class=ad>out, it is.</div>", "in side"),
        ("<ARTICLE><P>Loud.</P><FORM>no</FORM></ARTICLE>", "Loud."),
        ("</div></p>stray", "stray"),
        ("<article><div hidden>no</div><p style='display: none'>no</p>yes</article>", "yes"),
        ("<", "<"),
        ("<article>a < b &amp;&am c</article>", "a < b &&am c"),
    ],
)
def test_pieces(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("part", ["<div ", "<p>a ", "<div>a ", '<a "', "<!--", "<b>a ", "<li>a<ul>", "</b", "<!a", '<p title="', "<a href=", "&amp", "<table><tr><td>", "<article>", "<script>"])
def test_time_grows_with_length(part):
    start = time.process_time()
    main_text(part * 30_000)
    assert time.process_time() - start < 20


def test_sample_pages(spark):
    """The sample pages hold one article element, without anything in it that is not the article."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in extract(pages).collect():
        inside = r["html"][r["html"].index("<article>") + 9 : r["html"].rindex("</article>")]
        want = " ".join(references.unescape(re.sub("<[^>]*>", " ", inside)).split())
        assert (r["text"], r["n_chars"]) == (want, len(want))


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, HTML string, n_chars string"
    rows = [(1, None, None, "t", "h", "n"), (None, "u", "", None, None, None), (2, "u", "<p>x</p>" * 50_000, "t", "h", "n"), (2, "u", "<p>🙂 y", "t", "h", "n"), (2, "u", "<p>🙂 y", "t", "h", "n")]
    df = spark.createDataFrame(rows, schema)
    found = extract(df)
    assert found.columns == ["page_id", "url", "html", "HTML", "text", "n_chars"]
    assert sorted((r[0] or 0, len(r[4]), r[5]) for r in found.collect()) == [(0, 0, 0), (1, 0, 0), (2, 3, 3), (2, 3, 3), (2, 99_999, 99_999)]
    assert extract(spark.createDataFrame([], schema), ("page_id",)).columns == ["page_id", "text", "n_chars"]
    assert extract(spark.createDataFrame([], schema)).count() == 0


def prose(word, n):
    return " ".join(f"<p>The {word} went on, for a long while, and {word} number {i} was seen again, at last. Nobody knew of the {word}, or why.</p>" for i in range(n))


def words_in(page):
    return " ".join(references.unescape(re.sub("<[^>]*>", " ", page)).split())


@pytest.mark.parametrize(
    "article",
    [
        f"<section><h2>One</h2>{prose('fox', 13)}</section><section><h2>Two</h2>{prose('hen', 7)}</section>",
        f"<div class=x>{prose('fox', 13)}</div>{prose('hen', 7)}",
        f"<table><tr><td>{prose('fox', 13)}</td></tr></table>{prose('hen', 7)}",
        f"<article>{prose('fox', 11)}</article><article>{prose('hen', 9)}</article>",
        f"<article>{prose('fox', 20)}<div><ul><li>one</li><li>two</li></ul></div></article>",
        f"<article>{prose('fox', 12)}</article><div class=x><p>Short.</p>{prose('hen', 8)}</div>",
        f"<div class=x>{prose('fox', 13)}<ul><li>An item with <a href=x>some words</a> in it, and more.<li>Another, <a href=y>of them</a></ul></div>",
    ],
)
def test_all_parts_of_an_article(article):
    menu = "<ul><li><a href=/>Home</a><li><a href=/x>More</a></ul>"
    assert main_text(f"<body>{menu}<div class=top>Site</div>{article}<div class=end>End</div></body>") == words_in(article)


@pytest.mark.parametrize(
    "around",
    [
        "<div class='content-sidebar-wrap'>{}</div>",
        "<div class='main no-sidebar'><div class='layout-with-menu'>{}</div></div>",
        "<div class='post has-ads'><article>{}</article><div class=ads><p>Buy it, now.</p></div></div>",
        "<main class='no-sidebar'>{}</main>",
        "<article class='post has-ads'>{}</article>",
        "<div id='search-results-article'>{}</div>",
        "<form action=/><div>{}</div><label>Your name</label></form>",
        "<form action=/><div class=sidebar><p>Read on, it is short.</p></div><main>{}</main></form>",
        "<div class='has-ads'>{}</div><div class='related'><p>The next, and others.</p></div>",
    ],
)
def test_names_and_forms_do_not_drop_the_article(around):
    article = prose("fox", 9)
    got = main_text(f"<body><ul class=menu><li><a href=/>Home</a></ul>{around.format(article)}<div class=footer>End</div></body>")
    assert got.removesuffix(" Your name") == words_in(article)


def test_long_comments_beside_an_article():
    comments = "".join(f"<article class=comment>{prose('hen', 2)}</article>" for _ in range(6))
    page = f"<body><article>{prose('fox', 5)}</article><div id=comments>{comments}</div></body>"
    assert main_text(page) == words_in(prose("fox", 5))
