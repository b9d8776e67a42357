import html
import re
import time
import tracemalloc

import pytest
from pyspark.sql import functions as F

from dispatchlens.llm import queries
from dispatchlens.llm.html_text import extract_main_text, main_blocks


def test_articles_of_a_table(spark, tables):
    pages = {r.page_id: r for r in spark.read.parquet(f"{tables}/pages.parquet").collect()}
    found = queries.html_extraction(spark, tables).collect()
    assert len(found) == len(pages)
    for r in found:
        article = re.search("<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        parts = re.split("</?(?:p|h1|br)>", article)
        texts = [" ".join(html.unescape(re.sub("</?b>", "", p)).split()) for p in parts]
        assert r.text == "\n".join(t for t in texts if t)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


ARTICLE = "First paragraph, long enough, with commas. And more text.", "Second one, it is. Also long."


@pytest.mark.parametrize(
    "before,after",
    [
        ("<div class='top-menu'><a href=x>Home</a> <a href=y>News</a></div>", "<div id=footer>© us.</div>"),
        ("<nav><ul><li><a>x</a><li><a>y</a></ul></nav>", "<aside><p>Side, side, and more side text.</p></aside>"),
        ("<header><h1>Site name</h1></header>", "<section class=comments><p>I disagree, sir, really.</p></section>"),
        ("<div class='cookie-notice'>We use cookies, fine.</div>", "<form><label>Mail</label><p>Send, now.</form>"),
        ("<script>var a = '<p>x</p>';</script>", "<style>p { margin: 0 }</style><!-- a, comment. -->"),
        ("<div role=banner>Banner, big.</div>", "<div class=adBox><p>Buy, buy. Now.</p></div>"),
    ],
)
@pytest.mark.parametrize("holder", ["<article>%s</article>", "<main>%s</main>", "<div class=story>%s</div>"])
def test_only_the_article_stays(before, after, holder):
    body = f"<p>{ARTICLE[0]}</p>\n<p>{ARTICLE[1]}</p>"
    page = f"<html><head><title>T</title></head><body class=has-sidebar>{before}{holder % body}{after}</body></html>"
    assert main_blocks(page) == list(ARTICLE)


def test_references_white_space_and_broken_markup():
    page = "<main><p>A &lt;b&gt;\n\t &eacute;&#233;&amp;amp; <b>x</b>y, z.<p>Two<br>three, four.</main>"
    assert main_blocks(page) == ["A <b> éé&amp; xy, z.", "Two", "three, four."]
    assert main_blocks("no markup, at all. <") == ["no markup, at all. <"]
    assert main_blocks("<p>a, b <b>c<p>d") == ["a, b c", "d"]


def test_names_of_layout_and_links_inside_articles():
    body = "<p>One, two, three words here.</p><ul><li><a href=x>a link</a></li></ul><p>Four, five. Six.</p>"
    for page in (
        f"<div class='layout-sidebar'><main>{body}</main></div>",
        f"<body class='no-comments'><article class='commentary'>{body}</article>",
        f"<article><div class='post-header'><h1></h1><p>By me, today.</p></div>{body}</article>",
    ):
        assert main_blocks(page) == ["One, two, three words here.", "a link", "Four, five. Six."]


BODY = f"<p>{ARTICLE[0]}</p>\n<p>{ARTICLE[1]}</p>"
THREAD = "<div class='comments-area'>" + "<p>I disagree, sir, really. And here is why, at length.</p>" * 40 + "</div>"


@pytest.mark.parametrize(
    "page",
    [
        "<article id='post-7' class='post-7 post type-post status-publish tag-politics hentry'>%s</article>",
        "<article class='post format-aside category-legal tag-social tag-ads'>%s</article>",
        "<article class='post social'>%s</article>",
        "<article class='post tag-news comments-open'>%s</article>",
        "<div class='post-7 post type-post hentry category-legal tag-search tag-news'>%s</div>",
        "<div class='layout-sidebar'><article class='post tag-meta'>%s</article></div>",
        "<div class='layout-sidebar'><div class=story>%s</div><div class=sidebar><p>Side, text.</div></div>",
        "<div class='right-sidebar'><article>%s</article></div><div>Our site, our rules.</div>",
        "<div class='paywall'>%s</div>",
    ],
)
def test_names_do_not_lose_the_article(page):
    foot = "<div class=bottom>© us.</div>" if "%s</article>" in page else ""
    for rest in ("", THREAD, "<div class='social-links'><p>Follow, us.</p></div>"):
        assert main_blocks(f"<body><nav><a>x</a></nav>{page % BODY}{rest}{foot}</body>") == list(ARTICLE)


@pytest.mark.parametrize(
    "part",
    [
        "<div class='entry-meta'>By me, today.</div>", "<ul class='tag-list'><li>Politics, law</ul>",
        "<div class=related-posts><p>Other, posts.</p></div>", "<p class=tags>Law, order.</p>",
        "<article class='comment-body'><p>I, too.</p></article>", THREAD,
    ],
)
def test_names_of_parts_still_count(part):
    for holder in ("<article class='post tag-law'>%s</article>", "<div class=story>%s</div>"):
        assert main_blocks(holder % (BODY + part)) == list(ARTICLE)


def test_odd_rows(spark):
    long = "<article>" + "<p>Some words, here.</p>" * 20_000 + "</article>"
    rows = [(1, None), (2, ""), (2, ""), (None, "<p>Text, here."), (3, long), (4, "<div " * 3000)]
    frame = spark.createDataFrame(rows, "page_id long, html string").withColumn("MAIN_TEXT", F.lit(1))
    found = extract_main_text(frame).collect()
    texts = {(r.page_id, r.main_text.count("\n")): r for r in found}
    assert len(found) == 6 and texts[3, 19_999].n_blocks == 20_000
    assert [r.main_text for r in found if r.html in (None, "")] == [""] * 3
    assert extract_main_text(frame.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["div", "menu", "b", "li", "p", "a"])
def test_deep_and_long_pages_take_time_and_memory_in_proportion(name):
    words = "Text of an article, with commas. " * 30
    page = {
        "div": "<div>" * 100_000 + words, "menu": "<div class=menu>" * 100_000 + words, "b": "<b>x " * 100_000,
        "li": "<div>" * 30_000 + "<li>one, two." * 30_000, "p": "<p>one, two." * 60_000, "a": "<a href=x>y" * 60_000,
    }[name]
    tracemalloc.start()
    start = time.time()
    found = main_blocks(page)
    spent, (_, most) = time.time() - start, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert spent < 40 and most < 200 * len(page), (spent, most)
    if name in ("div", "menu"):
        assert found == [words.strip()]
