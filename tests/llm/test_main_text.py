from __future__ import annotations

import html
import re

import pytest
from pyspark.sql import functions as F

from qoeflow.llm import catalog, main_text as m

ONE = frozenset()


def text_of(source, template=ONE):
    return "\n".join(m.blocks(m.parse(source), template))


@pytest.mark.parametrize("source, text", [
    ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\nb"), ("<p><b>a<br><p>b  \n c</p>", "a\nb c"),
    ("<article><h1>T&eacute;</h1><p>x &lt;b&gt; y</p></article><footer>f</footer>", "Té\nx <b> y"),
    ("<nav><ul><li><a href=x>m</a></li></ul></nav><main><p>in</p><aside>out</aside></main>", "in"),
    ("<body><script>var t='</p>';</script><style>p{}</style><div>kept</div><form>no<input></form></body>", "kept"),
    ("<div class='ad'>no</div><div class='text'>yes</div><!-- <p>no</p> -->", "yes"),
    ("<article><p>one</p><div class=\"share\">no</div><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "one\na\nb\nc\nd"),
    ("<article><header><h1>Title</h1></header><p>x</p><footer>no</footer></article><section id='comments'><article><p>reader</p></article></section>",
     "Title\nx"),
    ("<article><p>cut off <b>here", "cut off here"), ("<p title='a>b'>x</p>", "x"), ("a<br>b", "a b"), ("<p>&am &amp &quo &quot;</p>", "&am & &quo \""),
    ("<article><p>x</p></article><div class=cookie-notice>no</div></html>", "x"), ("<title>no</title><p>y</p>", "y"), ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("<noscript>no</noscript><pre>a\n  b</pre>", "a b"), ("<div hidden>no</div>z", "z"), ("<article><section><p>s</p></section></article>", "s"),
])
def test_pages(source, text):
    assert text_of(source) == text


def test_deep_nesting_is_no_problem():
    assert text_of("<div>" * 5000 + "x" + "</div>" * 5000) == "x"


def page_frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("template", F.lit(1))


def test_recurring_subtrees_of_a_host_go_without_any_hint(spark):
    def page(i, host, box):
        return (i, f"https://{host}/{i}", f"<div><span>{box}</span></div><div><p>own text {i}</p></div>")
    rows = [page(i, "a.example", "Win a prize") for i in range(8)] + [page(20 + i, "b.example", f"News {i}") for i in range(8)]
    got = {r["page_id"]: r["text"] for r in m.extract(page_frame(spark, rows)).collect()}
    assert all(got[i] == f"own text {i}" for i in range(8))
    assert all(got[20 + i] == f"News {i}\nown text {20 + i}" for i in range(8))


def test_copies_of_an_article_on_one_host_stay(spark):
    rows = [(i, "http://a.example/x", "<nav>menu</nav><article><h1>Same</h1><p>words</p></article>") for i in range(30)]
    assert {r["text"] for r in m.extract(page_frame(spark, rows)).collect()} == {"Same\nwords"}


def test_edge_rows(spark):
    rows = [(1, None, None), (2, "", ""), (3, "no url", "<p>x"), (3, "no url", "<p>x"), (None, "http://a.example", "<p>y" + " long" * 50_000)]
    got = sorted(((r["page_id"] or 0, r["url"], r["n_chars"], r["text"][:1]) for r in m.extract(page_frame(spark, rows)).collect()), key=str)
    assert got == sorted([(1, None, 0, ""), (2, "", 0, ""), (3, "no url", 1, "x"), (3, "no url", 1, "x"), (0, "http://a.example", 250_001, "y")], key=str)
    assert m.extract(page_frame(spark, rows).limit(0)).count() == 0


def test_query_against_the_article_elements(spark, small):
    """The test pages hold their text in one article of headings and paragraphs: a plain reading of it."""
    want = {}
    for r in small("pages", "0.01").collect():
        inside = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)
        parts = [html.unescape(re.sub(r"<br>|</?b>", " ", x)) for x in re.split(r"</?(?:p|h1)>", inside[1])]
        want[r["page_id"]] = "\n".join(x for x in (re.sub(r"\s+", " ", x).strip() for x in parts) if x)
    got = {r["page_id"]: r["text"] for r in catalog.op5_main_text(spark, "/root/testdata/sf0.01").collect()}
    assert got == want


@pytest.mark.parametrize("body", [
    "<article><div class=body><p>some words</p></div></article>", "<article><section><p>some words</p></section></article>",
    "<body><div><p>some words</p></div></body>", "<main><div><div><h2>some words</h2></div></div></main>",
])
def test_copies_in_any_wrapper_stay(spark, body):
    rows = [(i, "http://a.example/x", body) for i in range(8)]
    # The same body with another line beside it is no copy of the page, but its prose stays all the same.
    rows += [(10 + i, "http://b.example/x", f"<title>t{i}</title><div>own {i}</div>{body}") for i in range(8)]
    got = {r["page_id"]: r["text"] for r in m.extract(page_frame(spark, rows)).collect()}
    assert all("some words" in got[i] for i, *_ in rows)


@pytest.mark.parametrize("source, text", [
    ('<article class="post has-sidebar"><p>x</p></article>', "x"), ('<div class="layout-with-sidebar"><p>x</p></div>', "x"),
    ('<article class="related sidebar"><p>x</p></article>', "x"), ('<article><div class="article-header"><h1>T</h1></div><p>x</p></article>', "T\nx"),
    ("<main><h1>T</h1><p>x</p><article><p>teaser</p></article></main>", "T\nx\nteaser"), ("<main> <article><p>x</p></article></main>", "x"),
    ("<article><p>x</p></article><article class='comment-body' id=comment-4><p>reader</p></article>", "x"),
    ("<div class='site-footer'>no</div><div id='sidebar_2'>no</div><div class='box footer'>no</div><p>y</p>", "y"),
    ("<main><p>x</p><div class=share>no</div></main><article><p>z</p></article>", "x\nz"),
])
def test_role_words_count_as_whole_names_and_main_keeps_its_text(source, text):
    assert text_of(source) == text


@pytest.mark.parametrize("name", ["post-comments", "user-comments", "commentlist", "page-footer", "main-nav", "gdpr-cookie-notice", "comments-area", "mobile_menu"])
def test_role_words_anywhere_in_a_name(name):
    for at in ("class", "id"):
        assert text_of(f"<article><p>x</p></article><div {at}='{name}'><p>box</p></div>") == "x"
        assert text_of(f"<div><p>x</p></div><div {at}='{name}'><div>box</div></div>") == "x"


@pytest.mark.parametrize("source, text", [
    ('<article><h2 class="related-work">Related work</h2><p>x</p></article>', "Related work\nx"),
    ('<article><section class="share-prices"><p>x</p></section></article>', "x"), ('<article><div class="login-guide"><p>x</p></div></article>', "x"),
    ('<article><p>x</p><div class="share-buttons">no</div><div class="related-posts">no</div><div class="comment-list">no</div></article>', "x"),
    ('<h2 class="related-work">T</h2><p>x</p>', "T\nx"), ('<div class="page nav-open"><article><p>x</p></article></div>', "x"),
    ('<div class="wrap no-comments with-footer"><p>x</p></div>', "x"), ('<section id="comments"><article><p>no</p></article></section><p>x</p>', "x"),
])
def test_names_inside_articles_count_as_wholes(source, text):
    assert text_of(source) == text


@pytest.mark.parametrize("part", ["<div>{}</x>", "<b><div>{}</b>", "<p><i>{}</p></b>", "<li><ul>{}</li>", "<a '{}", "<a title=\"it's>{}", "</div>{}", "<td><b>{}</td></b>"])
def test_reading_time_grows_with_the_page(part):
    """Ends without a beginning, crossed ends and odd quotes: twice the page takes about twice the time."""
    import time

    def took(n):
        opened, _, closed = part.partition("{}")
        source = opened * n + "x" + closed * n
        began = time.perf_counter()
        m.blocks(m.parse(source), frozenset())
        return time.perf_counter() - began
    took(200)
    assert took(16_000) < 12 * took(4_000) + 0.5 and took(16_000) < 5


def test_the_number_of_pages_decides_not_the_share(spark):
    """A box on five pages is template on a host of any size."""
    def page(i, box):
        return (i, f"https://a.example/{i}", f"<div><span>{box}</span></div><div><p>own text {i}</p></div>")
    for others in (3, 300):
        rows = [page(i, "Win a prize") for i in range(5)] + [page(100 + i, f"News {i}") for i in range(others)]
        got = {r["page_id"]: r["text"] for r in m.extract(page_frame(spark, rows)).collect()}
        assert all(got[i] == f"own text {i}" for i in range(5)) and all(got[100 + i] == f"News {i}\nown text {100 + i}" for i in range(others))


def test_large_hosts_are_dealt_over_parts(spark, monkeypatch):
    rows = [(i, f"https://{'a' if i % 3 else 'b'}.example/{i}", f"<div><span>menu</span></div><div><p>own {i}</p></div>") for i in range(90)]
    want = sorted(map(str, m.extract(page_frame(spark, rows)).collect()))
    monkeypatch.setattr(m, "PART_PAGES", 7)
    assert sorted(map(str, m.extract(page_frame(spark, rows)).collect())) == want and "menu" not in str(want)
