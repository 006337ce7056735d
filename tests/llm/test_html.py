"""Extraction of main text from pages of several shapes."""

import html
import re
import time

from stockledger.llm import queries
from stockledger.llm.html import extract_main_text, main_text

SMALL = "/root/testdata/sf0.01"
PARAGRAPHS = ["A first paragraph with enough words to look like prose, one after the other.", "Short.", "Another one &amp; more of the same kind of text, all of it to be kept."]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
WANT = "\n\n".join(html.unescape(p) for p in PARAGRAPHS)


def test_given_pages(spark):
    rows = {r.page_id: r for r in queries.op7_html_extraction(spark, SMALL).collect()}
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = [html.unescape(" ".join(re.sub(r"<[^>]*>", " ", b).split())) for b in re.split(r"</?(?:p|h1)>", article)]
        assert rows[p.page_id].text == "\n\n".join(" ".join(b.split()) for b in blocks if b.strip())
        assert rows[p.page_id].n_chars == len(rows[p.page_id].text) and rows[p.page_id].url == p.url


def test_boilerplate_goes():
    page = f"""<html><head><title>T</title><style>p{{}}</style><script>var x='<p>no</p>';</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
    <div class="cookie-notice"><p>We use cookies and a long sentence to tell you so, as the law would have it.</p></div>
    <main>{BODY}<div class="ad">Buy this, a long advert text that goes on and on for a while.</div>
    <section id="comments"><p>First! A comment that is as long as a paragraph of the article itself.</p></section></main>
    <aside><p>Sidebar text that is rather long as well, with many words in a row.</p></aside>
    <form><input name=q><button>Go</button></form><footer>&copy; 2024</footer></body></html>"""
    assert main_text(page) == WANT


def test_divisions_without_article():
    page = f"<body><div class=menu><a href=1>a</a> <a href=2>b</a></div><div class=post>{BODY}</div><div><a href=1>x</a><a href=2>y</a></div></body>"
    assert main_text(page) == WANT


def test_wrappers_do_not_leave_out_the_content():
    extra = '<div class="ad">Buy this, a long advert text that goes on and on.</div>'
    related = '<div class="related"><article><p>A teaser of another article, with some words in it.</p></article></div>'
    comments = '<section id="comments"><article><p>First! A comment that is as long as a paragraph of the text, or even longer than that, who knows.</p></article></section>'
    for opened, closed in (('<div class="has-sidebar">', "</div>"), ('<div class="content-with-sidebar">', "</div>"), ('<div id="main-nav-wrapper">', "</div>"), ("<form>", "</form>"), ('<form><div class="has-comments has-sidebar">', "</div></form>")):
        for tag in ("article", "main", "div"):
            held = f"<{tag}>{BODY}{extra}</{tag}>"
            assert main_text(f"<body><p>Skip</p>{opened}{held}{related if tag != 'div' else ''}{closed}{comments}<footer>(c)</footer></body>".replace("<p>Skip</p>", "" if tag == "div" else "<p>Skip</p>")) == WANT
    # teasers and comments are not the content of a page whose text lies elsewhere
    assert main_text(f"<body><div class=post>{BODY}</div>{related}{comments}</body>") == WANT


def test_unclosed_tags_white_space_and_references():
    page = "<article><h1>Title</h1><p>One\n two<br>three<p>caf&eacute; <b>bo<i>ld</i></b>er <ul><li>x <li>y</ul>"
    assert main_text(page) == "Title\n\nOne two three\n\ncafé bolder\n\nx\n\ny"


def test_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>"), (None, "u", "plain text"), (4, "u", "<article>" + "<p>word</p>" * 20000), (5, "u", "<script>never closed"), (5, "u", "<![bad <!x> <<p>a < b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = {(r.page_id, r.n_chars) for r in extract_main_text(pages).collect()}
    assert {(1, 0), (2, 0), (3, 0), (None, 10), (4, 4 * 20000 + 2 * 19999)} <= got
    assert extract_main_text(pages.limit(0)).collect() == []


def test_names_that_only_resemble_boilerplate():
    assert main_text(f'<body><nav>x</nav><article class="commentary">{BODY}</article></body>') == WANT
    for opened, closed in (
        ('<section class="related-work">', "</section>"),
        ('<div class="social-policy">', "</div>"),
        ('<div class="login-news" id="search-results-explained">', "</div>"),
        ("<fieldset>", "</fieldset>"),
    ):
        assert main_text(f"<body><article><p>{PARAGRAPHS[0]}</p>{opened}{BODY}{closed}</article></body>") == f"{PARAGRAPHS[0]}\n\n{WANT}"
    for name in ("related-posts", "social", "share-buttons", "comment-list", "ad-box-2", "cookie-notice", "commentlist comments"):
        assert main_text(f'<body><article>{BODY}<div class="{name}"><p>Something else that is as long as a paragraph of the text.</p></div></article></body>') == WANT


def test_hostile_nesting_takes_time_in_proportion():
    def seconds(page):
        start = time.process_time()
        main_text(page)
        return time.process_time() - start

    for made in (lambda n: "<b>" * n + "</i>" * n, lambda n: "<i>" * n + "x<br>" * n, lambda n: "<div>" * n + "</p></span>" * n):
        small, large = min(seconds(made(4000)) for _ in range(3)), min(seconds(made(16000)) for _ in range(3))
        assert large < 10 * small + 0.05
