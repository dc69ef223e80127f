import html
import re

import pytest

from citylens.llm import html_text as H

SF = "/root/testdata/sf0.001"


def brute(page):
    """The generated pages hold their text in one article of h1, p, b and br."""
    a = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", a))
    return " ".join(b for b in blocks if b)


def test_pages_of_the_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in H.extract(pages).collect()}
    assert got == {r["page_id"]: (brute(r["html"]), len(brute(r["html"]))) for r in pages.collect()}


LONG = "A paragraph that is long enough to be the main text of such a page, with many more words than a menu would have."


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("<p>x", "x"), ("just text", "just text"),
    ("<article>a<script>if (a<b) '</article>'</script>b<b>c</b></article>", "abc"),
    ("<article><p class=ad>Buy<p>Keep this<div class=ad>never closed", "Keep this never closed"),
    ("<article><p>one &amp; two&nbsp;&#233;</p><!-- <p>no</p> --><br>three</article><footer>f</footer>", "one & two é three"),
    ("<main><p title='a > b'>x</p><p title=\"open>y</p></main>", "x y"),
    (f"<body><nav><a href=/>Home</a></nav><div class='site-header'>S</div><div><p>{LONG}</p><div id=cookieBanner>We use cookies</div><p>Short.</p></div>"
     f"<div class='post-comments'><p>{LONG}</p></div><form><p>{LONG}</p></form><footer>(c)</footer></body>", f"{LONG} Short."),
    (f"<ul class=x><li><a href=/a>{LONG}</a></li></ul><p>a</p><p></p><div>{LONG}</div>", f"a {LONG}"),
    ("<article><header><h1>T</h1></header><p>b</p><aside>no</aside><section class=comments><article>no</article></section></article>", "T b"),
    ("<article>" + "<p>w</p>" * 3000 + "</article>", " ".join("w" * 3000)),
    ("<article><div hidden>no</div><div style='display: none'>no</div><div role=navigation>no</div>yes</article>", "yes"),
])
def test_cases(page, want):
    assert H.main_text(page) == want


@pytest.mark.parametrize("page,want", [
    # wrappers that hold the article, or the page
    (f"<nav>n</nav><div class='content-sidebar-wrap'><article><h1>T</h1><p>{LONG}</p></article><div class=sidebar>no</div></div>", f"T {LONG}"),
    (f"<div class='page-with-sidebar'><main><p>{LONG}</p></main></div>", LONG),
    (f"<form id=aspnetForm><div class=menu>no</div><h1>Title</h1><p>{LONG}</p><p>end</p></form>", f"Title {LONG} end"),
    (f"<form><article><p>short</p></article></form><div class=ad>{LONG}</div>", "short"),
    (f"<td class='left-sidebar-layout'><p>{LONG}</p></td>", LONG),
    # what is no wrapper stays dropped
    (f"<article>x</article><div class=comments><article>{LONG}</article></div><div class=related><article>no</article></div>", "x"),
    (f"<p>{LONG}</p><div class=sidebar><article>teaser</article></div>", LONG),
    (f"<p>{LONG}</p><div id=comments><article>{LONG}{LONG}</article></div>", LONG),
    # headers of the article and of the site
    (f"<div class='site-header'><h1>Site</h1></div><div class='entry-header'><h1>Title</h1></div><p>{LONG}</p>", f"Title {LONG}"),
    ("<article><div class=header><h1>T</h1></div><p>b</p></article>", "T b"),
    (f"<header class=post-header><h1>T</h1></header><p>{LONG}</p>", f"T {LONG}"),
    # pages without a marked article: adverts inside, short ends, linked lines, short starts
    (f"<p>{LONG}</p><div class=ad><p>1</p><p>2</p><p>3</p></div><p>Short.</p>", f"{LONG} Short."),
    (f"<p>{LONG}</p><ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul><p>End.</p>", f"{LONG} one two three End."),
    (f"<ul><li><a href=/>Home</a></li></ul><h1>T</h1><p>by x</p><p>today</p><p>a</p><p>b</p><p>{LONG}</p>", f"T by x today a b {LONG}"),
])
def test_nothing_else_is_dropped(page, want):
    assert H.main_text(page) == want


A = "<article>{}</article>"


@pytest.mark.parametrize("inner,want", [
    # names made from headings, names with another head noun, elements within a line
    ('<h2 id="how-to-search">How to search</h2><p>a</p>', "How to search a"),
    ('<h2 id="comments">Comments</h2><p>a</p>', "Comments a"),
    ('<h2 id="login">Login</h2><p>a</p>', "Login a"),
    ('<h3 class="menu">Menu of the day</h3><p>a</p>', "Menu of the day a"),
    ('<section id="related-work"><h2>Related work</h2><p>a</p></section><p>b</p>', "Related work a b"),
    ('<section id="comments"><h2>Comments</h2><p>What the text says of comments.</p></section>', "Comments What the text says of comments."),
    ('<section id="search"><p>How a search is made, at some length.</p></section>', "How a search is made, at some length."),
    ('<div id="search"><h2><a href="#search">#</a> Search</h2><p>a</p></div>', "# Search a"),
    ('<p>One <span class="search-hit">word</span> kept</p>', "One word kept"),
    ('<p>One <span class="share">word</span> kept</p>', "One word kept"),
    ('<p>One <em class="ad">word</em>, <code id="nav">nav</code></p>', "One word, nav"),
    ('<p class="share-price">Up 3</p>', "Up 3"),
    ('<p class="alert-fatigue-study">x</p>', "x"),
    ('<div class="search-theory"><p>x</p></div>', "x"),
    ('<div class="social-history"><p>x</p></div>', "x"),
    ('<ul class="menu-of-the-week"><li>soup</li></ul>', "soup"),
    ('<table class="share-table"><tr><td>1</td><td>2</td></tr></table>', "1 2"),
    ('<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math>.</p>', "Let x=2."),
    ('<p>so <math><semantics><mrow><mi>y</mi></mrow><annotation encoding="t">\\y</annotation></semantics></math> on</p>', "so y on"),
    ('<p>Press <button type=button>Save</button> now</p>', "Press Save now"),
    ('<p><button>Save</button> stores it</p><ul><li><button>Undo</button> takes it back</li></ul>', "Save stores it Undo takes it back"),
    ('<p>Term<span aria-hidden="true">*</span> x</p>', "Term* x"),
    # what is still no article
    ('<div class="comments"><p>no</p></div><p>a</p>', "a"),
    ('<div id="comments"><p>no</p></div><p>a</p>', "a"),
    ('<div id="share"><a href=1>one</a> <a href=2>two</a></div><p>a</p>', "a"),
    ('<div class="share-buttons"><button>Post</button></div><button>Copy</button><p>a</p>', "a"),
    ('<div class="related-articles"><p>no</p></div><p>a</p>', "a"),
    ('<div class="ad-slot"><p>no</p></div><div class="sidebar-left"><p>no</p></div><p>a</p>', "a"),
    ('<div class="newsletter-signup"><p>no</p></div><div class="cookieBanner">no</div><p>a</p>', "a"),
    ('<p class="ad">no</p><p>all of it</p>', "all of it"),
    ('<ul class="social-links"><li><a href=1>x</a></ul><p>a</p>', "a"),
    ('<nav id="toc"><a href=1>x</a></nav><aside>no</aside><form>no</form><p>a</p>', "a"),
])
def test_inside_an_article(inner, want):
    assert H.main_text(A.format(inner)) == want
    assert H.main_text(f"<div class=nav><a href=/>Home</a></div><main>{inner}</main><footer>f</footer>") == want


_LINKS = "".join(f"<p><a href={i}>Linked line number {i}</a></p>" for i in range(20))


@pytest.mark.parametrize("page,want", [
    # the dive: a long list of links ends the text, unless it surges again
    (f"<p>{LONG}</p>{_LINKS}<p>Copyright 2020 Acme. All rights reserved.</p>", LONG),
    (f"<p>{LONG}</p>{_LINKS}<p>Some short words.</p>", LONG),
    (f"<p>{LONG}</p>{_LINKS}<p>{LONG}</p><p>End.</p>", f"{LONG} {' '.join(f'Linked line number {i}' for i in range(20))} {LONG} End."),
    (f"<p>{LONG}</p><p>End.</p><p>Copyright 2020 Acme. All rights reserved.</p>", f"{LONG} End."),
    (f"<p>{LONG}</p><p>© 2021 A</p><p>All rights reserved.</p>", LONG),
    (f"<p>{LONG}</p><p>Copyright law of 1976 is what this sentence is about, and more words follow so that nobody takes it for a notice, however "
     f"short of patience one may be with a text like this one is, or however many words there are in it.</p>", None),
    (f"<h2 id=login>Login</h2><p>{LONG}</p><section id=related-work><h2>Related work</h2><p>{LONG}</p></section>", f"Login {LONG} Related work {LONG}"),
    (f"<p>{LONG}</p><div id=comments><p>no</p></div><div id=footer>no</div>", LONG),
])
def test_dives(page, want):
    got = H.main_text(page)
    assert got == want if want else got.endswith("in it.")


def test_span_of_weights():
    assert H.span([0, 5, 90, 3, 0, 0, 4], 80) == (1, 7)
    assert H.span([90, 0, 0, 0, 0, 0, 0, 10, 0], 80) == (0, 1)
    assert H.span([90] + [0] * 9 + [10, 90, 1], 80) == (0, 13)
    assert H.span([], 80) == (0, 0) and H.span([0, 0], 80) == (2, 2)


def test_marked_elements_stay_linear():
    for one, other in (("<div class=ad>", "</div>"), ("<div class=ad>a", "</div>"), ("<p class=ad>x", ""), ("<td class=ad><h1 class=ad>x", "")):
        H.main_text(one * 30_000 + other * 30_000)


def test_broken_markup_stays_linear():
    for page in ("<" * 200_000, "<a title=\"" * 50_000, "<!--" * 50_000, "&" * 200_000, "<div>" * 50_000, "</p>" * 50_000, "<script>" * 20_000):
        H.main_text(page)


def test_rows(spark):
    pages = spark.createDataFrame([(1, None, "<p>x", "t"), (1, None, "<p>x", "t"), (None, "u", None, "t")], "page_id long, url string, html string, text string")
    assert sorted(map(tuple, H.extract(pages).collect()), key=str) == sorted([(1, None, "x", 1), (1, None, "x", 1), (None, "u", "", 0)], key=str)
    assert H.extract(pages.limit(0)).count() == 0
