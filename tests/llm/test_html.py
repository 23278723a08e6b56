import random

import pytest

from weirflow.llm import html

BODY = "<p>First paragraph, with some words, and a few commas, so that it scores.</p><p>Second &amp; last &eacute;\n  paragraph<br>goes\ton.</p>"
TEXT = "First paragraph, with some words, and a few commas, so that it scores.\n\nSecond & last é paragraph goes on."


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=/>Home</a></ul></nav><article>{BODY}</article><footer>&copy; x</footer></body></html>",
    f"<body><header><h1>Site name</h1><p>Slogan of the site.</p></header><div class='content'>{BODY}</div><aside><p>Side note that is, of course, long enough to score, too.</p></aside>",
    f"<div id=main>{BODY}</div><div id='comments'><p>I think, as a reader, that this is a comment, long, longer, longest, and so on and on and on.</p></div>",
    f"<main>{BODY}<form><input name=q><button>Go</button></form><div class='cookie-notice'>We use cookies, many.</div></main>",
    f"<article>{BODY}<!-- hidden, words --><div style='display:none'>No</div><div class=\"ad\">Buy, now.</div><ul class='share-links'><li>x</ul></article>",
    f"<div><p><a href=1>Menu entry one</a> <a href=2>Menu entry two, longer, longer</a></p></div><div>{BODY}</div>",
    f"<article>{BODY}</article><footer>cut &copy; <a href='/fo",
    f"<ARTICLE>{BODY.upper().replace('&AMP;', '&amp;').replace('&EACUTE;', '&eacute;')}</ARTICLE>".replace(BODY.upper(), BODY),
])
def test_main_text(page):
    assert html.extract(page).lower() == TEXT.lower()


LONG = "<p>I think, as a reader, that this is a comment, long, longer, longest, and so on and on and on.</p>"


@pytest.mark.parametrize("page", [
    f"<body><div class='has-sidebar'>{BODY}</div></body>",
    f"<div class='container no-sidebar'><article>{BODY}</article></div><footer>&copy; x</footer>",
    f"<div class='site-content nav-open'><main>{BODY}</main><div class='sidebar'>{LONG}</div></div>",
    f"<section class='page login-required'>{BODY}<div id='comments'>{LONG * 9}</div></section>",
    f"<div class='layout-sidebar-left'><article>{BODY}</article></div><p>Imprint, of the site</p>",
    f"<div id='page-banner'>{BODY}</div><div class='cookie-bar'>Cookies.</div>",
    f"<article><h1></h1><div class='article-body js-social-share'>{BODY}</div><div class='share'>Share this, now</div></article>",
    f"<main>{BODY}<div class='comments-area'><article class='comment'>{LONG * 9}</article></div></main>",
    f"<div class='sidebar'>{BODY}</div>",
    f"<main><div class='no-sidebar'>{BODY.split('</p>')[0]}</p></div><div class='no-sidebar'>{BODY.split('</p>')[1]}</p></div></main>",
])
def test_class_of_what_holds_the_text(page):
    assert html.extract(page) == TEXT


def test_article_parts_stay():
    page = "<article><h1>Title</h1><p>Short.</p><section><h2>Part</h2><p>Long text, with commas, and more words than before, to be sure.</p><ul><li>one<li>two</ul></section><blockquote>Quoted</blockquote><p>z</p></article>"
    assert html.extract(page).split("\n\n") == ["Title", "Short.", "Part", "Long text, with commas, and more words than before, to be sure.", "one", "two", "Quoted", "z"]


def test_unclosed_and_broken():
    assert html.extract("<article><p><b>One, two.<br><p>Three</b> four</article>") == "One, two.\n\nThree four"
    assert html.extract("<p>1 < 2 & 3 > 2, a<b</p><p>x &lt;b&gt; &#233;&nbsp;y</p>").startswith("1 < 2 & 3 > 2, a")
    assert html.extract("<div>plain text only") == "plain text only" and html.extract("just text") == "just text"
    assert html.extract("<p>a</p><!-- never ends <p>b</p>") == "a" and html.extract("<script>x") == ""
    assert html.extract(None) == "" and html.extract("") == "" and html.extract("<nav>only a menu</nav>") == ""


def test_scores():
    root = html.parse(f"<div id=a>{BODY}</div><div id=b><p><a href=x>link, link, link, link, link, link, link, link, link</a></p></div>")
    assert [b.text() for b in html.blocks(root)][:2] == TEXT.split("\n\n")
    deep = "<div>" * 3000 + "deep, text" + "</div>" * 3000
    assert html.extract(deep) == "deep, text"


@pytest.mark.parametrize("wrapper", ["page has-sidebar", "post share-enabled", "entry social", "layout widget-area-on", "article-body related", "legal"])
def test_a_class_word_on_a_wrapper_cuts_nothing(wrapper):
    text = "".join(f"<p>Paragraph {k}, of some length, with commas, that is plainly a part of the article on this page.</p>" for k in range(3))
    got = html.extract(f"<body><div class='{wrapper}'>{text}</div><div class=teaser>Short teaser.</div></body>")
    assert all(f"Paragraph {k}" in got for k in range(3))


def test_scores_decide_over_articles():
    teaser = "<article><h2>Other story</h2><p>Read it.</p></article>"
    assert html.extract(f"<body><div class=story>{BODY}{BODY}</div><div>{teaser}</div></body>") == f"{TEXT}\n\n{TEXT}"
    assert html.extract(f"<main>{BODY}<section class='responses'>{LONG * 4}</section></main>") == TEXT


def test_siblings_that_read_like_prose():
    page = f"<body><p>x</p><h2>Part two</h2><p>One more, short.</p><div>{BODY * 12}</div><div>{BODY * 4}</div><ul><li>A closing list, with some words in it.</li><li>And a second line.</li></ul><p>y</p></body>"
    assert html.extract(page).split("\n\n") == ["Part two", "One more, short.", *(TEXT.split("\n\n") * 16), "A closing list, with some words in it.", "And a second line."]


def random_tree(rng, depth):
    parts = []
    for _ in range(rng.randint(1, 4)):
        kind = rng.random()
        if depth and kind < 0.5:
            parts.append(f"<{(name := rng.choice(['div', 'section', 'article', 'ul']))}>{random_tree(rng, depth - 1)}</{name}>")
        elif kind < 0.7:
            parts.append(f"<p><a href=x>{'link, ' * rng.randint(1, 9)}</a> word</p>")
        else:
            parts.append(f"<p>{'word, ' * rng.randint(1, 40)}end.</p>")
    return "".join(parts)


@pytest.mark.parametrize("seed", range(30))
def test_scores_by_brute_force(seed):
    """The element that is kept is the best by sums taken anew over every element's own blocks."""
    rng = random.Random(seed)
    root = html.parse(random_tree(rng, 4))
    found, best = html.blocks(root), {}
    for node in html.preorder(root):
        score, size, linked = 0.0, 0, 0
        for b in found:
            up, level = b.node, 0
            while up is not None and up is not node:
                up, level = up.parent, level + 1
            if up is node:
                size, linked = size + len(b.text()), linked + min(b.linked, len(b.text()))
                level = max(level - (b.node.name in html.PARAGRAPHS), 0) if b.node is not node or b.node.name not in html.PARAGRAPHS else None
                if level is not None:
                    score += html._points(b.text(), b.linked) * (1 if node.name in html.ARTICLES else 0.5**level)
        best[id(node)] = score * (1 - linked / size) if size else 0.0
    assert html.weigh(root, found)[-1] == pytest.approx(best)


def test_deep_pages_take_linear_time():
    import time

    for page in ("<div>deep, text, " * 16_000, "<b>x" * 20_000 + "</i>" * 20_000, "<div class=x-sidebar>text, " * 5_000, "<p><b>" * 10_000 + "<div>" * 10_000):
        start = time.time()
        html.extract(page)
        assert time.time() - start < 4


def test_operator(spark):
    rows = [(1, "u", f"<article>{BODY}</article>", "x"), (2, None, None, "x"), (None, "v", "", "x"), (3, "w", "<p>" + "word, " * 50_000 + "</p>", "x"), (1, "u", f"<article>{BODY}</article>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html.main_text(df).collect()
    assert sorted((r["page_id"] or 0, r["url"] or "", r["n_chars"]) for r in got) == [(0, "v", 0), (1, "u", len(TEXT)), (1, "u", len(TEXT)), (2, "", 0), (3, "w", 299_999)]
    assert html.main_text(df.where("false")).collect() == []
