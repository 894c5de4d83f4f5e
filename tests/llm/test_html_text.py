import itertools
import random

import pytest

from tripgauge.llm import html_text as h


def test_minimum_cut_against_all_labellings():
    rnd = random.Random(4)
    for _ in range(150):
        n = rnd.randint(1, 8)
        scores = [rnd.choice([-4, -1.5, -0.5, 0.25, 1, 3]) for _ in range(n)]
        edges = [(i, j, rnd.choice([0.3, 0.5, 1.0, 2.0])) for i in range(n) for j in range(i + 1, n) if rnd.random() < 0.5]

        def cost(labels):
            cut = sum(abs(s) for s, keep in zip(scores, labels) if s and (s > 0) != keep)
            return cut + sum(w for i, j, w in edges if labels[i] != labels[j])

        got = h.minimum_cut(scores, edges)
        assert abs(cost(got) - min(map(cost, itertools.product([False, True], repeat=n)))) < 1e-9


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>if (a<b) "</p>";</script></head><body>
<header class="site-header"><a href=/>Home</a> A header that every page of the site has.</header>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
%s
<aside><p>Some sidebar text that is rather long, has commas, and ends with a full stop.</p></aside>
<div class="cookie-notice">This site uses cookies, so that you can be served better. Agree now.</div>
<footer>&copy; 2024 &middot; All rights reserved.</footer></body></html>"""

ARTICLE = """<{0}><h1>Title &amp; more</h1><p>First  paragraph,
with a <b>bold</b> word &lt;here&gt; and enough of a sentence to stand on its own.<p>Short.</p><div class="ad">Buy now, it is cheap.</div>
<p>Second paragraph&hellip; with an <a href="x">inner link</a>, commas, and some more words to be sure.</p>
<ul><li>First item</li><li>Second item</li></ul>
<div id="comments"><p>I liked this article very much, thank you so much for writing it.</p></div>
<form>Your mail: <input name=m> <button>Send</button></form></{1}>"""

WANT = "\n\n".join(["Title & more", "First paragraph, with a bold word <here> and enough of a sentence to stand on its own.", "Short.",
                    "Second paragraph… with an inner link, commas, and some more words to be sure.", "First item", "Second item"])


@pytest.mark.parametrize("tag", ["article", "main", 'div id="content"', 'div class="post-body"', 'section role="main"'])
def test_article_without_the_rest(tag):
    assert h.main_text(PAGE % ARTICLE.format(tag, tag.split()[0])) == WANT


def test_long_paragraphs_without_any_name():
    text = "A sentence that is one of several in a paragraph of a page without names. " * 5
    page = PAGE % f"<div><h1>Title</h1><p>{text}</p><p>Short one.</p><p>{text}</p></div>"
    assert h.main_text(page) == "\n\n".join(["Title", text.strip(), "Short one.", text.strip()])


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("   ", ""), ("<p>", ""), ("<!-- never closed <p>x", ""), ("<article><p>a<script>x", "a"),
    ("<article><p class=\"x>one <p>two", "one\n\ntwo"), ("<article>a < b &amp &unknown; &#233;</article>", "a < b & &unknown; é"),
    ("<article><p>a&nbsp;&nbsp;b c</p></article>", "a b c"), ("<article><p>one<br>two</article>", "one two"),
])
def test_odd_markup(page, want):
    assert h.main_text(page) == want


def test_long_pages_are_whole():
    paragraphs = [f"Paragraph number {i} of a very long article, which goes on." for i in range(5000)]
    page = PAGE % ("<article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>")
    assert h.main_text(page) == "\n\n".join(paragraphs)


def test_whole_table(spark):
    from tripgauge.llm.html_text import extract, op4_html_text

    rows = op4_html_text(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 50 and all(r.n_chars == len(r.text) > 0 for r in rows)
    odd = spark.createDataFrame([(1, "u", None, "old"), (None, None, "<article>x", "old"), (1, "u", None, "old")],
                                "page_id long, url string, html string, text string")
    assert sorted((r.page_id or 0, r.text) for r in extract(odd).collect()) == [(0, "x"), (1, ""), (1, "")]
    assert extract(odd.limit(0)).count() == 0


BODY = ("<p>First paragraph, with enough of a sentence to stand on its own.</p><p>Second one, with commas, and some more words to be sure.</p>",
        ["First paragraph, with enough of a sentence to stand on its own.", "Second one, with commas, and some more words to be sure."])
SIDE = '<div class="sidebar-left"><p>Some sidebar text that is rather long, has commas, and ends with a full stop.</p></div>'


@pytest.mark.parametrize("names", ["content has-sidebar", "main-content with-sidebar", "content-with-sidebar", "post comments-open", "content sidebar-left",
                                   "post-12 post category-advertising tag-social hentry"])
def test_names_of_what_a_part_has(names):
    assert h.main_text(PAGE % f'<div class="{names}"><h1>Title</h1>{BODY[0]}{SIDE}</div>') == "\n\n".join(["Title", *BODY[1]])
    assert h.main_text(PAGE % f'<article class="{names}"><h1>Title</h1>{BODY[0]}{SIDE}</article>') == "\n\n".join(["Title", *BODY[1]])


@pytest.mark.parametrize("names", ["sidebar", "sidebar content-sidebar", "comment-content", "comment-content widget", "site-header"])
def test_names_of_boilerplate_stay(names):
    assert h.main_text(PAGE % f'<article><h1>Title</h1>{BODY[0]}</article><div class="{names}">{BODY[0]}</div>') == "\n\n".join(["Title", *BODY[1]])


@pytest.mark.parametrize("opened", ["<article>", '<div class="post">', '<main id="main">'])
def test_headers_and_links_inside_an_article(opened):
    closed = f"</{opened[1:].split()[0].strip('>')}>"
    want = "\n\n".join(["A title", *BODY[1]])
    for head in ('<header class="entry-header"><h1>A title</h1></header>', "<header><h1>A title</h1></header>", "<h1><a href=/x>A title</a></h1>",
                 '<header class="post-header"><h2 class="entry-title"><a href="/x">A title</a></h2></header>'):
        assert h.main_text(PAGE % f"{opened}{head}{BODY[0]}{closed}") == want
    links = "".join(f"<li><a href=/{i}>Source number {i}</a></li>" for i in range(6)) + "".join(f"<p><a href=/{i}>See part {i}</a></p>" for i in range(4))
    want = [*BODY[1], *(f"Source number {i}" for i in range(6)), *(f"See part {i}" for i in range(4))]
    assert h.main_text(PAGE % f"{opened}{BODY[0]}<ul>{links}</ul>{closed}") == "\n\n".join(want)


def test_formulas_are_text():
    formula = ('<math><semantics><mrow><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></mrow>'
               '<annotation encoding="application/x-tex">x=\\frac12</annotation></semantics></math>')
    assert h.main_text(f"<article><p>So {formula} holds here.</p></article>") == "So x = 1 2 holds here."


@pytest.mark.parametrize("paragraph,want", [
    ('<p class="a"">He said "hi" to them all, and went on.</p>', 'He said "hi" to them all, and went on.'),
    ("<p title='it's'>And it's whole, this one, too.</p>", "And it's whole, this one, too."),
    ('<p data-x="a > b" class=y>A value may hold the sign.</p>', "A value may hold the sign."),
    ('<p "x>One two three.</p>', "One two three."),
])
def test_stray_quotes_swallow_nothing(paragraph, want):
    assert h.main_text(f"<article>{BODY[0]}{paragraph}{BODY[0]}</article>") == "\n\n".join([*BODY[1], want, *BODY[1]])


@pytest.mark.parametrize("opened", ['section id="search"', 'div id="tags"', 'p id="login"', 'div class="form-of-government"', 'div class="search-results-explained"',
                                    'section id="cookies"', 'div id="social-media"'])
def test_subjects_inside_an_article_are_no_boilerplate(opened):
    page = f"<article><h1>Title</h1>{BODY[0]}<{opened}>Some more of it, as long as a line.</{opened.split()[0]}>{BODY[0]}</article>"
    assert h.main_text(PAGE % page) == "\n\n".join(["Title", *BODY[1], "Some more of it, as long as a line.", *BODY[1]])


@pytest.mark.parametrize("names", ['class="share-buttons"', 'class="related-posts"', 'id="comments"', 'id="comment-list"', 'class="ad-slot"', 'class="social-links"',
                                   'class="newsletter-box"', 'id="sidebar"', 'class="tags"', 'class="comment-list"'])
def test_boilerplate_inside_an_article_goes(names):
    page = f"<article><h1>Title</h1>{BODY[0]}<div {names}><p>Some text that is rather long, has commas, and ends with a full stop.</p></div></article>"
    assert h.main_text(PAGE % page) == "\n\n".join(["Title", *BODY[1]])


def test_short_articles_and_scripts():
    assert h.main_text("<div><h1>Title</h1><p>Yes.</p><p>No</p><p>20 words.</p><p>Why</p></div>") == "Title\n\nYes.\n\nNo\n\n20 words.\n\nWhy"
    assert h.main_text("<nav><a href=/>Home</a></nav><footer>All rights reserved.</footer>") == ""
    assert h.main_text(f'<article>{BODY[0]}<script src="a.js"/>alert(1)</script><style/>p</style></article>') == "\n\n".join(BODY[1])
    assert h.main_text(f"<article>{BODY[0]}<svg/><p>After the drawing, there is one more line.</p></article>").endswith("one more line.")


@pytest.mark.parametrize("page", ["<b>" * 60_000 + "x</i>" * 60_000, "<p><button>" + "<b>" * 30_000 + "<ul>" * 30_000 + "x", "<b>" * 30_000 + "<p>x</p>" * 30_000,
                                  '<p class="' * 30_000, "<article>" + "<i>y" * 60_000])
def test_unclosed_markup_takes_linear_time(page):
    import time

    start = time.perf_counter()
    h.main_text(page)
    assert time.perf_counter() - start < 15
