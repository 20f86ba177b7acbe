import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import html

PROSE = "This is a long paragraph, with commas, that goes on for a while, so that it is plainly prose and scores some points."


def page(main, before="", after=""):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{before}{main}{after}</body></html>"


@pytest.mark.parametrize(
    "source, want",
    [
        (page(f"<article><h1>T &amp; U</h1><p>{PROSE}<p>Two &lt;x&gt;.</article>", "<nav><a href=/>Home</a></nav>", "<footer>f</footer>"), f"T & U\n{PROSE}\nTwo <x>."),
        (page(f"<div class=content><p>{PROSE}</p><div class='comment-list'><p>{PROSE} no</p></div><p>{PROSE}</p></div>", f"<div id=sidebar><p>{PROSE}</p></div>"), f"{PROSE}\n{PROSE}"),
        (page(f"<div><div><p>{PROSE}</p><p>{PROSE}</p></div></div>", "<div><ul>" + "<li><a href=x>link text that is long enough, surely</a></li>" * 9 + "</ul></div>"), f"{PROSE}\n{PROSE}"),
        (page(f"<article><p>a<br>b <b>c</b>\n  d&nbsp;&eacute;<script>var x='</p>'</script></p><form>f</form><p>{PROSE}</article>"), f"a\nb c d é\n{PROSE}"),
        (page("<article></article>"), ""),
        ("<p>only", "only"),
        ("plain &amp; simple", "plain & simple"),
        ("<article><p><b>x<br><p>y</article>", "x\ny"),
        ("", ""),
        (None, ""),
    ],
)
def test_extract(source, want):
    assert html.extract(source) == want


@pytest.mark.parametrize(
    "beside, want",
    [
        ("<p>Short.</p>", "Short."),
        ("<h5>Small heading</h5>", "Small heading"),
        ("<dl><dt>Term<dd>Meaning</dl>", "Term\nMeaning"),
        ("<figure><img src=x><figcaption>A caption</figcaption></figure>", "A caption"),
        ("bare <b>text</b>, with <a href=x>a link</a> in a long enough line", "bare text, with a link in a long enough line"),
        (f"<section class=extra><p>{PROSE}</p></section>", PROSE),
        ("<div class=extra>Few words.</div>", "Few words."),
        ("<p><a href=x>only a link</a></p>", None),
        ("<a href=x>only a link</a>", None),
        ("<div class=cookie-notice><p>Short.</p></div>", None),
    ],
)
def test_link_poor_siblings_of_any_length_are_kept(beside, want):
    main = "<div class=content>" + f"<p>{PROSE}</p>" * 30 + "</div>"
    prose = "\n".join([PROSE] * 30)
    assert html.extract(page(main, beside)) == (f"{want}\n{prose}" if want else prose)
    assert html.extract(page(main, "", beside)) == (f"{prose}\n{want}" if want else prose)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "<nav>", "</nav>", "<script>", "</script>", "<!--", "-->", "<", ">", "&amp;", "<li>", "<td>", "<table>", "</table>", "text, ", "<article>", "</article>", "<br/>", "<a href='", "'>", "<![CDATA[", "]]>", "</"]), max_size=30))
def test_any_soup_is_parsed(parts):
    out = html.extract("".join(parts))
    assert out == "\n".join(" ".join(line.split()) for line in out.split("\n")) and "\n\n" not in out


@pytest.mark.parametrize(
    "name", ["content with-sidebar", "hfeed has-header", "page-content menu-open", "header-image article", "post tags-open", "entry no-comments", "navPage", "header-wrap", "widgets", "page has-modal ad-free", "sidebar"]
)
def test_layout_words_do_not_delete_the_article(name):
    body = f"<p>{PROSE}</p><p>{PROSE} Two.</p>"
    for tag in ("div", "section", "article", "main"):
        assert html.extract(page(f"<{tag} class='{name}'>{body}</{tag}>", "<nav>Menu</nav>")) == f"{PROSE}\n{PROSE} Two."


@pytest.mark.parametrize("name", ["comments", "comment-list", "disqus_thread", "ad", "adsbygoogle ad-slot", "cookie-notice", "newsletterSignup", "sr-only", "site-footer", "main-nav", "sidebar widget", "breadcrumbs", "related-posts"])
def test_unwanted_names_go(name):
    junk = f"<div class='{name}'><p>{PROSE} junk</p></div>"
    main = "<div class=content>" + f"<p>{PROSE}</p>" * 8 + "</div>"
    want = "\n".join([PROSE] * 8)
    assert html.extract(page(main, junk)) == html.extract(page(main, "", junk)) == want
    assert html.extract(page(main.replace("</div>", junk + "</div>"))) == want


def test_nested_layout_counts_once():
    main = "<div class=content>" + f"<p>{PROSE}</p>" * 5 + "</div>"
    side = "<div class=sidebar><div><div class=sidebar-inner><div><div class=side>" + f"<p>{PROSE} aside</p>" * 4 + "</div></div></div></div></div>"
    assert html.extract(page(main, side)) == "\n".join([PROSE] * 5)


def test_comments_longer_than_the_article_go():
    main = f"<article class='post'><p>{PROSE}</p><p>{PROSE}</p></article>"
    comments = "<div id=comments>" + f"<article class=comment-body><p>{PROSE} says a reader</p></article>" * 40 + "</div>"
    assert html.extract(page(main, "", comments)) == f"{PROSE}\n{PROSE}"


def test_labelled_pages():
    """Pages put together from labelled blocks, in many layouts, none of them with an article element."""
    rng = random.Random(11)
    words = "lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor".split()
    make = lambda lo, hi: " ".join(rng.choice(words) for _ in range(rng.randint(lo, hi)))
    junk = [
        lambda: "<nav><ul>" + "".join(f"<li><a href=/x>{make(1, 3)}</a>" for _ in range(rng.randint(3, 12))) + "</ul></nav>",
        lambda: f"<div class='{rng.choice(['ad', 'ad-box', 'banner top', 'cookie-bar', 'promo'])}'><p>{make(10, 40)}</p></div>",
        lambda: f"<div id='{rng.choice(['sidebar', 'left-sidebar', 'footer', 'site-footer', 'comments'])}'><p>{make(10, 40)}</p></div>",
        lambda: f"<footer>{make(5, 20)}</footer>",
        lambda: f"<form><label>{make(1, 4)}</label><input></form>",
        lambda: "<script>var x = '<p>no</p>';</script><style>p{}</style><!-- <p>no</p> -->",
        lambda: "<ul class=links>" + "".join(f"<li><a href=/x>{make(3, 9)}</a>" for _ in range(rng.randint(3, 9))) + "</ul>",
    ]
    for _ in range(150):
        blocks = [make(30, 120) for _ in range(rng.randint(3, 9))]
        parts = []
        for b in blocks:
            kind = rng.choice(["p", "p", "p", "open", "b", "quote", "div"])
            parts.append({"p": f"<p>{b}</p>", "open": f"<p>{b}", "b": f"<p><b>{b[:9]}</b>{b[9:]}</p>", "quote": f"<blockquote>{b}</blockquote>", "div": f"<div><p>{b}</p></div>"}[kind])
            if rng.random() < 0.2:
                parts.append(rng.choice(junk[:6])())
        outer = rng.choice(["<div class='content'>{}</div>", "<div><div id=main>{}</div></div>", "<section>{}</section>", "<table><tr><td>{}</td></tr></table>", "<div class='page with-sidebar'><div>{}</div></div>", "{}"])
        source = page(outer.format("".join(parts)), rng.choice(junk)(), rng.choice(junk)() + rng.choice(junk)())
        assert html.extract(source).split("\n") == blocks, source


def test_points_against_a_recursive_definition():
    rng = random.Random(12)

    def build(depth):
        tag = rng.choice(["div", "section", "p", "b", "a", "td", "ul", "li"])
        inner = [rng.choice(["x, y and so on for a while, " * rng.randint(0, 6), "short", ""]) if depth == 0 or rng.random() < 0.4 else build(depth - 1) for _ in range(rng.randint(0, 4))]
        return tag, inner

    def node(x, parent):
        if isinstance(x, str):
            return x
        n = html.Node(x[0], "", parent)
        n.children = [node(c, n) for c in x[1]]
        return n

    def text(x):
        return "".join(c if isinstance(c, str) else text(c) if c.tag in html._INLINE else "" for c in x.children)

    def paragraphs(x, distance):
        """Points that x and what is in it give to the element ``distance`` levels above x, 0 being x itself."""
        total = 0.0
        if x.tag not in html._INLINE:
            n = sum(html._length(c) for c in pieces(x))
            if n >= 25:
                up = distance - (x.tag in html._PARAGRAPH)
                if up >= 0:
                    total += (1 + text(x).count(",") + min(3, n // 100)) / 2**up
        return total + through(x, distance + 1)

    def through(x, distance):
        """An inline element is no level of its own."""
        return sum(paragraphs(c, distance) if c.tag not in html._INLINE else through(c, distance) for c in x.children if not isinstance(c, str))

    def pieces(x):
        return [p for c in x.children for p in ([c] if isinstance(c, str) else pieces(c) if c.tag in html._INLINE else [])]

    for _ in range(200):
        root = node(("div", [build(5) for _ in range(3)]), None)
        for x in html._measure(root):
            if x.tag not in html._INLINE:
                assert x.points == pytest.approx(paragraphs(x, 0)), (x.tag, x.points)


@pytest.mark.parametrize(
    "source",
    [
        "<span>" * 20_000 + "x" * 30 + "</span>" * 20_000,
        "<div>some text that is long enough to count" * 20_000,
        "<span>some text that is long enough to count" * 20_000,
        "<b>" * 20_000 + "</i>" * 20_000,
        "<i><div>" + "<b>" * 20_000 + "</i>" * 20_000,
        "<b>" * 20_000 + "<li>x</li>" * 20_000,
        "<div class='a b'" * 20_000,
        "<p>" + "<a href='x>" * 20_000,
        "<!--" * 20_000 + "<" * 20_000,
        "<script>" * 20_000 + "<ul><li>" * 10_000,
    ],
)
def test_time_is_linear(source):
    began = time.process_time()
    html.extract(source)
    assert time.process_time() - began < 3


def test_deep_nesting_and_query(spark):
    deep = "<div>" * 3000 + f"<p>{PROSE}</p>"
    rows = [(1, "u", deep), (2, None, None), (3, "u", ""), (3, "u", ""), (None, "u", "<p>x</p>")]
    got = html.main_text(spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, text string")).collect()
    assert got[0]["text"] == PROSE and got[0]["n_chars"] == len(PROSE) and [r["text"] for r in got[1:]] == ["", "", "", "x"]
    assert html.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
