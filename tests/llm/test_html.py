import html as entities
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tiercast.llm import html
from tiercast.operators.scratch import Scratch

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>"<p>no</p>"</script>
</head><body><header>Site</header><nav><ul><li>menu<li>two</ul></nav><div id="cookie-notice">We use
cookies</div><aside class=sidebar>side</aside><main><article class="post">
<header><h1>The   &eacute;ssay &#x41;&copy</h1></header><p>One <b>bold</b>er
 line<br>next<p>Two &lt;tags&gt; &amp;amp;</p><!-- <p>no</p> --><ul><li>a<li>b</ul><div class="ad">buy</div>
<form>mail <input value="x"><button>go</button></form></article><section class="comments"><article>first!
</article></section></main><footer>&copy; 2020</footer></body></html>"""
TEXT = "The éssay A© One bolder line next Two <tags> &amp; a b"


@pytest.mark.parametrize(
    "page,text",
    [
        (PAGE, TEXT),
        ("", ""),
        ("plain text", "plain text"),
        ("<p>a</p>b<p>c", "a b c"),
        ("<article><p>cut <b>he", "cut he"),
        ("<article><p>cut <a hre", "cut"),
        ("<article><p>a</p><script>var x = '<p>", "a"),
        ("<ARTICLE><P CLASS=X>up</P></ARTICLE>", "up"),
        ("<article>a &nbsp; b&#10;c</article>", "a b c"),
        ("<p>a < b and 5 > 3</p>", "a < b and 5 > 3"),
        ("</div><p>x</p></p>", "x"),
        ("<div role=navigation>m</div><div>body</div>", "body"),
        ("<form><article><p>whole page form</p></article></form>", "whole page form"),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


def site(host, n):
    """Pages whose plain elements alone tell nothing: menu, teaser and imprint are divs."""
    for i in range(n):
        words = " ".join(f"w{(i * 37 + j * j) % 1009}" for j in range(40))
        yield (
            f"http://{host}/{i}",
            f"<body><div class=top><div>Home</div><div>News</div></div><div class=box><p>Our offer"
            f"</p></div><div class=text><p>{words}</p><p>end {i}</p></div>"
            f"<div class=low>Imprint</div></body>",
            f"{words} end {i}",
        )


def test_style_tree_removes_what_a_site_repeats(spark):
    rows = [*site("a.example", 30), *site("b.example", 8)]
    # Too few pages to tell; another host's repeated parts do not matter.
    rows.append(("http://c.example/", "<div class=top>Home</div><div class=text>x</div>", "Home x"))
    pages = spark.createDataFrame(
        [(i, url, page) for i, (url, page, _) in enumerate(rows)], "page_id long, url string, html string"
    )
    found = {row.page_id: row for row in html.extract_text(pages).collect()}
    assert {i: found[i].text for i in found} == {i: text for i, (_, _, text) in enumerate(rows)}
    assert all(row.n_chars == len(row.text) for row in found.values())


def test_repeated_articles_stay(spark):
    page = "<nav>m</nav><article><h1>T</h1><p>the same</p></article><footer>f</footer>"
    pages = spark.createDataFrame(
        [(i, "http://a.example/x", page) for i in range(20)], "page_id long, url string, html string"
    )
    assert {row.text for row in html.extract_text(pages).collect()} == {"T the same"}


def test_odd_rows(spark):
    rows = [
        (1, None, "<p>a</p>"),
        (2, "http://x.example/", None),
        (3, "", ""),
        (None, "nothing", "<article>b"),
        (4, "http://x.example/", "<article><p>" + "long " * 100_000 + "</p>" + "<div>" * 3000),
        (4, "http://x.example/", "<article><p>" + "long " * 100_000 + "</p>" + "<div>" * 3000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    clashes = {name: F.lit(0) for name in ("host", "node", "removed", "text", "n_chars", "m", "of_host")}
    found = html.extract_text(pages.withColumns(clashes)).collect()
    long = ("long " * 100_000).strip()
    assert sorted(((r.page_id, r.url, r.text) for r in found), key=repr) == sorted(
        [
            (1, None, "a"),
            (2, "http://x.example/", ""),
            (3, "", ""),
            (None, "nothing", "b"),
            *[(4, "http://x.example/", long)] * 2,
        ],
        key=repr,
    )
    assert html.extract_text(pages.where("false")).isEmpty()


def test_whole_table_equals_the_articles(spark, check_dir):
    pages = spark.read.parquet(f"{check_dir}/pages.parquet")
    found = {row.page_id: row.text for row in html.extract_text(pages).collect()}
    given = pages.collect()
    assert len(found) == len(given)
    for row in given:
        article = re.search(r"<article>(.*?)(</article>|\Z)", row.html, re.DOTALL)[1]
        article = re.sub(r"<[^>]*\Z", "", article)
        article = re.sub(r"</?b>", "", article)
        text = entities.unescape(re.sub(r"<[^>]*>", " ", article))
        assert found[row.page_id] == " ".join(text.split())


def test_branches_on_a_small_share_of_a_host_are_judged(spark):
    """Five pages with a repeated notice of their own among 600 of the host."""
    rows = [
        (
            i,
            f"http://a.example/{i}",
            f"<body><div class=text><p>words {i} of the page</p></div>"
            + ("<div class=rare>Printed notice</div>" if i < 5 else "")
            + "</body>",
        )
        for i in range(600)
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {row.page_id: row.text for row in html.extract_text(pages).collect()}
    assert found == {i: f"words {i} of the page" for i in range(600)}


@pytest.mark.parametrize(
    "page,text",
    [
        ('<div class="content with-sidebar"><article><p>body</p></article></div>', "body"),
        ('<div id="menu"><main><p>body</p></main></div>', "body"),
        ('<article class="post category-social"><p>body</p></article>', "body"),
        ('<article class="sponsored"><p>body</p></article>', "body"),
        ('<article><p>a</p><h2 id="related-work">b</h2><p>c</p></article>', "a b c"),
        ('<article><p>a</p><h2 id="cookies">b</h2></article>', "a b"),
        ('<article><p>a</p><section id="social-contract"><p>b</p></section></article>', "a b"),
        ('<article><p>a</p><div class="widget social">b</div></article>', "a b"),
        ('<div class="comments"><article>only</article></div>', "only"),
        ('<article><p>a</p><div class="x Ad-12">b</div><p id=comment_7>c</p></article>', "a"),
    ],
)
def test_names_of_noise_are_whole_and_spare_what_holds_an_article(page, text):
    assert html.main_text(page) == text


CARDS = '<article class="card"><p>A short teaser.</p></article>' * 3
LONG_TEXT = "The main text of a page that has no article around it."


@pytest.mark.parametrize(
    "page,text",
    [
        (f"<main><p>{LONG_TEXT}</p></main>{CARDS}", LONG_TEXT + " A short teaser." * 3),
        (f"<div class=text><p>{LONG_TEXT}</p>{CARDS}</div>", LONG_TEXT + " A short teaser." * 3),
        (f"<div>By us</div><article><p>{LONG_TEXT}</p></article>", LONG_TEXT),
        (f"<div>By us</div><article><p>{LONG_TEXT}</p></article>{CARDS}", LONG_TEXT + " A short teaser." * 3),
    ],
)
def test_teasers_do_not_replace_the_main_text(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize(
    "page,text",
    [
        (
            '<article><p>one</p><img alt="5" screen"><p>two</p><a href="z">three</a><p>four</p>',
            "one two three four",
        ),
        ("<article><p>one</p><img alt=it's><p>two</p></article>", "one two"),
        ('<article><p>one</p><img alt="5><p>two</p></article>', "one two"),
        ("<article><p>one</p><img alt = '>' title=\">\"><p>two</p></article>", "one two"),
        ('<article><p>one</p><div 5" class="ad">buy</div></article>', "one"),
        ("<article>" + "<div>" * 100 + "a" + "</div>" * 100 + "<p>b</p></article>", "a b"),
        ("<div><article>" + "<div>" * 100 + "a" + "</div>" * 100 + "<p>b</p></article></div>", "a b"),
        (
            "<div><article>" + "<div>" * 100 + "<nav>menu</nav><div class=ad>buy</div>a"
            + "</div>" * 100 + "<p>b</p></article></div>",
            "a b",
        ),
        ("<div>" * 100 + "<article><p>a</p></article>" + "</div>" * 100, "a"),
    ],
)
def test_stray_quotes_and_deep_pages(page, text):
    assert html.main_text(page) == text


def test_deep_styles_count_to_an_ancestor():
    deep = "<div>" * 100 + "<p>a</p>" + "</div>" * 100 + "<p>b</p>"
    assert len(html.styles(deep)) == html.DEEPEST
    assert sorted(html.nodes(deep)) == sorted(node for node, *_ in html.styles(deep))


def test_time_is_linear_in_depth():
    many = 100_000
    for page in (
        "<div>a" * many + "</x>" * many,
        "<p><div>" + "<blockquote>" * many + "<hr>" * many,
        "<li><ul>" + "<div>" * many + "<li></li>" * many,
        "<article>a" * many,
    ):
        assert len(html.main_text(page)) <= 2 * many
        html.styles(page)


REPEATED = (
    '<div class="site"><article class="post"><h1>T</h1><div class="entry-content"><p>The same text on'
    ' all pages of this host.</p></div><div class="tags"><a href="/a">one</a> <a href="/b">two</a>'
    "</div></article></div>"
)


def extracted(spark, pages):
    rows = [(i, "http://a.example/x", page) for i, page in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return [row.text for row in html.extract_text(frame).orderBy("page_id").collect()]


def test_repeated_articles_with_classes_stay_but_for_their_links(spark):
    assert extracted(spark, [REPEATED] * 5) == ["T The same text on all pages of this host."] * 5
    assert extracted(spark, [REPEATED]) == ["T The same text on all pages of this host. one two"]


def test_headings_that_a_site_repeats_within_articles_stay(spark):
    pages = [
        f'<article><h1>Title {i}</h1><h2 class="sec">Summary</h2><p class="lead">words {i} here</p></article>'
        for i in range(12)
    ]
    assert extracted(spark, pages) == [f"Title {i} Summary words {i} here" for i in range(12)]


@pytest.mark.parametrize(
    "name",
    "comment-list user-comments cookie-banner site-footer main-nav ad-slot ad_unit post-comments-2"
    " newsletter-box top-navigation left_sidebar".split(),
)
def test_parts_of_names_tell_noise(name):
    page = f'<article><p>Main.</p><div class="x {name}"><p>Reader says a great deal more than that</p></div></article>'
    assert html.main_text(page) == "Main."
    page = f'<div><p>A main text without an article around it, long enough.</p><div id="{name}">noise</div></div>'
    assert html.main_text(page) == "A main text without an article around it, long enough."


@pytest.mark.parametrize(
    "name", "with-sidebar no-ads has-comments category-social related-work social-contract badge loading".split()
)
def test_parts_of_names_that_tell_no_noise(name):
    page = f'<article><p>Main.</p><div class="{name}"><p>More.</p></div></article>'
    assert html.main_text(page) == "Main. More."


def test_a_part_of_a_name_does_not_take_the_whole_text():
    page = '<div class="page-comments"><p>All there is on this page.</p></div><div class="user-comments">x</div>'
    assert html.main_text(page) == "All there is on this page."


def test_importance_equals_the_entropies_by_hand(spark):
    pages = [page for _, page, _ in site("a.example", 12)] + [REPEATED] * 3
    frame = spark.createDataFrame([("h", page) for page in pages], "host string, html string")
    found = {row.of_node for row in html._importance(frame, Scratch(spark)).collect()}
    seen = {}
    for page in pages:
        for node, n_styles, presentation, content in html.styles(page):
            seen.setdefault(node, []).append((n_styles, presentation, content))
    expected = set()
    for node, rows in seen.items():
        m = len(rows)
        if m < html.LEAST_PAGES:
            continue

        def entropy(values):
            shares = [n / m for n in Counter(values).values()]
            return -sum(p * math.log(p, m) for p in shares)

        content = html.DAMPING ** max(n for n, _, _ in rows)
        importance = (1 - content) * entropy([p for _, p, _ in rows]) + content * entropy([c for _, _, c in rows])
        assert abs(importance - html.LEAST_IMPORTANCE) > 1e-9
        if importance < html.LEAST_IMPORTANCE:
            expected.add(node)
    assert expected and found == expected
