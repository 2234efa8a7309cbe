from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from jobscape.llm.main_text import extract, main_text

NONE = frozenset()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("<p>one<p>two", "one two"),
        ("<article><h1>T &amp; U</h1><p>a<b>b</b>c &#233;\n\n d</p></article><p>after", "T & U abc é d"),
        ("<nav>m</nav><header>h</header><main><p>x</p></main><footer>f</footer><aside>s</aside>", "x"),
        ("<p>a</p><form><p>f</p></form><script>if (a < b) '</p>'</script><style>p{}</style><p>b", "a b"),
        ("<div class='cookie-notice'>c</div><div id=comments><p>r</p></div><div class=\"ad\">q</div><p>k</p>", "k"),
        ("<article><p>k</p><section class='comments'><p>r</p></section></article>", "k"),
        ("<article><header><h1>Title</h1></header><p>k</p></article>", "Title k"),
        ("<article>one</article><article>two</article>", "one two"),
        ("<p title='a>b'>q</p><!-- c > d --><p>r", "q r"),
        ("<ul><li>a<li>b</ul><table><tr><td>1<td>2</table>", "a b 1 2"),
        ("<p>a<br>b&nbsp;&nbsp;c</p>", "a b c"),
        ("<p hidden>no</p><p style='display: none'>no</p><p>yes", "yes"),
        ("<b>un<i>balanced</b> tags</i> 1 < 2", "unbalanced tags 1 < 2"),
        ("<title>t</title><textarea>x</textarea><p>y", "y"),
        ("<div class='adventure shared-memory'>z</div>", "z"),
    ],
)
def test_rules(page, text):
    assert main_text(page, NONE) == text


def test_deep_and_long_pages_end():
    assert main_text("<div>" * 20_000 + "x", NONE) == "x"
    assert main_text("<a href='" * 20_000, NONE) == ""
    assert len(main_text("<p>word</p>" * 100_000, NONE)) == 5 * 100_000 - 1


def test_templates_are_counted_per_host(spark):
    def page(i, box):
        return f"<div><p>{box}</p></div><div><p>own text {i} {'x' * i}</p></div>"

    rows = [(i, "http://a.org/x", page(i, "Buy now 17 things")) for i in range(6)]
    rows += [(10 + i, "http://b.org/x", page(i, f"box {'y' * i}")) for i in range(6)]
    rows += [(20 + i, "http://c.org/x", f"<div>menu</div><article><p>Same</p></article>") for i in range(6)]
    rows += [(30, None, page(30, "Buy now 18 things")), (31, "no url", None), (None, "http://a.org/y", "<p>x</p>"), (32, "http://a.org/z", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("text", F.lit("x"))
    got = {r.page_id: r for r in extract(df).collect()}
    assert extract(df).columns == ["page_id", "url", "text", "n_chars"]
    assert got[2].text == "own text 2 xx" and got[13].text.startswith("box yyy")
    assert got[21].text == "Same" and got[30].text.startswith("Buy now 18 things")
    assert (got[31].text, got[31].n_chars, got[32].text, got[None].text) == ("", 0, "", "x")
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_copies_of_a_page_are_one_page(spark):
    copy = "<div>menu</div><main><p>Text of copies</p></main>"
    rows = [(i, "http://a.org/x", copy) for i in range(6)]
    rows += [(10 + i, "http://a.org/x", f"<div>menu</div><main><p>own {'x' * i}</p></main>") for i in range(6)]
    rows += [(20 + i, "http://b.org/x", f"<div>menu</div><p>own {'x' * i}</p>") for i in range(4)]
    rows += [(30 + i, "http://b.org/x", "<p>copy</p>") for i in range(20)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == "Text of copies" for i in range(6)) and got[12] == "own xx"
    assert got[22] == "own xx" and got[33] == "copy"


def test_unnamed_boxes_inside_the_article(spark):
    box = "<div><p>Our reader letter</p><p>comes on Sundays</p></div>"
    table = "<table><tr><td>7<td>own {0}</table><ul><li>salt<li>own {0}</ul>"
    rows = [(i, "http://a.org/x", f"<div>m{i}</div><article><p>own {'x' * i}</p>{box}{table.format('y' * i)}</article>") for i in range(6)]
    # Copies in pages that differ, and an article of nothing but the box.
    rows += [(10 + i, "http://a.org/x", f"<div>m{'z' * i}</div><article><p>of copies</p>{box}</article><p>after") for i in range(6)]
    rows += [(20, "http://a.org/x", f"<article>{box}</article><p>after</p>")]
    rows += [(30 + i, "http://b.org/x", f"<article><p>of copies</p></article><p>{'z' * i}</p>") for i in range(6)]
    # A paragraph that is a teaser elsewhere is no template where it is the article's.
    rows += [(40 + i, "http://c.org/x", f"<p>teaser</p><article><p>{'x' * i or 'teaser'}</p></article>") for i in range(6)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[2] == "own xx 7 own yy salt own yy" and got[12] == "of copies"
    assert got[20] == "Our reader letter comes on Sundays" and got[33] == "of copies"
    assert got[40] == "teaser" and got[42] == "xx"


def test_no_pages(spark):
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize(
    ("part", "stays"),
    [
        ("<p class='share-price'>word</p>", True),
        ("<section id='side-effects'><p>word</p></section>", True),
        ("<table class='related-work'><tr><td>word</td></tr></table>", True),
        ("<p class='alert-level note'>word</p>", True),
        ("<p>a <math><mi>word</mi></math></p>", True),
        ("<div class='share-buttons'>word</div>", False),
        ("<ul class='x related_posts'><li>word</li></ul>", False),
        ("<div id='box-promo'>word</div>", False),
    ],
)
def test_names_inside_an_article_count_whole_only(part, stays):
    text = main_text(f"<body><article><p>first</p>{part}<p>last</p></article></body>", frozenset())
    assert ("word" in text) is stays and text.startswith("first") and text.endswith("last")
