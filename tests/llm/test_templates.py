import html
import re

import pytest
from pyspark.sql import functions as F

from scrubline.llm import markup, templates
from scrubline.workspace import written


def plain_article(page):
    """Text of the one article of a test page, cut at its block tags."""
    inside = page[page.index("<article") :].split("</article")[0]
    blocks = re.split(r"</?(?:article|h1|p)[^>]*>", inside)
    cleaned = [" ".join(html.unescape(re.sub("</?b>", "", b.replace("<br>", " "))).split()) for b in blocks]
    return "\n".join(b for b in cleaned if b)


def text_of(page):
    return templates.main_text(page, None, None, None)


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_articles_of_the_test_pages(spark, folder):
    pages = spark.read.parquet(f"/root/testdata/{folder}/pages.parquet")
    want = {r.page_id: plain_article(r.html) for r in pages.collect()}
    found = templates.extract(pages).collect()
    assert len(found) == len(want)
    assert all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in found)


def test_a_template_without_marks_is_deduced(spark):
    """No element says what it is: what all pages of a host share is the template."""
    page = (
        "<html><body><div><p>Welcome to our site</p><ul><li><a href=/a>home {0}</a></li></ul></div>"
        "<h1>Title {0}</h1><table><tr><td>First text of page {0}.</td></tr></table>"
        "<section><p>Second text of {0} &lt;here&gt;.</p></section><pre>Copyright by us</pre></body></html>"
    )
    rows = [(i, f"http://a.example/{i}", page.format(i)) for i in range(20)]
    rows += [(100, "http://alone.example/", page.format(100))]
    found = templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text.split("\n") for r in found}
    for i in range(20):
        assert text[i] == [f"Title {i}", f"First text of page {i}.", f"Second text of {i} <here>."]
    # One page alone shows no template; only what its elements say counts.
    assert "Welcome to our site" in text[100] and "home 100" not in text[100]


def test_copies_are_no_template(spark):
    """Neither a host of copies alone nor one with as many other pages loses their text."""
    page = "<html><body><div><ul><li>menu</ul></div><h1>Title {0}</h1><section><p>{1} of {0}.</section></body></html>"
    rows = [(i, "http://copies.example/", page.format("copy", "Text " * 9)) for i in range(3)]
    rows += [(10 + i, "http://half.example/", page.format("copy", "Text " * 90)) for i in range(3)]
    rows += [(20 + i, "http://half.example/", page.format(i, f"Text {i}")) for i in range(3)]
    found = templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text for r in found}
    assert all("Title copy" in text[i] and "of copy." in text[i] for i in (0, 1, 2, 10, 11, 12))
    assert all(text[20 + i] == f"Title {i}\nText {i} of {i}." for i in range(3))


def test_the_template_decides_within_articles(spark):
    """Text that a host repeats inside its articles goes; text outside a small article stays."""
    framed = "<body><nav>menu</nav><article><h1>Title {0}</h1><p>Read our terms.</p><p>Text {0}.</article></body>"
    loose = (
        "<body><nav>menu</nav><section><p>Long text of page {0}, which no article holds.</section>"
        "<article>Tip {0}</article><pre>by us</pre></body>"
    )
    rows = [(i, "http://framed.example/", framed.format(i)) for i in range(8)]
    rows += [(10 + i, "http://loose.example/", loose.format(i)) for i in range(8)]
    found = templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text for r in found}
    for i in range(8):
        assert text[i] == f"Title {i}\nText {i}."
        assert text[10 + i] == f"Long text of page {i}, which no article holds.\nTip {i}"


def test_slots_decide_inside_the_frame(spark):
    """Teaser cards, hyphenated advert classes and repeated notices go; without the template some stay."""
    page = (
        "<html><body><nav>menu</nav><article><h1>Title {0}</h1><p>Text of page {0}, long enough to be one.</p>"
        "<div class='ad-slot'>Buy {0}</div><p>This story was written by our team.</p>"
        "<div class='newsletter-box'><p>Join {0}</p></div><p>More of {0}.</p></article>"
        "<section class=more><article><a href=/{0}>Another story {0}</a></article>"
        "<article><a href=/x{0}>Yet another story {0}</a></article></section><footer>us</footer></body></html>"
    )
    rows = [(i, f"http://a.example/{i}", page.format(i)) for i in range(20)]
    found = templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    for r in found:
        i = r.page_id
        assert r.text == f"Title {i}\nText of page {i}, long enough to be one.\nMore of {i}."
        without = text_of(rows[i][2])
        assert "Another story" in without and "our team" in without and "Buy" not in without and "Join" not in without


def test_long_class_names():
    found = "ad-slot top_banner newsletter-box site-footer comment-list".split()
    assert all(markup._is_chrome(n) for n in found)
    assert not any(markup._is_chrome(n) for n in "with-sidebar no-comments has-banner headline adder social-science".split())


def test_deep_pages_take_memory_in_proportion_to_their_length():
    sizes = [sum(len(str(t.key)) + len(t.name) for t in markup.read("<div class='a b c'>" * n)) for n in (1000, 4000)]
    assert sizes[1] < 5 * sizes[0]


def test_classes_share_their_occurrence_vector(spark):
    rows = [(i, "http://a.example", "<body><div>x</div>" + "<ul><li>y</ul>" * (i % 3) + "<p>z") for i in range(9)]
    pages = templates.tokenised(spark.createDataFrame(rows, "page_id long, url string, html string"))
    pages = written(pages.withColumn("page", F.monotonically_increasing_id()), "tokens")
    found = templates.equivalence_classes(pages).collect()
    # body, div, x, p and z on all pages; ul, li and y as often as each page has them.
    assert sorted((r.support, len(r.tokens), r.once) for r in found) == [(6, 3, False), (9, 5, True)]
    roots = templates.roots(pages, written(templates.equivalence_classes(pages), "classes")).collect()
    assert len(roots) == 1 and len(roots[0].root) == 5 and len(roots[0].inner) == 3


def test_gaps():
    assert templates.gaps([9, 1, 8, 2, 7], [1, 2]) == [0, 1, 1, 2, 2]
    assert templates.gaps([2, 1], [1, 2]) is None
    assert templates.gaps([1], [1, 2]) is None
    assert templates.gaps([1, 1, 2], [1, 2]) is None


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        (None, ""),
        ("plain words", "plain words"),
        ("<article><p>a<p>b<br>c</article>", "a\nb c"),
        ("<article>a &amp;amp; b&nbsp; c &#233;&#x41;</article>", "a &amp; b c éA"),
        ("<article>a<script>var x='</p><p>';</script>b<style>p{}</style></article>", "a\nb"),
        ("<article>a<!-- <p>no</p> -->b</article>", "ab"),
        ("<article>a<aside>no</aside><p>b</p><div class='x comments'>no<p>no</div>c</article>", "a\nb\nc"),
        ("<nav>no<article><p>yes</article></body>", "yes"),
        ("<header><h1>site</h1></header><article><header><h1>Title</h1>by me</header><p>x</article>", "Title\nx"),
        ("<article><form>no<input><button>no</button></form><ul><li>one<li>two</ul></article>", "one\ntwo"),
        ("<main><p>a</p></main><footer>no</footer>", "a"),
        ("<main>crumbs<article>a</article>more</main>", "a"),
        ("<article><p>yes</p></article><article class=comment>no</article>", "yes"),
        ("<body class='sidebar ads'><article>kept</article></body>", "kept"),
        ("<article>a < b <b class=\"x>y\">c</b> <i d='e>f</article>", "a < b c f"),
        ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n2\n3"),
        ("<article>x<div role=\"complementary\">no</div><span class=ad>no</span> y</article>", "x\ny"),
    ],
)
def test_marks(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<div class='layout with-sidebar'><article>yes</article><div class=sidebar>no</div></div>", "yes"),
        ("<div id='no-comments'><article>yes</article></div>", "yes"),
        ("<div class='page banner'><article>yes</article><div class=related><article>no</article></div></div>", "yes"),
        ("<div class='page header'><article><h1>Title</h1>yes</article></div>", "Title\nyes"),
        ("<div class='page notice'><p>The text of the page</p></div><p>by us</p>", "The text of the page\nby us"),
        ("<p>yes</p><div class=related><article>no, no</article><article>no</article></div><p>longer yes</p>", "yes\nlonger yes"),
        ("<p>yes</p><div class=comments><p>no, not any of these</p></div>", "yes"),
        ("<article>yes</article><div class=comments><article class=comment-body>no</article></div>", "yes"),
    ],
)
def test_class_names_do_not_hide_the_text(page, text):
    assert text_of(page) == text


def test_broken_markup_ends():
    for page in ("<" * 5000, "<a " * 5000, "<a b='" * 3000, "<!--" * 3000, "&" * 5000, "<script>" * 50, "</p>" * 9000):
        markup.read(page)
    assert len(markup.read("<div>" * 3000 + "x")) == 3001


def test_many_nested_marks_end():
    assert text_of("<div class=ad>" * 3000 + "x") == "x"
