import html
import re

import duckdb

from tests.llm.helpers import collected
from tramline.llm import html_template, queries

TABLES = "/root/testdata/sf0.01"
NONE = frozenset()


def straight(page):
    """The article of the generated pages, by its plain shape."""
    found = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.S)
    blocks = re.split(r"</?p>|</?h1>", found[1]) if found else []
    texts = (html.unescape(re.sub(r"<[^>]*(>|\Z)", " ", re.sub("</?b>", "", b))) for b in blocks)
    return "\n".join(t for t in (re.sub(r"\s+", " ", t).strip() for t in texts) if t)


def test_query_equals_the_plain_shape(spark):
    found = collected(queries.op4_html_extraction(spark, TABLES), "page_id")
    pages = duckdb.sql(f"SELECT page_id, url, html FROM '{TABLES}/pages.parquet'").fetchall()
    assert len(found) == len(pages)
    for page_id, url, page in pages:
        text = straight(page)
        assert tuple(found[page_id]) == (page_id, url, text, len(text))


def body(*parts):
    return "<html><body>" + "".join(parts) + "</body></html>"


def test_what_is_not_the_article():
    page = body(
        "<header>site</header><div class='cookie-notice'>we use cookies</div>",
        "<nav><a href=/>home</a></nav><div id=top_menu>menu</div><div role=navigation>x</div>",
        "<main><article><header><h1>Title</h1></header><p>One <b>bold</b>&amp;<i>more</i>.",
        "<p>Two<br>lines <script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> -->",
        "<aside>side</aside><form><label>Name</label><input></form><div class=ad>buy</div>",
        "<ul><li>first<li>second</ul><pre>a\n  b</pre>",
        "<section class='comments'><p>reader</p></section></article></main>",
        "<footer>&copy;</footer>",
    )
    assert html_template.main_text(page, NONE) == (
        "Title\nOne bold&more.\nTwo lines\nfirst\nsecond\na b"
    )


def test_without_an_article_slots_that_are_no_links():
    page = body("<div><a href=1>one</a> <a href=2>two</a></div><div>text <a href=3>link</a> and more</div>")
    assert html_template.main_text(page, NONE) == "text link and more"


def test_broken_markup():
    assert html_template.main_text("plain text", NONE) == "plain text"
    assert html_template.main_text("<article><p>a<p>b", NONE) == "a\nb"
    assert html_template.main_text("<article><p>a <b>b</p><p>c</article><p>d", NONE) == "a b\nc"
    assert html_template.main_text("<article>a < b &am", NONE) == "a < b &am"
    assert html_template.main_text("<article><p>x</p><div cla", NONE) == "x"
    assert html_template.main_text("</div></p>x<table><tr><td>1<td>2</table>", NONE) == "x\n1\n2"
    html_template.main_text("<" * 20_000 + "<a b=\"" * 300 + "<p>" * 3_000, NONE)


def site(n, host="a.example", extra=""):
    return body(
        f"<div class=x>Read more on {host}</div><article><p>article {n} first</p>",
        f"<p>Share this story</p><p>article {n} last</p>{extra}</article>",
    )


def pages_table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, text string")


def test_template_text_is_no_slot(spark):
    rows = [(n, f"https://a.example/{n}", site(n), "h", "t") for n in range(6)]
    rows += [(100 + n, "https://b.example/", site("copy"), "h", "t") for n in range(6)]
    rows += [(200, "https://c.example/x", site(7), "h", "t"), (201, None, site(8), "h", "t")]
    found = collected(html_template.extract(pages_table(spark, rows)), "page_id")
    for n in range(6):
        assert found[n].text == f"article {n} first\narticle {n} last"
        # Copies of one article count once and make no template.
        assert found[100 + n].text == "article copy first\nShare this story\narticle copy last"
    assert found[200].text == "article 7 first\nShare this story\narticle 7 last"
    assert found[201].text == "article 8 first\nShare this story\narticle 8 last"


def article(*parts):
    return body("<article>", *(f"<p>{part}</p>" for part in parts), "</article>")


def texts_of(spark, pages):
    rows = [(n, "https://a.example/", page, "h", "t") for n, page in enumerate(pages)]
    found = collected(html_template.extract(pages_table(spark, rows)), "page_id")
    return [found[n].text.split("\n") for n in range(len(pages))]


def test_near_copies_count_once(spark):
    lines = [f"line {n} of the copied story" for n in range(8)]
    copies = [[*lines[:n], f"seen at {n}:00", *lines[n + 1 :]] for n in range(6)]
    assert texts_of(spark, [article(*copy) for copy in copies]) == copies
    shared = "share this"
    others = [[f"a story of its own, number {n}", f"and its end {n}"] for n in range(5)]
    pages = [article(*copy, shared) for copy in copies]
    pages += [article(first, shared, last) for first, last in others]
    assert texts_of(spark, pages) == copies + others


def test_versions_that_drift_apart_count_once(spark):
    versions = [[f"line {max(n, n + 10 * ((v - n + 9) // 10))} of a story" for n in range(10)] for v in range(12)]
    assert texts_of(spark, [article(*version) for version in versions]) == versions


def test_text_alone_in_its_class_is_no_template(spark):
    stories = [[f"a story of its own, number {n}"] + ["as told before"] * (n < 5) for n in range(8)]
    assert texts_of(spark, [article(*story) for story in stories]) == stories


def test_members_out_of_order_are_no_template(spark):
    def story(n, *ends):
        return [f"a story of its own, number {n}, which goes on", *ends]

    in_order = [story(n, "one", "two") for n in range(6)]
    assert texts_of(spark, [article(*s) for s in in_order]) == [s[:1] for s in in_order]
    mixed = [story(n, *(["one", "two"] if n % 2 else ["two", "one"])) for n in range(6)]
    assert texts_of(spark, [article(*s) for s in mixed]) == mixed


def test_awkward_rows(spark):
    rows = [(1, "http://x/", None, "", ""), (2, "", "", "", ""), (None, "no url", "<p>t", "", "")]
    found = html_template.extract(pages_table(spark, rows * 2)).collect()
    assert sorted(map(str, found)) == sorted(
        [str(r) for r in found if r.page_id] + [str(r) for r in found if r.page_id is None]
    )
    assert [r.text for r in found if r.page_id is None] == ["t", "t"]
    assert [r.text for r in found if r.page_id] == [""] * 4
    assert html_template.extract(pages_table(spark, rows).limit(0)).count() == 0


def test_hosts():
    assert html_template.host_of("https://u:p@A.Example:80/x?y#z") == "a.example:80"
    assert html_template.host_of("//b.example") == "b.example"
    assert html_template.host_of("mailto:x") is None
