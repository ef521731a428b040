import html
import re

from waybill.llm import html_extract as ex

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
    "<nav><ul><li><a href=/a>Menu {k}</a></ul></nav><div class='cookie-notice'>We use cookies</div>{body}"
    "<div id=comments><p>First!</p></div><form><p>Name <input></p></form><footer>&copy; host</footer>"
)


def texts(spark, rows):
    found = ex.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    return {r.page_id: r.text for r in found}


def test_pages_of_the_table(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    found = {r.page_id: r.text for r in ex.extract(pages).collect()}
    for r in pages.collect():
        inside = r.html[r.html.find("<article>") + 9 : r.html.find("</article>")]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?p>|</?h1>", inside)]
        assert found[r.page_id] == "\n".join(b for b in blocks if b)


def test_outside_parts_go(spark):
    body = "<article><h1>Head &amp; line</h1><p>One <b>two\n three<p>Four&nbsp;five<ul><li>six<li>seven</ul><aside>no</aside></article>"
    rows = [(k, f"http://h.example/{k}", PAGE.format(k=k, body=body.replace("Four", f"Four{k}"))) for k in range(3)]
    assert texts(spark, rows) == {k: f"Head & line\nOne two three\nFour{k} five\nsix\nseven" for k in range(3)}


def test_template_without_names_is_found_by_alignment(spark):
    page = "<body><div><div><p>Same words on all pages</p></div><div><h2>Title {k}</h2><p>Text {k} of the page, long enough to be it.</p><p>Same ending</p></div></div></body>"
    rows = [(k, "http://h.example/", page.format(k=k)) for k in range(12)]
    found = texts(spark, rows)
    # The ending is one of a run of paragraphs that vary, so it stays.
    assert found == {k: f"Title {k}\nText {k} of the page, long enough to be it.\nSame ending" for k in range(12)}


def test_odd_pages(spark):
    rows = [
        (1, None, None),
        (2, "x", ""),
        (3, "http://a/", "just text &lt;here&gt;"),
        (4, "http://a/", "<p>unclosed <i>inline<div>next"),
        (5, "http://b/", "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after"),
        (6, "http://b/", "<a title='>' href=\"x>y\">z</a> &am &amp < 5"),
        (7, "http://c/", "<script>never closed <p>x"),
        (7, "http://c/", "<script>never closed <p>x"),
        (8, "http://d/", "word " * 100_000),
    ]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as host", "2 as rule", "3 as text", "4 as template")
    got = ex.extract(df).collect()
    assert len(got) == len(rows)
    found = {r.page_id: r.text for r in got}
    assert found[1] == found[2] == found[7] == ""
    assert found[3] == "just text <here>"
    assert found[4] == "unclosed inline\nnext"
    assert found[5] == "deep\nafter"
    assert found[6] == "z &am & < 5"
    assert len(found[8]) == 499_999
    assert ex.extract(df.limit(0)).collect() == []


def test_outside_parts_go_at_any_depth():
    parts = "<nav>menu <div>in it</div></nav><div class=sidebar>side</div><span hidden>unseen</span><form>name</form><p>text <b>kept</b></p><footer>foot<p>er</footer>"
    for opened, closed in (("<div>" * 300, "</div>" * 300), ("<a><font><b>" * 60, ""), ("<div>" * 118 + "<b>" * 5, "")):
        page = f"<body><div>{opened}{parts}<p>more</p>{closed}</div><p>end"
        assert ex.content(ex.parse(page), None) == "text kept\nmore\nend"


def test_merging_is_alignment():
    a, b = ex.shape([ex.parse("<body><h1>a</h1><p>x</p><ul><li>1</ul></body>")]), ex.shape([ex.parse("<body><p>y</p><ul><li>1</ul><hr></body>")])
    body = ex.merge(a, b)[5][0]
    assert [(k[0], k[1]) for k in body[5]] == [("h1", 1), ("p", 2), ("ul", 2)]
    assert body[5][1][2] is None and body[5][2][2] is not None
