import time

import pytest
from pyspark.sql import functions as F

from linkloom.operators import pages as P
from linkloom.schemas import PARSED_PAGE

ANCHORS = (
    """<a title="a > b" href='X?a=1&amp;b=2'>t</a><a class=q href=unq>u</a><a name=x>v</a>"""
    """<abbr href="no"><a href="">e</a><a data-href="z" href = "w">"""
)

META = """<HTML><HEAD>
<META name="keywords" content="Sea, sand">
<meta content="shells *tide" name='keywords'>
<META NAME="description" content="notes &quot;on&quot; shores">
<meta name="title" content="first"><meta name=title content=Second>
<title>element title</title>
<meta http-equiv="Content-type" content="a charset">
<meta name="generator" http-equiv="content-type" content="ignored">
<meta name="author" content="Pat Example">
<!-- <a href="http://in.comment/"> -->
<script>var a = '<a href="http://in.script/">';</script>
<style>p::after { content: "</p>" }</style>
</HEAD>
<body class="x">
<p>First paragraph</p>
<p>Second  <b>bold</b></p>
<p>Third with a <A HREF="http://site.example/Path">link</A></p>
</body>
after
</HTML>"""


def pages(spark, *htmls):
    return spark.createDataFrame(list(enumerate(htmls)), "page_id bigint, html string")


def parsed(spark, html):
    return P.parse(pages(spark, html), ["page_id"]).first()


def test_anchors(spark):
    found = [r.href for r in P.links(pages(spark, ANCHORS), ["page_id"]).orderBy("pos").collect()]
    assert found == ["x?a=1&b=2", "unq", "", "w"]
    counts = P.link_counts(pages(spark, ANCHORS), ["page_id"]).first()
    assert (counts.n_anchors, counts.n_links, counts.n_without_href, counts.n_pruned) == (5, 4, 1, 0)


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("""<a title=" href=no " href="yes">""", ["yes"]),
        ("""<a title=' href="no"'>""", []),
        ("""<a href="x"class="c"><a class="c"href=y>""", ["x", "y"]),
        ("<a\nhref\n=\n'x'\n>", ["x"]),
        ("<a href=x/y/>", ["x/y/"]),
        ("<article href=no><a href=ok>", ["ok"]),
        ("<a HREF='A&amp;lt;B&#39;'>", ["a&lt;b'"]),
        ("<a hrefx=no href=b><a xhref=no>", ["b"]),
        ("<a href=open", []),
        ("<!-- <a href=a> --><a href=b><!-- unclosed <a href=c>", ["b"]),
        ("<script src=x>'<a href=a>'</script ><a href=b><script>'<a href=c>'", ["b"]),
        ("<script>x = '<!--'</script><a href=b>", ["b"]),
        ("<!-- <script> --><a href=b>", ["b"]),
        ("<scripty><a href=b></scripty>", ["b"]),
        ("<a href=x><a href=x>", ["x", "x"]),
        ("""<p title="<a href=a>"><a href=b>""", ["b"]),
        ("""<a onclick="w('<script>')" href=a><a href=b>""", ["a", "b"]),
        ("""<p title="<!--"><a href=a>""", ["a"]),
        ("""<b don't><a href=a><i it's><a href=b>""", ["a", "b"]),
        ("""<a href="x><a href=b>""", ['"x', "b"]),
        ("""<a href='a' href='b'>""", ["a"]),
        ("<p <a href=a>text<a href=b>", ["b"]),
        ("""<a href=a title="x" = "y>z" class=c>""", ["a"]),
        ("<title><a href=/no></title><textarea>x<a href=/t>y</textarea><a href=/yes>", ["/yes"]),
        ("<iframe><a href=/no></iframe><xmp><a href=/x></xmp ><a href=/yes>", ["/yes"]),
        ("<title><a href=/no>", []),
        ("<titles><a href=/yes></titles>", ["/yes"]),
    ],
)
def test_hrefs(spark, html, want):
    assert parsed(spark, html).links == want


def test_meta_page(spark):
    row = parsed(spark, META)
    assert row.title == "second"
    assert row.author == "pat example"
    assert row.links == ["http://site.example/path"]
    assert row.charset == "a charset"
    assert row.keywords == ["sea", "sand", "shells", "tide"]
    assert row.description == 'notes "on" shores'
    assert row.body_text == "first paragraph second bold third with a link"


@pytest.mark.parametrize("html", ["", None])
def test_missing_page_is_an_empty_page(spark, html):
    row = parsed(spark, html)
    assert (row.title, row.author, row.charset, row.description, row.body_text) == (None,) * 5
    assert row.links == [] and row.keywords == []


def test_last_meta_without_content_clears_the_field(spark):
    assert parsed(spark, "<meta name=title content=a><meta name=title>").title is None
    assert parsed(spark, "<meta name=keywords><meta name=keywords content='a,,b'>").keywords == ["a", "b"]


def test_schema(spark):
    got = P.parse(pages(spark, META), [])
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in PARSED_PAGE]


@pytest.mark.parametrize(
    "html",
    [
        '<a title="' + "x" * 100_000 + '" href="b">',
        "<a " + " ".join(f'd{i}="{i}"' for i in range(100_000)) + ' href="b">',
        "<a " + "x" * 1_000_000 + ' href="b">',
        "<!-- " + "- " * 500_000 + "--><a href=b>",
        "<script>" + "< " * 500_000 + "</script><a href=b>",
        "<body>" + "<i>" * 200_000 + "<a href=b>" + "x < y " * 100_000,
    ],
)
def test_oversized_tags(spark, html):
    row = parsed(spark, html)
    assert row.links == ["b"]
    assert P.link_counts(pages(spark, html), []).first().n_anchors == 1


@pytest.mark.parametrize(
    "piece", ["<a ", "<a x='", '<meta name="', "<script ", "<a href=", "<!-", "<style x", "='", "<body ", "</script "]
)
def test_broken_pages_take_linear_time(spark, piece):
    begin = time.monotonic()
    parsed(spark, piece * 200_000 + "x")
    assert time.monotonic() - begin < 20


def test_raw_text_elements_in_the_body(spark):
    html = "<title>t</title><body>a<textarea rows=2>b <i>c</i> &lt;</textarea >d<xmp><b></xmp><iframe>e</iframe>f<body>g</body>h<textarea>i"
    assert parsed(spark, html).body_text == "a b <i>c</i> &lt; d <b> f g"
    assert parsed(spark, "<body><textarea>a</body>b").body_text == "a</body>b"
    assert parsed(spark, "<body>1<2 <3 </4 x</bodyx>y<a").body_text == "1<2 <3 </4 x y"


def test_absolute_links(spark):
    rows = [
        ("http://h/a/b", "<a href=c><a href=/d><a href='?q'><a href=//i/e>"),
        ("http://h/a/b", "<a href=c><base href='../x/'><base href=no>"),
        ("about:blank", "<a href=c><a href=http://z>"),
        (None, None),
    ]
    table = spark.createDataFrame(rows, "url string, html string")
    got = P.absolute_links(table, ["url"]).collect()
    assert [r.dst for r in got] == ["http://h/a/c", "http://h/d", "http://h/a/b?q", "http://i/e", "http://h/x/c", "c", "http://z"]
    assert [r.dst for r in P.absolute_links(table, ["url"], rule="http").collect()][-2:] == ["http://h/x/c", "http://z"]
    assert [r.base for r in P.parse(table, ["url"], base=True).collect()] == [None, "../x/", None, None]


def test_body_edge_cases(spark):
    assert parsed(spark, "<p>no body</p>").body_text is None
    assert parsed(spark, "<body>a<br>b").body_text == "a b"
    assert parsed(spark, "<body>a < b and it's</body>tail").body_text == "a < b and it's"


def test_regular_expressions_run_once(spark):
    plan = P.parse(pages(spark, META), ["page_id"])._jdf.queryExecution().optimizedPlan().toString()
    # One walk over the page; its pattern is the only one with comments.
    assert plan.count("<!--(?:") == 1
    for exploded in (P.links(pages(spark, META), ["page_id"]), P.keywords(pages(spark, META), ["page_id"]), P.link_counts(pages(spark, META), ["page_id"])):
        plan = exploded._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("<!--(?:") == 1


def test_links_read_two_columns(spark, tmp_path):
    path = f"file://{tmp_path}/p"
    pages(spark, META).withColumn("other", F.lit(1)).write.parquet(path)
    plan = P.links(spark.read.parquet(path), ["page_id"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<page_id:bigint,html:string>" in plan


def test_entities_are_decoded_once(spark):
    cases = {
        "http:&#x2f;&#47;h/": "http://h/",
        "&#38;amp;": "&amp;",
        "a&amp;lt;b": "a&lt;b",
        "&eacute;&hellip;&unknown;&": "é…&unknown;&",
        "&#x1f600;&#233;&#160;&nbsp;": "😀é  ",
        "&#0;&#xd800;&#9999999;&#;": "&#0;&#xd800;&#9999999;&#;",
        "&& &lt": "&& &lt",
        "plain": "plain",
    }
    html = "".join(f'<a href="{raw}">' for raw in cases)
    pages = spark.createDataFrame([(1, html)], "id int, html string")
    assert P.parse(pages, ["id"]).first().links == list(cases.values())
