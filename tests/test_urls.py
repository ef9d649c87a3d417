import pytest
from pyspark.sql import functions as F

from linkloom.functions import times as T
from linkloom.functions import urls as U

CASES = [
    ("http://www.example.com:80/x?y", True, True, True, "example.com", "www.example"),
    ("https://m.example.org#top", False, False, True, "m.example.org", "m.example.org"),
    ("HTTP://WWW.example.net/a/b", False, False, True, "example.net", "WWW.example.net"),
    ("/go?to=http://example.com", False, True, False, "", None),
    ("mailto:a@example.com", False, False, False, "mailto", None),
    ("#top", False, False, False, "", None),
    ("http://user:pw@www.example.org/", True, True, True, "user", "www.example"),
    ("//cdn.example.org/x", False, False, False, "", "cdn.example.org"),
    ("http://www/", True, True, True, "www", ""),
    ("http://bad host|/x", True, True, True, "bad host|", "bad host|"),
]


def test_url_expressions(spark):
    u = F.col("url")
    rows = spark.createDataFrame([(c[0],) for c in CASES], "url string").select(
        "url", U.starts_with_http(u), U.contains_http(u), U.any_http(u), U.domain(u), U.site_key(u)
    )
    assert [tuple(r) for r in rows.collect()] == CASES


@pytest.mark.parametrize(
    ("link", "page", "want"),
    [
        ("/a?b", "https://x.example:8/c/d", "https://x.example:8/a?b"),
        ("//y.example/a", "https://x.example/", "https://y.example/a"),
        ("b.html", "https://x.example/", "https://x.example/b.html"),
        ("http://z.example/", "https://x.example/", "http://z.example/"),
        ("/a", "not a url", "/a"),
    ],
)
def test_resolve(spark, link, page, want):
    row = spark.createDataFrame([(link, page)], "l string, p string").select(U.resolve(F.col("l"), F.col("p")))
    assert row.first()[0] == want


def test_prune_and_table_name(spark):
    row = spark.createDataFrame([(["http://a", "https://b", "x http://c"],)], "l array<string>")
    got = row.select(*[U.prune(F.col("l"), r).alias(r) for r in U.PRUNE_RULES]).first()
    assert got.http == ["http://a"]
    assert got.contains_http == ["http://a", "x http://c"]
    assert got.any_http == ["http://a", "https://b"]
    assert row.select(U.site_table_name(F.lit("www.a-b.example"))).first()[0] == "www_a-b_example"


def test_times(spark):
    ts = F.lit("2011-03-05 04:06:07").cast("timestamp")
    row = spark.range(1).select(T.format_time(ts), T.format_time(ts, padded=False), T.from_micros(T.micros(ts)).cast("string"))
    assert tuple(row.first()) == ("5/3/2011 04:06:07", "5/3/2011 4:6:7", "2011-03-05 04:06:07")


# The table of normal and abnormal cases of the url standard, for the base http://a/b/c/d;p?q.
REFERENCES = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g",
    "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s",
    "g?y#s": "http://a/b/c/g?y#s", ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x", "g;x?y#s": "http://a/b/c/g;x?y#s",
    "": "http://a/b/c/d;p?q", ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/",
    "../g": "http://a/b/g", "../..": "http://a/", "../../": "http://a/", "../../g": "http://a/g",
    "../../../g": "http://a/g", "../../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g",
    "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g", "g..": "http://a/b/c/g..", "..g": "http://a/b/c/..g",
    "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h",
    "g;x=1/./y": "http://a/b/c/g;x=1/y", "g;x=1/../y": "http://a/b/c/y", "g?y/./x": "http://a/b/c/g?y/./x",
    "g?y/../x": "http://a/b/c/g?y/../x", "g#s/./x": "http://a/b/c/g#s/./x", "g#s/../x": "http://a/b/c/g#s/../x",
    # As browsers do: a scheme alone does not make it absolute, dots may be escaped, blanks and line ends go.
    "http:g": "http://a/b/c/g", "http:?y": "http://a/b/c/d;p?y", "%2e%2E/g": "http://a/b/g", " \tg\n ": "http://a/b/c/g", "?": "http://a/b/c/d;p?",
    "mailto:a@b": "mailto:a@b", "http://x/a/../b": "http://x/b", "//x/..": "http://x/", "a//../b": "http://a/b/c/a/b",
}


def test_references_are_resolved(spark):
    rows = spark.createDataFrame(list(REFERENCES.items()), "ref string, want string")
    got = rows.select("ref", U.resolve(F.col("ref"), F.lit("http://a/b/c/d;p?q")).alias("got")).collect()
    assert {r.ref: r.got for r in got} == REFERENCES


def test_bases_of_any_kind(spark):
    cases = [
        ("g", "http://a", "http://a/g"), ("?y", "http://a?x", "http://a?y"), ("../..", "http://a", "http://a/"), ("g", "mailto:x", "g"),
        ("g", "/x", "g"), ("g", "", "g"), ("g", None, "g"), (None, "http://a/b", None), ("g", "http:///b", "g"), ("x" * 9_000, "ftp://h/", "ftp://h/" + "x" * 9_000),
    ]
    rows = spark.createDataFrame(cases, "ref string, base string, want string")
    for r in rows.withColumn("got", U.resolve(F.col("ref"), F.col("base"))).collect():
        assert r.got == r.want
    many = spark.createDataFrame([(["a", None, "/b"], "http://h/x/y"), (None, "http://h/")], "links array<string>, base string")
    got = many.select(U.resolve_all(F.col("links"), F.col("base")).alias("got")).collect()
    assert [r.got for r in got] == [["http://h/x/a", None, "http://h/b"], None]
    tags = spark.createDataFrame([("http://h/a/b", "../c/"), ("http://h/a/b", None), ("http://h/a/b", "http://i/")], "url string, base string")
    assert [r[0] for r in tags.select(U.base_of(F.col("url"), F.col("base"))).collect()] == ["http://h/c/", "http://h/a/b", "http://i/"]
