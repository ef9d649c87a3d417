import pytest

from linkloom.plans.crawl import crawl

PAGE = "<meta name=title content='{0}'><body>{1}"


def site(spark):
    def page(name, *links):
        return (f"http://s/{name}", PAGE.format(name, "".join(f"<a href='{link}'>" for link in links)))

    rows = [
        page("a", "http://s/b", "/c", "mailto:x", "https://t/"),
        page("b", "http://s/d", "http://s/a"),
        page("c", "http://s/d", "http://s/gone"),
        page("d", "http://s/a"),
        page("unlinked", "http://s/a"),
    ]
    return spark.createDataFrame(rows, "url string, html string")


def seeds(spark):
    return spark.createDataFrame([("http://s/a",)], "url string")


@pytest.mark.parametrize(
    ("dedupe", "resolve", "want"),
    [
        (False, False, {(0, "a", 1), (1, "b", 1), (2, "d", 1), (2, "a", 1)}),
        (True, False, {(0, "a", 1), (1, "b", 1), (2, "d", 1)}),
        (False, True, {(0, "a", 1), (1, "b", 1), (1, "c", 1), (2, "d", 2), (2, "a", 1), (2, "gone", 1)}),
    ],
)
def test_crawl(spark, dedupe, resolve, want):
    done = crawl(seeds(spark), site(spark), 2, dedupe=dedupe, resolve_links=resolve)
    assert {(r.link_depth, r.url.removeprefix("http://s/"), r.n_jobs) for r in done.jobs.collect()} == want
    pages = {r.url.removeprefix("http://s/"): r for r in done.pages.collect()}
    assert set(pages) == {name for _, name, _ in want}
    assert (pages["a"].title, pages["a"].n_links, pages["a"].fetched) == ("a", 4, True)
    if resolve:
        gone = pages["gone"]
        assert (gone.fetched, gone.title, gone.links, gone.n_links) == (False, None, [], 0)
        summary = {tuple(r) for r in done.depth_summary().collect()}
        assert summary == {(0, 1, 1, 4, 2), (1, 2, 2, 4, 4), (2, 4, 3, 6, 4)}


def test_crawl_options(spark):
    page = "<body><a href=http://b/><a href=http://c/><a href=ftp://d/>"
    pages = spark.createDataFrame([("http://a/", page), ("http://b/", page)], "url string, html string")
    seeds = spark.createDataFrame([("http://a/",), ("ftp://x/",)], "url string")
    every = crawl(seeds, pages, 1)
    assert {r.url for r in every.jobs.collect()} == {"http://a/", "ftp://x/", "http://b/", "http://c/"}
    few = crawl(seeds, pages, 2, max_jobs=3, prune_seeds=True, on_missing="drop")
    assert sorted((r.link_depth, r.url) for r in few.jobs.collect()) == [(0, "http://a/"), (1, "http://b/"), (1, "http://c/")]
    assert {r.url for r in few.pages.collect()} == {"http://a/", "http://b/"}
    assert {r.link_depth: r.n_jobs for r in few.depth_summary().collect()} == {0: 1, 1: 1}
