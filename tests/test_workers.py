from decimal import Decimal

from pyspark.sql import functions as F

from linkloom.operators import graph as G
from linkloom.operators import pages as P
from linkloom.operators import workers as W
from linkloom.plans.stages import python_stage, run_stages
from linkloom.sources import access


def log(spark):
    rows = [("a", 0, 3), ("a", 10, 1), ("a", 40, 2), ("b", 5, 0)]
    return spark.createDataFrame(rows, "worker string, s bigint, n_links bigint").withColumn(
        "processed_at", F.timestamp_seconds("s")
    )


def test_totals_and_branching(spark):
    assert {tuple(r) for r in W.totals(log(spark)).collect()} == {("a", 3, 6), ("b", 1, 0)}
    assert {tuple(r) for r in W.branching_factor(log(spark), ["worker"]).collect()} == {("a", 3, 6, 2.0), ("b", 1, 0, 0.0)}
    running = W.running_branching_factor(log(spark).select("worker", "s", "n_links"), ["s"])
    got = {(r.worker, r.s): (r.n_processed, r.n_discovered, r.branching_factor) for r in running.collect()}
    assert got == {("a", 0): (1, 3, 3.0), ("a", 10): (2, 4, 2.0), ("a", 40): (3, 6, 2.0), ("b", 5): (1, 0, 0.0)}


def test_lifespans(spark):
    spans = W.lifespans(log(spark))
    assert {tuple(r) for r in spans.collect()} == {("a", 3, 40_000_000), ("b", 1, 0)}
    assert tuple(W.grand_total(spans).first()) == (None, 4, 40_000_000)


def test_pages_per_second(spark):
    runs = spark.createDataFrame(
        [(2, 0, 10, Decimal("4")), (2, 1, 10, Decimal("6"))], "n_threads int, worker int, n_pages bigint, seconds decimal(9,2)"
    )
    assert tuple(W.pages_per_second(runs).first()) == (2, 20, 4.0)


def test_page_sizes_are_bytes(spark):
    pages = spark.createDataFrame([("x", "é"), ("x", "ab12"), ("y", "abc")], "config string, html string")
    sizes = W.page_sizes(pages, "config")
    assert {tuple(r) for r in sizes.collect()} == {("x", 3.0), ("y", 3.0)}
    assert tuple(W.mean_page_size(sizes).first()) == (2, 3.0)


def test_graph_totals_equal_summed_worker_graphs(spark):
    edges = spark.createDataFrame(
        [(1, "http://www.a.x/1", "https://a.x/2"), (1, "http://a.x/", "mailto:q"), (2, "http://a.x/3", "http://a.x/")],
        "worker int, src string, dst string",
    )
    graphs = G.domain_graph(edges)
    assert {tuple(r) for r in graphs.collect()} == {(1, "a.x", "a.x", 1), (1, "a.x", "mailto", 1), (2, "a.x", "a.x", 1)}
    assert {tuple(r) for r in G.total_graph(graphs).collect()} == {("a.x", "a.x", 2), ("a.x", "mailto", 1)}


def test_access(spark):
    listed = spark.createDataFrame([("u", "db", "t")], "auth_name string, database string, page_table string")
    sent = spark.createDataFrame([("u", 1), ("stranger", 2)], "auth_name string, n int")
    assert [tuple(r) for r in access.route(sent, listed).collect()] == [("u", 1, "db", "t")]


def test_stages_with_python(spark):
    def shout(batches):
        for batch in batches:
            yield batch.assign(href=batch.href.str.upper())[["href"]]

    pages = spark.createDataFrame([("<a href=a><a href=b>",)], "html string")
    got = run_stages(pages, [lambda p: P.links(p, []), python_stage(shout, "href string"), lambda d: d.where("href > 'A'")])
    assert [r.href for r in got.collect()] == ["B"]


def test_link_mode(spark):
    counts = P.link_counts(spark.createDataFrame([("<a href=http://a><a href=b>",)], "html string"), [])
    assert tuple(counts.select(P.link_total("raw"), P.link_total("pruned")).first()) == (2, 1)
