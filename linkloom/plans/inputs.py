"""Inputs of the registered queries, all derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions import urls as U
from linkloom.operators import pages as P
from linkloom.operators.ordering import with_position
from linkloom.session import pin_settings
from linkloom.sources import joblog

DAY = 86_400
MAX_DEPTH = 3
BUDGET = 500
# Thread counts of the download runs.
THREADS = (1, 2, 4, 8, 16)
# Link targets of page i in the derived web graph: pages i + step (mod N).
STEPS = (1, 7, 13)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_settings(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def _numbered(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Pages with ``_nth``, their place by page_id from 0; ids may have gaps."""
    return with_position(pages(spark, sf_dir).select(*columns), ["page_id"], "_nth")


def web_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, src, pos, dst): three links from every page to other pages."""
    known = _numbered(spark, sf_dir, ["page_id", "url"])
    total = pages(spark, sf_dir).agg(F.count("*")).scalar()
    steps = F.array(*[F.lit(k).cast("long") for k in STEPS])
    out = known.select("page_id", "_nth", F.col("url").alias("src"), F.posexplode(steps).alias("pos", "_step"))
    out = out.withColumn("_target", F.pmod(F.col("_nth") + F.col("_step"), total))
    targets = known.select(F.col("_nth").alias("_target"), F.col("url").alias("dst"))
    return out.join(targets, "_target").select("page_id", "src", "pos", "dst")


def real_edges(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """(page_id, src, pos, dst): links found in the html, made absolute; with ``of`` only those
    of its urls, and no other page is parsed."""
    read = pages(spark, sf_dir)
    if of is not None:
        read = read.join(of.select("url"), "url", "left_semi")
    return P.absolute_links(read, ["page_id", "url"]).withColumnRenamed("url", "src")


def page_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of crawled pages and document pages, made absolute: (origin, page_id, src, pos, dst)."""
    return P.absolute_links(all_pages(spark, sf_dir), ["origin", "page_id", "url"]).withColumnRenamed("url", "src")


def domain_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of every domain, numbered by nothing yet: (page_id, url)."""
    grouped = pages(spark, sf_dir).groupBy(U.domain(F.col("url")).alias("domain"))
    return grouped.agg(F.min("page_id").alias("page_id"), F.min_by("url", "page_id").alias("url"))


def tree_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region -> nation -> customer -> order, as (src, dst)."""

    def level(name: str, parent: str, parent_key: str, child: str, child_key: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.concat(F.lit(f"{parent}/"), F.col(parent_key).cast("string")).alias("src"),
            F.concat(F.lit(f"{child}/"), F.col(child_key).cast("string")).alias("dst"),
        )

    return (
        level("nation", "region", "n_regionkey", "nation", "n_nationkey")
        .unionByName(level("customer", "nation", "c_nationkey", "customer", "c_custkey"))
        .unionByName(level("orders", "customer", "o_custkey", "order", "o_orderkey"))
    )


def _escaped(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ('"', "&quot;"), ("<", "&lt;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, html): every document as a page with a full set of meta tags."""
    d = table(spark, sf_dir, "documents")
    doc_id, n_chars = F.col("doc_id").cast("string"), F.col("n_chars").cast("string")
    html = F.concat(
        F.lit('<HTML><HEAD><META NAME="Keywords" CONTENT="'), "lang", F.lit(", "), "source", F.lit(" * doc"), doc_id,
        F.lit("\"><meta name=keywords content='n"), n_chars,
        F.lit("'><title>Not <a href=/no>the title</title><meta name=\"title\" content=\"draft\"><META Name='title' Content=\""),
        "source", F.lit(" &amp; "), doc_id,
        F.lit('"><meta name="author" content="'), "lang",
        F.lit(' desk"><meta http-equiv="Content-Type" content="text/html; charset=utf-8; lang='), "lang",
        F.lit('"><meta name="x" http-equiv="content-type" content="ignored"><meta name="description" content="'),
        _escaped(F.col("text")),
        F.lit('"><!-- <a href="http://commented.example.com/">no</a> --><script>var x = "<a href=\'/no\'>";</script>'),
        # Two of five have a base: relative to the page, or of another host; a second base does not count.
        F.when(d["doc_id"] % 5 == 0, F.lit('<base target=x><base href="../up&#x2F;here?x"><base href=/late/>'))
        .when(d["doc_id"] % 5 == 1, F.lit("<BASE HREF='http://base.example.org/a/b?c#d'>")).otherwise(F.lit("")),
        F.lit('</HEAD><BODY class="d"><p>'), "text",
        F.lit('</p><a class=q href="http://'), "source", F.lit(".example.com/"), doc_id,
        F.lit("?a=1&amp;b=2\">src</a><a href=/rel/"), "lang",
        F.lit('>x</a><a name=top>t</a><a title="a > b" href=\'https://www.example.org/\'>w</a>'),
        F.lit('<a href="page'), (d["doc_id"] % 7).cast("string"), F.lit('.html#s">p</a><a href="../x/./y/../'), "lang",
        F.lit('">r</a><a href="?q=1&#38;r">q</a><a href="//cdn.example.net/../z">c</a><a href="#top">f</a>'),
        F.lit('<textarea rows=2>a <a href=/t>b</a> &c</textarea><a href="&#47;num&#x2f;&#228;&eacute;&#x1f600;&#0;/..">n</a>'),
        F.lit('<a href="mailto:a@b.example">m</a><a href="">e</a><xmp><b></xmp>z</BODY><a href=after></HTML>'),
    )
    url = F.concat(
        F.lit("http://www."), "source", F.lit(".example.com/"), "lang", F.lit("/"), (F.col("n_chars") % 100).cast("string")
    )
    return d.select(F.col("doc_id").alias("page_id"), url.alias("url"), html.alias("html"))


def all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawled pages and document pages: (origin, page_id, url, html)."""
    crawled = pages(spark, sf_dir).select(F.lit("crawl").alias("origin"), "page_id", "url", "html")
    built = document_pages(spark, sf_dir).select(F.lit("document").alias("origin"), "page_id", "url", "html")
    return crawled.unionByName(built)


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joblog.event_log(table(spark, sf_dir, "events"))


def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event e processed page e mod N: (worker, url, processed_at, n_links), plus event_id."""
    # Numbered before they are parsed: dealing rows by range computes them twice.
    numbered = _numbered(spark, sf_dir, ["page_id", "url"])
    counts = numbered.join(P.link_counts(pages(spark, sf_dir), ["page_id"]), "page_id").drop("page_id")
    total = pages(spark, sf_dir).agg(F.count("*")).scalar()
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.pmod(F.col("event_id"), total).alias("_nth")
    )
    return events.join(counts, "_nth").drop("_nth")


def downloads(spark: SparkSession, sf_dir: str, keep: list[str]) -> DataFrame:
    """Every event is a download of ``value`` seconds, run with each thread count:
    (keep..., n_threads, worker, n_pages, seconds)."""
    events = table(spark, sf_dir, "events")
    runs = events.withColumn("n_threads", F.explode(F.array(*[F.lit(n) for n in THREADS])))
    return runs.groupBy(*keep, "n_threads", (F.col("user_id") % F.col("n_threads")).alias("worker")).agg(
        F.count("*").alias("n_pages"), F.sum(F.col("value").cast("decimal(18,2)")).alias("seconds")
    )
