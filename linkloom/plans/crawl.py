"""A whole crawl of a page table: seeds -> jobs -> fetched, parsed pages -> links."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions import urls as U
from linkloom.operators import frontier as FR
from linkloom.operators import pages as P
from linkloom.operators.ordering import with_position
from linkloom.session import materialize


@dataclass(frozen=True)
class Crawl:
    """Results of a crawl.

    ``jobs``   (link_depth, url, n_jobs)
    ``pages``  one row per job url: fetched, n_links, n_pruned and the parsed page;
               a page that could not be fetched is an empty page
    ``edges``  (src, pos, dst) of the pruned links that jobs were made from
    """

    jobs: DataFrame
    pages: DataFrame
    edges: DataFrame

    def depth_summary(self) -> DataFrame:
        """Jobs, fetched pages, links found and links kept per depth."""
        counted = self.jobs.join(self.pages.select("url", "fetched", "n_links", "n_pruned"), "url")
        times = lambda c: F.sum(F.col("n_jobs") * F.col(c).cast("long"))
        return counted.groupBy("link_depth").agg(
            F.sum("n_jobs").alias("n_jobs"),
            times("fetched").alias("n_fetched"),
            times("n_links").alias("n_links"),
            times("n_pruned").alias("n_pruned"),
        )


def crawl(
    seeds: DataFrame,
    pages: DataFrame,
    max_depth: int,
    dedupe: bool = False,
    rule: str = "http",
    resolve_links: bool = False,
    max_jobs: int = 0,
    prune_seeds: bool = False,
    on_missing: str = "keep",
) -> Crawl:
    """Crawl (url, html) pages, one row per url, from seed urls.

    Every page is parsed once and written without its html; links, jobs and page
    rows all come from that table. From one on, ``max_jobs`` keeps the first jobs in queue
    order; seeds then come by their ``position``, or by url without one. ``prune_seeds``
    puts the seeds under the rule of the links. With ``on_missing`` "drop", urls without a
    page are left out of the pages and of the summary.
    """
    if on_missing not in ("keep", "drop"):
        raise ValueError("on_missing must be 'keep' or 'drop'")
    if prune_seeds:
        seeds = seeds.where(F.size(U.prune(F.array("url"), rule)) > 0)
    found = P.parse(pages, ["url"], base=resolve_links)
    every = U.resolve_all(F.col("links"), U.base_of(F.col("url"), F.col("base"))) if resolve_links else F.col("links")
    found = found.withColumn("_every", every).withColumn("_kept", U.prune(F.col("_every"), rule))
    parsed = materialize(found.drop("_every", "base"), "parsed")
    edges = parsed.select(F.col("url").alias("src"), F.posexplode_outer("_kept").alias("pos", "dst")).where("pos is not null")
    if max_jobs > 0:
        placed = seeds if "position" in seeds.columns else with_position(seeds.select("url"), ["url"])
        queue = FR.expand_fifo(placed, edges, max_depth, max_jobs, dedupe)
        jobs = queue.groupBy("link_depth", "url").agg(F.count("*").alias("n_jobs"))
    elif dedupe:
        jobs = FR.expand_distinct(seeds, edges, max_depth).withColumn("n_jobs", F.lit(1).cast("long"))
    else:
        jobs = FR.expand_all(seeds, edges, max_depth)
    known = parsed.withColumns(
        {
            "n_links": F.size("links").cast("long"),
            "n_pruned": F.size("_kept").cast("long"),
            "fetched": F.lit(True),
        }
    ).drop("_kept")
    wanted = jobs.select("url").distinct()
    absent = {"fetched": F.coalesce("fetched", F.lit(False))}
    absent |= {c: F.coalesce(c, F.lit(0)) for c in ("n_links", "n_pruned")}
    absent |= {c: F.coalesce(c, F.array().cast("array<string>")) for c in ("links", "keywords")}
    fetched = wanted.join(known, "url", "left" if on_missing == "keep" else "inner").withColumns(absent)
    return Crawl(jobs, fetched, edges)
