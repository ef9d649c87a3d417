"""A queue of crawl jobs that feeds itself.

Jobs lie as files in a folder, which a stream reads. What a batch of jobs leads to is written
into the same folder and becomes a later batch. Jobs already done and urls already visited stand beside it, so
a stopped crawl goes on where it was, and a repeated batch replaces what it wrote. The crawl ends when a batch adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkloom.operators import pages as P
from linkloom.operators.edges import for_joins
from linkloom.operators.visited import open_at
from linkloom.session import folders, new_path, scratch
from linkloom.sinks import pages as page_sink
from linkloom.streaming.crawl import _read, _start

JOB = "link_depth int, url string, n_jobs bigint"
#: Jobs of a batch and its number -> the jobs they lead to.
Process = Callable[[DataFrame, int], DataFrame]


def submit(seeds: DataFrame, path: str, name: str = "seeds") -> None:
    """Put urls into the queue as jobs of depth 0; the same name again replaces them. More may be submitted at any time."""
    jobs = seeds.where("url is not null").groupBy("url").agg(F.count("*").alias("n_jobs"))
    jobs.select(F.lit(0).alias("link_depth"), "url", "n_jobs").write.mode("overwrite").parquet(f"{path}/queue/{name}")


def by_edges(edges: DataFrame, max_depth: int) -> Process:
    """Jobs lead to the targets of their links (src, dst), down to ``max_depth``."""
    links = for_joins(edges.select("src", "dst"), ["dst"], max_depth + 1)

    def process(jobs: DataFrame, batch_id: int) -> DataFrame:
        reached = links.reached_from(jobs.where(F.col("link_depth") < max_depth))
        deeper = (F.col("link_depth") + 1).alias("link_depth")
        return reached.groupBy(deeper, F.col("dst").alias("url")).agg(F.sum("n_jobs").alias("n_jobs"))

    return process


def by_pages(pages: DataFrame, max_depth: int, path: str, rule: str = "http") -> Process:
    """Jobs fetch their page (url, html), one row per url, store it in the page table under ``path/pages`` and lead to its
    pruned links, made absolute."""

    def process(jobs: DataFrame, batch_id: int) -> DataFrame:
        got = pages.select("url", "html").join(jobs, "url")
        page_sink.store_pages(got.select("url", "html"), ["url"], f"{path}/pages", batch_id)
        found = P.absolute_links(got.where(F.col("link_depth") < max_depth), ["url", "link_depth", "n_jobs"], rule)
        deeper = (F.col("link_depth") + 1).alias("link_depth")
        return found.groupBy(deeper, F.col("dst").alias("url")).agg(F.sum("n_jobs").alias("n_jobs"))

    return process


def _buckets(spark: SparkSession, path: str) -> int:
    """Buckets of the visited set, fixed when the queue is first followed: part of the name of its folder."""
    known = [int(f.partition("-")[2]) for f in folders(spark, path) if f.startswith("visited-")]
    return known[0] if known else int(spark.conf.get("spark.sql.shuffle.partitions"))


def follow(
    spark: SparkSession, process: Process, path: str, dedupe: bool = True, files_per_batch: int = 1_000, available_now: bool = False, ran: list[int] | None = None
) -> StreamingQuery:
    """Work off the queue as it fills, until stopped; with ``available_now`` only what lies in it at the start.

    With ``dedupe`` a url is done again only when it is reached by fewer links than before, so the order in
    which jobs arrive does not change the result. ``ran`` gets the numbers of the batches.
    """
    buckets = _buckets(spark, path)
    seen = open_at(spark, f"{path}/visited-{buckets}", buckets) if dedupe else None

    def step(batch: DataFrame, batch_id: int) -> None:
        if ran is not None:
            ran.append(batch_id)
        with scratch(spark):
            work(batch, batch_id)

    def work(batch: DataFrame, batch_id: int) -> None:
        done = f"{path}/jobs/batch_id={batch_id}"
        if seen:
            # What this batch added when it ran before does not count.
            known = (F.col("old.link_depth") <= F.col("new.link_depth")) & (F.col("old.step") != batch_id)
            first = batch.groupBy("url").agg(F.min("link_depth").alias("link_depth"), F.lit(1).cast("long").alias("n_jobs"))
            seen.unseen(first, known).select("link_depth", "url", "n_jobs").write.mode("overwrite").parquet(done)
        else:
            batch.groupBy("link_depth", "url").agg(F.sum("n_jobs").alias("n_jobs")).write.mode("overwrite").parquet(done)
        jobs = spark.read.schema(JOB).parquet(done)
        if jobs.isEmpty():
            return
        if seen:
            seen.add(jobs, batch_id, placed=False)
        process(jobs, batch_id).where("url is not null").select("link_depth", "url", "n_jobs").write.mode("overwrite").parquet(
            f"{path}/queue/batch-{batch_id}"
        )

    # The folders of the queue are matched by a pattern, as new ones come while it is read.
    jobs = spark.readStream.schema(JOB).option("maxFilesPerTrigger", files_per_batch).parquet(f"{path}/queue/*")
    return _start(jobs.writeStream.foreachBatch(step), path, available_now)


def run(spark: SparkSession, process: Process, path: str, dedupe: bool = True, files_per_batch: int = 1_000) -> None:
    """Work off the queue and all it leads to; returns when a round finds nothing new in it."""
    while True:
        ran: list[int] = []
        follow(spark, process, path, dedupe, files_per_batch, available_now=True, ran=ran).awaitTermination()
        if not ran:
            return


def read_jobs(spark: SparkSession, path: str, dedupe: bool = True) -> DataFrame:
    """Jobs done so far, by url and depth: (link_depth, url, n_jobs); with ``dedupe`` (link_depth, url), every url at its
    smallest depth."""
    jobs = _read(spark, f"{path}/jobs", f"{JOB}, batch_id int")
    if dedupe:
        return jobs.groupBy("url").agg(F.min("link_depth").alias("link_depth")).select("link_depth", "url")
    return jobs.groupBy("link_depth", "url").agg(F.sum("n_jobs").alias("n_jobs"))


def crawl(
    seeds: DataFrame, process: Callable[[str], Process], dedupe: bool = True, files_per_batch: int = 1_000, path: str | None = None
) -> str:
    """Submit seeds, run to the end, and return the folder of the crawl; ``process`` is made for that folder."""
    spark = seeds.sparkSession
    path = path or new_path(spark, "crawl")
    submit(seeds, path)
    run(spark, process(path), path, dedupe, files_per_batch)
    return path
