"""Per-worker totals, branching factors, lifetimes and download rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.times import micros
from linkloom.operators.ordering import with_running_sums


def totals(log: DataFrame) -> DataFrame:
    """Jobs processed and links discovered per worker."""
    return log.groupBy("worker").agg(
        F.count("*").alias("n_processed"), F.coalesce(F.sum("n_links"), F.lit(0)).alias("n_discovered")
    )


def branching_factor(log: DataFrame, group_by: list[str]) -> DataFrame:
    """Links found per page processed."""
    grouped = log.groupBy(*group_by).agg(
        F.count("*").alias("n_pages"), F.coalesce(F.sum("n_links"), F.lit(0)).alias("n_links")
    )
    return grouped.withColumn("branching_factor", F.round(F.col("n_links") / F.col("n_pages"), 6))


def running_branching_factor(log: DataFrame, order_by: list[str]) -> DataFrame:
    """Branching factor of each worker after every job."""
    counted = log.withColumn("_one", F.lit(1).cast("long"))
    summed = with_running_sums(counted, ["worker"], order_by, {"n_processed": "_one", "n_discovered": "n_links"})
    return summed.drop("_one").withColumn(
        "branching_factor", F.round(F.col("n_discovered") / F.col("n_processed"), 6)
    )


def lifespans(log: DataFrame) -> DataFrame:
    """Jobs and microseconds between first and last job, per worker."""
    t = micros(F.col("processed_at"))
    return log.groupBy("worker").agg(
        F.count("*").alias("n_processed"), (F.max(t) - F.min(t)).alias("lifespan_us")
    )


def grand_total(spans: DataFrame) -> DataFrame:
    """Sum over all workers, shaped like a worker row with a NULL worker."""
    total = spans.agg(F.sum("n_processed").alias("n_processed"), F.sum("lifespan_us").alias("lifespan_us"))
    return total.select(F.lit(None).cast(spans.schema["worker"].dataType).alias("worker"), "*")


def page_sizes(pages: DataFrame, group_by: str) -> DataFrame:
    """Mean page bytes per configuration."""
    return pages.groupBy(group_by).agg(F.avg(F.octet_length("html")).alias("avg_page_size"))


def mean_page_size(sizes: DataFrame) -> DataFrame:
    """Mean of the configurations' means."""
    return sizes.agg(
        F.count("*").alias("n_configurations"), F.round(F.avg("avg_page_size"), 4).alias("avg_page_size")
    )


def pages_per_second(downloads: DataFrame) -> DataFrame:
    """(n_threads, worker, n_pages, seconds) -> pages per second by thread count.

    Pages of all workers divided by the mean time of a worker.
    """
    per_count = downloads.groupBy("n_threads").agg(
        F.sum("n_pages").alias("n_pages"), F.sum("seconds").alias("_seconds")
    )
    mean_seconds = F.col("_seconds").cast("double") / F.col("n_threads")
    return per_count.select("n_threads", "n_pages", F.round(F.col("n_pages") / mean_seconds, 6).alias("pps"))
