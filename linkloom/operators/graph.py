"""Link graph aggregates; partial aggregation runs before every shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions import urls as U


def domain_graph(edges: DataFrame) -> DataFrame:
    """(worker, src, dst) links -> links per worker, source and target domain."""
    return edges.groupBy(
        "worker", U.domain(F.col("src")).alias("src_domain"), U.domain(F.col("dst")).alias("dst_domain")
    ).agg(F.count("*").alias("n_links"))


def total_graph(worker_graphs: DataFrame) -> DataFrame:
    """Sum of the workers' graphs."""
    return worker_graphs.groupBy("src_domain", "dst_domain").agg(F.sum("n_links").alias("n_links"))


def site_links(edges: DataFrame, link_to_width: int | None = None) -> DataFrame:
    """Links from each source site to each target site.

    With a width, targets are cut before they are counted, so that the cut value
    is a key. Links whose source or target has no host are left out, see ``hostless``.
    """
    target = U.site_key(F.col("dst"))
    if link_to_width is not None:
        target = F.substring(target, 1, link_to_width)
    keyed = edges.select(U.site_key(F.col("src")).alias("site"), target.alias("link_to"))
    return (
        keyed.where("site is not null and link_to is not null")
        .groupBy("site", "link_to")
        .agg(F.count("*").alias("n_links"))
    )


def hostless(edges: DataFrame) -> DataFrame:
    """How many links ``site_links`` leaves out."""
    missing = U.host(F.col("src")).isNull() | U.host(F.col("dst")).isNull()
    return edges.agg(F.count_if(missing).alias("n_hostless"), F.count("*").alias("n_links"))
