"""Per-site link table and link list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.urls import site_table_name
from linkloom.operators.graph import site_links
from linkloom.session import delete, folders, move


def site_link_rows(edges: DataFrame) -> DataFrame:
    """Stored link rows, with the name the site's own table would have."""
    return site_links(edges).select(
        "site", site_table_name(F.col("site")).alias("site_table"), "link_to", "n_links"
    )


SITE_LINK = "site string, site_table string, link_to string, n_links bigint"


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    return sorted(int(f.partition("=")[2]) for f in folders(spark, path) if f.startswith(f"{name}="))


def _whole(spark: SparkSession, path: str) -> int:
    """The last batch that the merged table holds, -1 before the first merge."""
    return max(_numbers(spark, f"{path}/whole", "upto"), default=-1)


def _sorted(rows: DataFrame, path: str) -> None:
    """Write the link rows sorted by site.

    A folder per site would mean one tiny file per site, and one huge file for the
    largest. Range partitions on (site, link_to) are even whatever the sites are,
    and reading one site skips all files outside its range.
    """
    order = ["site", "link_to"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def add_site_links(rows: DataFrame, path: str, batch_id: int) -> None:
    """Add the counts of a batch, numbered from 0 on, to the table. A repeated batch replaces itself; one that is merged
    already is in the table for good, so it changes nothing."""
    if batch_id > _whole(rows.sparkSession, path):
        _sorted(rows, f"{path}/added/batch_id={batch_id}")


def _up_to(spark: SparkSession, path: str, last: int | None, site: str | None = None) -> DataFrame:
    merged = _whole(spark, path)
    parts = [f"{path}/whole/upto={merged}"] if merged >= 0 else []
    parts += [f"{path}/added/batch_id={n}" for n in _numbers(spark, f"{path}/added", "batch_id") if n > merged and (last is None or n <= last)]
    table = spark.read.schema(SITE_LINK).parquet(*parts) if parts else spark.createDataFrame([], SITE_LINK)
    some = table if site is None else table.where(F.col("site") == site)
    return some.groupBy("site", "site_table", "link_to").agg(F.sum("n_links").alias("n_links"))


def merge_site_links(spark: SparkSession, path: str, last: int) -> None:
    """Merge all batches up to ``last`` into one table, so that reading does not slow down with their number.

    The batches go only when the merged table is complete; until then readers use the ones before.
    """
    merged = _whole(spark, path)
    if last <= merged:
        return
    _sorted(_up_to(spark, path, last), f"{path}/merging")
    move(spark, f"{path}/merging", f"{path}/whole/upto={last}")
    for n in _numbers(spark, f"{path}/whole", "upto"):
        if n < last:
            delete(spark, f"{path}/whole/upto={n}")
    for n in _numbers(spark, f"{path}/added", "batch_id"):
        if n <= last:
            delete(spark, f"{path}/added/batch_id={n}")


def read_site_links(spark: SparkSession, path: str, site: str | None = None) -> DataFrame:
    """Links from each site to each target over all batches; of one site only the files in its range are read."""
    return _up_to(spark, path, None, site)


def append_link_list(links: DataFrame, path: str) -> None:
    """Append every link target, one per line."""
    links.select("href").write.mode("append").text(path)
