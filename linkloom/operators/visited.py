"""A growing set of visited urls, bucketed by url.

Rows are only ever added. New urls are shuffled once, by url, into as many partitions as there are buckets; the set
itself is read bucket by bucket and never moves, however many levels or batches it holds.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.session import new_path


@dataclass(frozen=True)
class Visited:
    """Table (url, link_depth, step): step is the level or batch that added the row."""

    spark: SparkSession
    name: str
    buckets: int

    @property
    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, urls: DataFrame, step: int, placed: bool = True) -> None:
        """Add (url, link_depth). Rows that come from ``unseen`` are placed where they belong; others move there first."""
        urls = urls if placed else urls.repartition(self.buckets, "url")
        rows = urls.select("url", F.col("link_depth").cast("int").alias("link_depth"), F.lit(step).cast("long").alias("step"))
        rows.write.mode("append").format("parquet").bucketBy(self.buckets, "url").saveAsTable(self.name)

    def unseen(self, urls: DataFrame, condition: Column | None = None) -> DataFrame:
        """The urls (one row each) that the set does not have; with a condition on the columns of
        both, ``new`` and ``old``, those that it has no such row of."""
        same = F.col("new.url") == F.col("old.url")
        return urls.alias("new").join(
            # The set may be large: it must stay where it is, so it is not offered for a broadcast.
            self.table.alias("old").hint("merge"), same if condition is None else same & condition, "left_anti"
        )

    def forget(self) -> None:
        """Drop the catalog entry; the files stay where they are."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def open_at(spark: SparkSession, path: str, buckets: int) -> Visited:
    """The set whose files lie under ``path``; nothing yet is an empty one."""
    name = f"linkloom_visited_{zlib.crc32(path.encode()):08x}_{buckets}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (url STRING, link_depth INT, step BIGINT) USING parquet "
        f"CLUSTERED BY (url) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return Visited(spark, name, buckets)


def create(spark: SparkSession, label: str = "visited") -> Visited:
    """An empty set in the shared folder with a bucket for each shuffle partition."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return open_at(spark, new_path(spark, f"{label}-{uuid.uuid4().hex[:8]}"), buckets)
