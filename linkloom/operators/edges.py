"""Link edges for joins on their source, stored once when joined repeatedly."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.session import materialize, new_path


@dataclass(frozen=True)
class LooseEdges:
    """Edges as they are, for a single join; hot sources are left to the adaptive
    planner, which can split them as both sides are shuffled."""

    table: DataFrame

    def reached_from(self, frontier: DataFrame) -> DataFrame:
        return frontier.join(self.table.withColumnRenamed("src", "url"), "url")

    def forget(self) -> None:
        """Nothing was stored."""


@dataclass(frozen=True)
class StoredEdges:
    """Edges bucketed by (src, slice), so joining them needs no shuffle of edges.

    A source with more links than a bucket's fair share is cut into slices that
    fall into different buckets. ``sliced`` lists these sources and their number
    of slices; it has fewer rows than there are buckets.
    """

    table: DataFrame
    sliced: DataFrame
    name: str

    def reached_from(self, frontier: DataFrame) -> DataFrame:
        """Frontier rows joined with the links of their url."""
        fan = F.coalesce("_slices", F.lit(1))
        spread = (
            frontier.join(F.broadcast(self.sliced), "url", "left")
            .withColumn("_slice", F.explode(F.sequence(F.lit(0), fan - 1)))
            .drop("_slices")
        )
        links = self.table.withColumnsRenamed({"src": "url", "slice": "_slice"})
        return spread.join(links, ["url", "_slice"]).drop("_slice")


    def forget(self) -> None:
        """Drop the catalog entry; the files stay in the shared folder."""
        self.table.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")


def for_joins(edges: DataFrame, columns: list[str], joins: int) -> LooseEdges | StoredEdges:
    """Edges for a number of joins: storing them pays from the second one on."""
    return store(edges, columns) if joins > 1 else LooseEdges(edges.select("src", *columns))


def store(edges: DataFrame, columns: list[str]) -> StoredEdges:
    """Write (src, columns...) bucketed by source.

    The edges are computed once, however they are derived, and every level of an
    expansion then moves its frontier only.
    """
    spark = edges.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = materialize(edges.select("src", *columns).where("src is not null"), "edges")
    share = max(1, -(-plain.count() // buckets))
    # Each of these has more than 1/buckets of all links: fewer rows than buckets.
    degrees = plain.groupBy(F.col("src").alias("url")).agg(F.count("*").alias("_links"))
    sliced = materialize(
        degrees.where(F.col("_links") > share).select(
            "url", F.ceil(F.col("_links") / share).cast("int").alias("_slices")
        ),
        "sliced-sources",
    )
    placed = (
        plain.join(F.broadcast(sliced.withColumnRenamed("url", "src")), "src", "left")
        .withColumn("slice", F.pmod(F.xxhash64(*columns), F.coalesce("_slices", F.lit(1))).cast("int"))
        .drop("_slices")
    )
    name = f"linkloom_edges_{uuid.uuid4().hex}"
    (
        placed.repartition(buckets, "src", "slice")
        .write.bucketBy(buckets, "src", "slice")
        .option("path", new_path(spark, "bucketed-edges"))
        .saveAsTable(name)
    )
    return StoredEdges(spark.table(name), sliced, name)
