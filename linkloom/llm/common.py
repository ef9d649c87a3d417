"""Settings, row ids and connected components shared by the text operators."""

from __future__ import annotations

import os
import pathlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.session import materialize, new_path, pin_settings

#: Rows and bytes of an Arrow batch: bounds what one Python worker holds of long texts.
BATCH_ROWS, BATCH_BYTES = 256, 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session settings and bound the batches that go to Python."""
    pin_settings(spark)
    # Workers import this package; a cluster has it installed or gets it with --py-files.
    here = str(pathlib.Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if here not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([here, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_mod(column: str, n: int) -> F.Column:
    """crc32 of the id as text, modulo n; NULL ids give NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def is_held_out(column: str, n: int, remainder: int) -> F.Column:
    """Whether the id's remainder is the held-out one; a NULL id has none."""
    return F.coalesce(crc_mod(column, n) == remainder, F.lit(False))


def class_sample(rows: DataFrame, label: str, per_class: int, seed: int) -> DataFrame:
    """doc_id and ``label`` of at most ``per_class`` rows of each class, by a seeded hash,
    with the size of the class. Rows with a NULL id or label are left out; of repeated
    ids one counts. Only narrow rows move."""
    rows = rows.select("doc_id", label).where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    rows = rows.groupBy("doc_id").agg(F.min(label).alias(label))
    order = Window.partitionBy(label).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id")
    sizes = rows.groupBy(label).agg(F.count("*").alias("class_size"))
    taken = rows.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= per_class)
    return taken.drop("_nth").join(sizes, label)


def unused(name: str, columns: list[str]) -> str:
    """The name, with as many underscores as it takes to be none of the columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_id(df: DataFrame, label: str, name: str = "_row_id") -> DataFrame:
    """Store the rows once with a unique id, so that later passes agree on it."""
    return stored_tightly(df.withColumn(name, F.monotonically_increasing_id()), label)


def stored_tightly(df: DataFrame, label: str) -> DataFrame:
    """As ``materialize``, for tables of the size of the input: half the disk for some CPU."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _toward_minimum(pairs: DataFrame) -> DataFrame:
    """For directed (u, v): the smallest v of each u, beside every v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u")


def connected(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of long edges (a, b): one row (node, root) per node with a
    link; root is the smallest node of its component.

    Alternates two rewrites until nothing changes: every node hands its larger
    neighbours to its smallest one, then its smaller neighbours. Both use a
    partial minimum and a join that the adaptive planner can split, so a hub is never
    gathered in one task. Rounds are written to the shared folder. An edge with a NULL
    end is ignored; without edges the result is empty.
    """
    stars = edges.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u"))
    stars = stars.where("a is not null and b is not null and u <> v").distinct()
    stars = materialize(stars, label)
    seen = None
    while True:
        both = stars.unionByName(stars.selectExpr("u as v", "v as u"))
        large = _toward_minimum(both).select("v", "u", F.least("m", "u").alias("m"))
        large = large.where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, label)
        small = _toward_minimum(large)
        small = (
            small.where("v <> m").selectExpr("v as u", "m as v")
            .unionByName(small.selectExpr("u", "m as v"))
            .distinct()
        )
        stars = materialize(small, label)
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
