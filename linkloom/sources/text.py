"""Url lists in text files, in file order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, url), one row per line, untrimmed, numbered from 0.

    Large files are read in splits. A split is known by its file and offset and
    keeps its lines in order, so line numbers need the line count of each split
    only; no task sees more than one split.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("url"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_seq"),
    )
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        lines.groupBy("_file", "_start")
        .agg(F.count("*").alias("_n"))
        .select("_file", "_start", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    in_split = Window.partitionBy("_file", "_start").orderBy("_seq")
    return (
        lines.withColumn("_row", F.row_number().over(in_split) - 1)
        .join(offsets, ["_file", "_start"])
        .select((F.col("_before") + F.col("_row")).alias("line_no"), "url")
    )


def first_urls(urls: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` urls of a numbered list."""
    return urls.where(F.col("line_no") < limit)
