"""Page table with first-write-wins keys, raw archive, JSON packages."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from linkloom.operators import pages as P
from linkloom.operators.records import clip_columns
from linkloom.schemas import PARSED_COLUMNS, PARSED_PAGE
from linkloom.session import materialize

# Folders that the keys of a page table are dealt into; fixed for the life of a table.
KEY_BUCKETS = 64
PAGE_COLUMNS = ["page_url", *[c for c in PARSED_COLUMNS if c != "links"]]


def page_rows(
    parsed: DataFrame, key: str = "url", keep: list[str] | None = None, widths: dict[str, int] | None = None
) -> DataFrame:
    """Parsed pages as stored rows, keywords joined. ``widths`` cuts columns, but never the key."""
    rows = parsed.withColumn("page_url", F.col(key)).withColumn("keywords", F.concat_ws(",", "keywords"))
    cut = {c: n for c, n in (widths or {}).items() if c != "page_url"}
    return clip_columns(rows.select(*(keep or []), *PAGE_COLUMNS), cut)


def _table_schema(targets: list[str] | None) -> T.StructType:
    """Stored columns; a target named by digits stays text."""
    texts = [T.StructField(c, T.StringType()) for c in [*PAGE_COLUMNS, *(targets or [])]]
    return T.StructType([*texts, T.StructField("batch_id", T.LongType())])


def _same(left: str, right: str, columns: list[str]) -> Column:
    return reduce(and_, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def first_offers(pages: DataFrame, order_by: list[str], targets: list[str] | None = None) -> DataFrame:
    """The earliest offer of each key: (targets..., url, _first). ``order_by`` must tell the offers of a
    url apart. A page without url cannot be stored."""
    keys = [*(targets or []), "url"]
    return pages.where("url is not null").groupBy(*keys).agg(F.min(F.struct(*order_by)).alias("_first"))


def unknown(first: DataFrame, known: DataFrame | None, targets: list[str] | None = None) -> DataFrame:
    """Offers whose key (targets..., url) is not known yet."""
    if known is None:
        return first
    return first.alias("new").join(known.alias("old"), _same("new", "old", [*(targets or []), "url"]), "left_anti")


def offered_pages(pages: DataFrame, first: DataFrame, order_by: list[str], targets: list[str] | None = None) -> DataFrame:
    """Only the pages that are one of the offers; only they are read with their html."""
    keys = [*(targets or []), "url"]
    wins = _same("offer", "first", keys) & F.struct(*[F.col(f"offer.{c}") for c in order_by]).eqNullSafe(F.col("first._first"))
    return pages.alias("offer").join(first.alias("first"), wins, "left_semi")


def _bucket(url: Column) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(KEY_BUCKETS)).cast("int").alias("bucket")


def known_keys(
    first: DataFrame, path: str, batch_id: int, targets: list[str] | None = None
) -> DataFrame | None:
    """Keys (targets..., url) that other batches stored, of the buckets that the offers fall into; None before the first
    write. Keys stand in folders of their own, so no page row and no other bucket is read."""
    spark = first.sparkSession
    touched = [r.bucket for r in first.select(_bucket(F.col("url"))).distinct().collect()]  # at most KEY_BUCKETS
    texts = [T.StructField(c, T.StringType()) for c in [*(targets or []), "url"]]
    schema = T.StructType([*texts, T.StructField("batch_id", T.LongType()), T.StructField("bucket", T.IntegerType())])
    try:
        keys = spark.read.schema(schema).parquet(f"{path}/_keys")
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return keys.where(F.col("bucket").isin(touched)).where(F.col("batch_id") != batch_id).drop("bucket", "batch_id")


def store_pages(
    pages: DataFrame,
    order_by: list[str],
    path: str,
    batch_id: int,
    targets: list[str] | None = None,
    widths: dict[str, int] | None = None,
) -> None:
    """Parse and append the new ones of (url, html, ...) under ``path/batch_id=N``; repeating a batch replaces it.

    Of each url the earliest offer is stored, unless another batch stored the url. Winners are chosen on the key and
    ``order_by`` alone, against the keys stored beside the pages. ``targets`` (the columns a submission is routed by)
    become folders below the batch, one per target table, each with keys of its own.
    """
    first = materialize(first_offers(pages, order_by, targets), "first-offers")
    new = materialize(unknown(first, known_keys(first, path, batch_id, targets), targets), "new-keys")
    won = offered_pages(pages, new, order_by, targets)
    rows = page_rows(P.parse(won, ["url", *(targets or [])]), keep=targets, widths=widths)
    if targets:  # one target's rows meet in few files, a popular target is split
        rows = rows.hint("rebalance", *targets)
    rows.write.mode("overwrite").partitionBy(*(targets or [])).parquet(f"{path}/batch_id={batch_id}")
    # A repeated batch adds its keys again, which changes nothing.
    texts = [F.col(c).cast("string").alias(c) for c in [*(targets or []), "url"]]
    keys = new.select(*texts, F.lit(batch_id).cast("long").alias("batch_id"), _bucket(F.col("url")))
    keys.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{path}/_keys")


def read_pages(spark: SparkSession, path: str, targets: list[str] | None = None) -> DataFrame:
    schema = _table_schema(targets)
    try:
        table = spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        table = spark.createDataFrame([], schema)
    return table.drop("batch_id")


def archive(jobs: DataFrame, formatted_time: Column, prefix: str) -> DataFrame:
    """(archive_id, content): three html comments, then the page as fetched."""
    content = F.concat(
        F.lit("<!-- url: "),
        F.col("url"),
        F.lit(" --><!-- timestamp: "),
        formatted_time,
        F.lit(" --><!-- linkDepth: "),
        F.col("link_depth").cast("string"),
        F.lit(" -->"),
        F.col("html"),
    )
    return jobs.where(F.col("html").isNotNull()).select(
        F.concat(F.lit(prefix + "_"), F.sha2("url", 256)).alias("archive_id"), content.alias("content")
    )


def to_packages(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """Parsed pages as JSON text."""
    return parsed.select(*keep, F.to_json(F.struct(*PARSED_COLUMNS)).alias("package"))


def from_packages(packages: DataFrame, keep: list[str]) -> DataFrame:
    """JSON text back to parsed pages."""
    read = packages.select(*keep, F.from_json("package", PARSED_PAGE).alias("_p"))
    return read.select(*keep, "_p.*")
