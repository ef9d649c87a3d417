"""Consolidated throughput series and moving averages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.operators.sampler import SECOND, whole_rates
from linkloom.session import spread

_CHUNK = 100_000


def consolidate(sample_rows: DataFrame, rate_seconds: float) -> DataFrame:
    """Align the workers' series and sum them: (bucket, jobs), gaps are 0.

    A worker's offset is the whole number of rates between the earliest start of
    all workers and its own start. Zero samples add nothing, so only stored ones
    are summed; the gaps are filled from a generated range at the end.
    """
    rate = round(rate_seconds * SECOND)
    earliest = sample_rows.agg(F.min("start")).scalar()
    aligned = sample_rows.select(
        (whole_rates(F.col("start") - earliest, rate) + F.col("idx")).alias("bucket"),
        "jobs",
        "slots",
    )
    summed = aligned.groupBy("bucket").agg(F.sum("jobs").alias("jobs"), F.max("slots").alias("slots"))
    every = _range_to(summed.agg(F.max(F.col("bucket") + F.col("slots")).alias("n")), "bucket")
    return every.join(summed.drop("slots"), "bucket", "left").select(
        "bucket", F.coalesce("jobs", F.lit(0)).cast("long").alias("jobs")
    )


def _range_to(bound: DataFrame, name: str) -> DataFrame:
    """0 .. n-1 from a one-row table with column n, exploded in chunks."""
    step = F.lit(_CHUNK).cast("long")
    chunks = bound.where("n > 0").select(
        "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, step)).alias("_from")
    )
    return spread(chunks, "_from").select(
        F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + _CHUNK, F.col("n")) - 1)).alias(name)
    )


def moving_average(
    series: DataFrame,
    size: int,
    group_by: list[str],
    order_by: str = "idx",
    value: str = "jobs",
    name: str = "moving_avg",
    chunk: int = 10_000,
) -> DataFrame:
    """Mean of the last ``size`` samples of each group.

    ``order_by`` is a dense integer index. A group is cut into chunks; each chunk
    also gets the ``size - 1`` samples before it, so a window never spans more.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    chunk = max(chunk, size)
    own = F.expr(f"{order_by} div {chunk}")
    into = F.expr(f"({order_by} + {size - 1}) div {chunk}")
    placed = series.withColumn("_chunk", F.explode(F.sequence(own, into)))
    last = (
        Window.partitionBy(*group_by, "_chunk")
        .orderBy(order_by)
        .rowsBetween(-(size - 1), Window.currentRow)
    )
    return (
        placed.withColumn(name, F.avg(value).over(last)).where(F.col("_chunk") == own).drop("_chunk")
    )
