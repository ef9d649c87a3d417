"""Job logs: one row per processed page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def job_log(rows: DataFrame, worker: Column, url: Column, processed_at: Column, n_links: Column) -> DataFrame:
    """(worker, url, processed_at, n_links)."""
    return rows.select(
        worker.alias("worker"),
        url.alias("url"),
        processed_at.alias("processed_at"),
        n_links.cast("long").alias("n_links"),
    )


def event_log(events: DataFrame) -> DataFrame:
    """(worker, processed_at) of an event table."""
    return events.select(F.col("user_id").alias("worker"), F.col("ts").alias("processed_at"))
