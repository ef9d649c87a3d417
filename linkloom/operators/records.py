"""Job records: building, depth filter, missing pages, stored widths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.schemas import PAGE_WIDTHS


def build_jobs(urls: DataFrame, depth: int, discovered_at: Column | None = None) -> DataFrame:
    """Url list -> job rows at one link depth."""
    when = F.current_timestamp() if discovered_at is None else discovered_at
    return urls.select(
        "url", F.lit(depth).cast("int").alias("link_depth"), when.alias("discovered_at")
    )


def may_expand(jobs: DataFrame, max_depth: int) -> DataFrame:
    """Jobs shallow enough for their links to become jobs."""
    return jobs.where(F.col("link_depth") < max_depth)


def missing_pages(pages: DataFrame, on_missing: str = "keep") -> DataFrame:
    """Keep pages whose fetch failed (html NULL) or drop them."""
    if on_missing not in ("keep", "drop"):
        raise ValueError("on_missing must be 'keep' or 'drop'")
    return pages if on_missing == "keep" else pages.where(F.col("html").isNotNull())


def clip_columns(rows: DataFrame, widths: dict[str, int] | None = None) -> DataFrame:
    """Cut text columns to their stored widths; columns not listed are kept."""
    limits = PAGE_WIDTHS if widths is None else widths
    return rows.withColumns(
        {c: F.substring(c, 1, n) for c, n in limits.items() if c in rows.columns}
    )
