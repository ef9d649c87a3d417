"""Access list: which database and page table a submitter writes to."""

from __future__ import annotations

from pyspark.sql import DataFrame


def route(submissions: DataFrame, access: DataFrame) -> DataFrame:
    """Add ``database`` and ``page_table``; unknown submitters are refused.

    No broadcast hint: the planner broadcasts the list when its size allows.
    """
    return submissions.join(access.select("auth_name", "database", "page_table"), "auth_name")
