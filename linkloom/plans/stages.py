"""Ordered chains of user-supplied processing functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

Stage = Callable[[DataFrame], DataFrame]


def run_stages(jobs: DataFrame, stages: Iterable[Stage]) -> DataFrame:
    """Feed the output of each stage to the next.

    A stage maps a table of jobs to a table of output jobs, any number per input.
    Built-in expressions of neighbouring stages fuse into one pass over the data.
    """
    for stage in stages:
        jobs = jobs.transform(stage)
    return jobs


def python_stage(function: Callable, schema: str) -> Stage:
    """A stage that needs Python: batches of rows in, batches of rows out."""
    return lambda jobs: jobs.mapInPandas(function, schema)
