"""Page contents for a set of urls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from linkloom.session import materialize


def fetch(jobs: DataFrame, pages: DataFrame) -> DataFrame:
    """Attach html to each job; html is NULL where the page is missing.

    The page table is first cut to the wanted urls with a semi join, so a small
    job list is broadcast (Spark checks its size) and the html of other pages is
    never shuffled. With a large job list both joins share one shuffle on url. The jobs
    are stored first, as both joins read them.
    """
    jobs = materialize(jobs, "jobs")
    wanted = pages.select("url", "html").join(jobs.select("url"), "url", "left_semi")
    return jobs.join(wanted, "url", "left")
