"""Series and reports as text files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_series(series: DataFrame, x: str, path: str) -> None:
    """CSV with a header, ordered by ``x``; file names follow the order."""
    series.orderBy(x).write.mode("overwrite").csv(path, header=True)


def write_report(report: DataFrame, path: str) -> None:
    report.orderBy("line_no").select("line").write.mode("overwrite").text(path)
