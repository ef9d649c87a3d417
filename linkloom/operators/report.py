"""Reports as text: throughput tables and key=value series reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.operators.ordering import in_pieces, with_position

#: Points that one row holds before the lines are put together.
PIECE = 4_096


def throughput_minutes(series: DataFrame, rate_seconds: float) -> DataFrame:
    """Consolidated series with its time in minutes."""
    return series.select((F.col("bucket") * rate_seconds / 60).alias("time"), "jobs")


def throughput_seconds(series: DataFrame, rate_seconds: float, x: str, y: str) -> DataFrame:
    """Consolidated series with its time in seconds and named columns."""
    return series.select((F.col("bucket") * rate_seconds).alias(x), F.col("jobs").alias(y))


def series_report(points: DataFrame, info: DataFrame | None = None) -> DataFrame:
    """(line_no, line) of a report.

    ``info`` is (position, key, value); ``points`` is (series, idx, value), already
    aggregated to one row per index. Series are numbered by name; every value list is ascending in idx. A line
    holds a whole series, but nothing before the last step does.
    """
    # Points are put in order by ranges, strung together in pieces, and the pieces of a series in a line.
    placed = in_pieces(points.select("series", "idx", F.col("value").cast("string").alias("value")), ["series", "idx"], PIECE)
    pieces = placed.groupBy("series", "piece").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("_p"))
    strung = pieces.select("series", "piece", F.concat_ws(",", F.col("_p.value")).alias("_text"))
    data = strung.groupBy("series").agg(F.array_sort(F.collect_list(F.struct("piece", "_text"))).alias("_p"))
    listed = data.select("series", F.concat_ws(",", F.col("_p._text")).alias("_data"))
    numbered = with_position(listed, ["series"], "n")
    label = F.concat(F.lit("series"), F.col("n").cast("string"))
    lines = numbered.select(
        F.lit(1).alias("_part"),
        "n",
        F.posexplode(
            F.array(
                F.concat(label, F.lit("_name="), F.col("series")),
                F.concat(label, F.lit("_data="), F.col("_data")),
            )
        ).alias("k", "line"),
    ).select("_part", (F.col("n") * 2 + F.col("k")).cast("long").alias("_at"), "line")
    if info is not None:
        pairs = info.select(
            F.lit(0).alias("_part"),
            F.col("position").cast("long").alias("_at"),
            F.concat("key", F.lit("="), F.col("value").cast("string")).alias("line"),
        )
        lines = pairs.unionByName(lines)
    return with_position(lines, ["_part", "_at"], "line_no").select("line_no", "line")
