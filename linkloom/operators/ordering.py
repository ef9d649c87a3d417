"""Total order and running totals without a single-task window.

Rows are range-partitioned on a unique ordering, written once, and numbered by
file and position in the file. Only one small row per file is ever looked at
globally, so neither the table nor one hot key passes through one task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.session import materialize

# Ranges that one round of ``smallest`` counts.
BINS = 1024
_PART = r"part-(\d+)[^/]*$"


def _written_in_order(df: DataFrame, order_by: list[str]) -> DataFrame:
    table = materialize(df.repartitionByRange(*order_by).sortWithinPartitions(*order_by), "ordered")
    return table.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )


def _file_order() -> list[Column]:
    return [F.regexp_extract("_file", _PART, 1).cast("long"), F.col("_file")]


def with_position(df: DataFrame, order_by: list[str], name: str = "position") -> DataFrame:
    """Add the dense 0-based position of each row in the total order."""
    rows = _written_in_order(df, order_by)
    before = Window.orderBy(*_file_order()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_file")
        .agg(F.count("*").alias("_n"))
        .select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    # One row per written file, so at most spark.sql.shuffle.partitions rows.
    return (
        rows.join(F.broadcast(offsets), "_file")
        .withColumn(name, F.col("_before") + F.col("_row"))
        .drop("_file", "_row", "_before")
    )


def in_pieces(df: DataFrame, order_by: list[str], size: int) -> DataFrame:
    """Add ``piece`` and ``place``: rows in order lie in pieces of at most ``size`` rows, pieces in order
    of ``piece``, rows of a piece in order of ``place``. A piece may hold the end of one group and the beginning of the next."""
    rows = _written_in_order(df, order_by)
    piece = F.struct(_file_order()[0].alias("file"), F.floor(F.col("_row") / size).alias("nth"))
    return rows.select(*df.columns, piece.alias("piece"), F.col("_row").alias("place"))


def smallest(df: DataFrame, column: str, wanted: int) -> DataFrame:
    """The rows of the ``wanted`` smallest values of a whole-number column without repeats.

    The cut is found by counts over ``BINS`` equal ranges, then over as many within the range it falls into, and so on; the
    driver sees one row per range. Nothing is sorted. The rows are read once per round, so they should be stored.
    """
    lowest, highest, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if n <= wanted or wanted < 1:
        return df if n <= wanted else df.limit(0)
    low, high, left = lowest, highest, wanted  # the last value wanted is the left-th within the range
    while low < high:
        width = -(-(high - low + 1) // BINS)
        inside = df.where(F.col(column).between(low, high))
        counts = dict(inside.groupBy(F.expr(f"int(({column} - {low}L) div {width}L)")).agg(F.count("*")).collect())
        for k in sorted(counts):
            if counts[k] >= left:
                low, high = low + k * width, min(high, low + (k + 1) * width - 1)
                break
            left -= counts[k]
        if counts[k] == left:  # all of this range, so its exact end does not matter
            break
    return df.where(F.col(column) <= high)


def with_running_sums(
    df: DataFrame, group_by: list[str], order_by: list[str], sums: dict[str, str]
) -> DataFrame:
    """Add inclusive running sums per group; ``sums`` maps new column -> input.

    ``order_by`` must be unique within a group; NULL is a group of its own. A group may span any number of
    files; inside one file the window is bounded by the file.
    """
    rows = _written_in_order(df, [*group_by, *order_by])
    per_file = rows.groupBy("_file", *group_by).agg(
        *[F.sum(src).alias(f"_f_{out}") for out, src in sums.items()]
    )
    earlier = Window.partitionBy(*group_by).orderBy(*_file_order())
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    carried = per_file.select(
        "_file",
        *group_by,
        F.row_number().over(earlier).alias("_nth"),
        *[F.coalesce(F.sum(f"_f_{out}").over(before), F.lit(0)).alias(f"_c_{out}") for out in sums],
    ).where("_nth > 1")
    inside = (
        Window.partitionBy("_file", *group_by)
        .orderBy("_row")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = rows.select(
        "*", *[F.coalesce(F.sum(src).over(inside), F.lit(0)).alias(f"_l_{out}") for out, src in sums.items()]
    )
    # Files follow the group order, so only the first group of a file can have
    # begun earlier: at most one carried row per written file.
    keys = {g: f"_g{n}" for n, g in enumerate(["_file", *group_by])}
    carried = carried.drop("_nth").withColumnsRenamed(keys)
    same = reduce(and_, [F.col(g).eqNullSafe(F.col(k)) for g, k in keys.items()])
    return (
        local.join(F.broadcast(carried), same, "left")
        .withColumns({out: F.col(f"_l_{out}") + F.coalesce(f"_c_{out}", F.lit(0)) for out in sums})
        .drop("_file", "_row", *keys.values(), *[f"_{x}_{out}" for out in sums for x in "lc"])
    )


def random_order(df: DataFrame, id_col: str, seed: int = 0, name: str = "position") -> DataFrame:
    """Random permutation: position of each row under a seeded hash of its id.

    The order depends on the seed and the ids only, not on the partitioning.
    """
    keyed = df.withColumn("_key", F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))))
    return with_position(keyed, ["_key", id_col], name).drop("_key")
