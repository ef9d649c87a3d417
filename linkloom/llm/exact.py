"""Exact duplicates through counting quotient filters.

A text's 64-bit fingerprint splits into a quotient (its leading bits) and a remainder. Each
partition builds a filter: per block of quotients the sorted remainders with their
counts. Blocks of all partitions merge by their sorted remainders, adding counts, without
losing a fingerprint. A fingerprint with count one is proof of a unique text; the others
are routed to a comparison of the texts themselves, so a collision never merges two texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm import common
from linkloom.session import materialize

#: Fingerprints per block of a merged filter, on average.
BLOCK_ROWS = 1 << 15
#: A partition closes its filter after so many fingerprints.
FILTER_ROWS = 1 << 20
_FILTER = "block long, remainders binary, counts binary"


def normalised() -> F.Column:
    """Text with every run of ASCII white space as one space; NULL as empty."""
    return F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def merge_sorted(remainders: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct remainders in order, counts of equal ones added."""
    order = np.argsort(remainders, kind="stable")
    remainders, counts = remainders[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], remainders[1:] != remainders[:-1])))
    return remainders[first], np.add.reduceat(counts, first)


def _build(bits: int):
    """Filters of one partition: a row per quotient block."""

    def close(prints: np.ndarray) -> pa.RecordBatch:
        values, counts = np.unique(prints, return_counts=True)
        blocks = (values >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), np.int64)
        rests = values & np.uint64((1 << (64 - bits)) - 1)
        starts = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1])))
        ends = np.append(starts[1:], len(values))
        rows = [
            (int(blocks[a]), rests[a:b].tobytes(), counts[a:b].astype(np.int64).tobytes())
            for a, b in zip(starts, ends, strict=True)
        ]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()), strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["block", "remainders", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy().view(np.uint64))
            n += len(held[-1])
            if n >= FILTER_ROWS:
                yield close(np.concatenate(held))
                held, n = [], 0
        if n:
            yield close(np.concatenate(held))

    return run


def _merge(bits: int):
    """Merge one block's filters; return its fingerprints counted more than once."""

    def run(filters: pd.DataFrame) -> pd.DataFrame:
        remainders = np.concatenate([np.frombuffer(x, np.uint64) for x in filters["remainders"]])
        counts = np.concatenate([np.frombuffer(x, np.int64) for x in filters["counts"]])
        remainders, counts = merge_sorted(remainders, counts)
        again = counts > 1
        top = np.uint64(int(filters["block"].iloc[0]) << (64 - bits)) if bits else np.uint64(0)
        return pd.DataFrame({"fp": (remainders[again] | top).view(np.int64), "n": counts[again]})

    return run


def repeated(prints: DataFrame, rows: int) -> DataFrame:
    """Fingerprints ``fp`` that occur more than once among ``prints``, with their counts.

    The number of blocks follows the number of rows, so a block stays bounded; a
    fingerprint of any number of rows is one entry per partition.
    """
    bits = max(0, int(rows // BLOCK_ROWS).bit_length())
    filters = prints.select("fp").mapInArrow(_build(bits), _FILTER)
    return filters.groupBy("block").applyInPandas(_merge(bits), "fp long, n long")


def _groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Narrow rows (…, fp, sha) of ``docs`` as stored, and one row per verified group of
    equal texts: fp, sha, least (NULL ids last), size."""
    narrow = docs.select("doc_id", "_row_id", F.xxhash64("_norm").alias("fp"), F.sha2("_norm", 256).alias("sha"))
    narrow = materialize(narrow, "exact-rows")
    again = materialize(repeated(narrow, narrow.count()), "exact-repeated")
    texts = docs.select(F.xxhash64("_norm").alias("fp"), "_norm").join(again.select("fp"), "fp", "left_semi")
    # Byte verification: groups are formed by the text itself, collapsed before the shuffle.
    verified = texts.groupBy("fp", "_norm").agg(F.count("*").alias("size")).where("size > 1")
    verified = verified.select("fp", F.sha2("_norm", 256).alias("sha"), "size")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row_id"))
    candidates = narrow.join(again.select("fp"), "fp", "left_semi")
    firsts = candidates.groupBy("fp", "sha").agg(least.alias("least"))
    return narrow, materialize(verified.join(firsts, ["fp", "sha"]), "exact-groups")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    NULL texts equal empty ones. Of equal texts the smallest doc_id stays, NULL ids last;
    of rows with the same id exactly one stays. An empty table gives no rows; other
    columns are not read.
    """
    common.prepare(docs.sparkSession)
    rows = docs.select("doc_id", normalised().alias("_norm"), F.monotonically_increasing_id().alias("_row_id"))
    narrow, groups = _groups(rows)
    placed = narrow.join(groups, ["fp", "sha"], "left")
    alone = F.col("size").isNull()
    return placed.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_row_id") == F.col("least._row_id"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` without later copies of equal texts, all columns unchanged, whatever they are called.

    NULL texts equal empty ones; of equal texts the smallest doc_id stays, NULL ids last; of rows with the same id
    exactly one stays. Texts are compared whole. An empty table stays empty.
    """
    common.prepare(docs.sparkSession)
    row_id = common.unused("_row_id", docs.columns)
    rows = common.with_row_id(docs, "exact-texts", row_id)
    narrow, groups = _groups(rows.select("doc_id", F.col(row_id).alias("_row_id"), normalised().alias("_norm")))
    firsts = groups.select("fp", "sha", F.col("least._row_id").alias("_stays"))
    copies = narrow.join(firsts, ["fp", "sha"]).where("_row_id <> _stays").select(F.col("_row_id").alias(row_id))
    return rows.join(copies, row_id, "left_anti").select(*docs.columns)
