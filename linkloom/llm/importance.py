"""Documents drawn by their importance for a target text.

Every document gets the mean gain of its hashed features, an array of one number a bucket, and
seeded Gumbel noise; the highest sums are drawn without replacement. The cut between drawn and
undrawn is found without a global sort, by weighted median of medians: each partition
names the median of its remaining keys and how many remain, the weighted median of these is the next
pivot, and at least a quarter of what remains is discarded each round. Only the winners are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm import byte_words, common
from linkloom.operators.ordering import with_position
from linkloom.session import materialize

#: Longest run of words that is a feature, and number of buckets.
MAX_RUN, BUCKETS = 1, 10_000
#: Least words of a document that can be drawn; percent drawn; seed of the noise.
MIN_WORDS, PERCENT, SEED = 20, 10, 2024
#: The remaining keys are stored anew when they are so small a part of what is read, and that is not small.
SHRUNK, LARGE = 8, 1 << 20
_KEY = ["_neg", "_doc", "_nth"]
_NONE, _OPEN = (-(1 << 63),) * 3, ((1 << 63) - 1,) * 3


def _features(texts: pa.Array, max_run: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and bucket of every feature, and the number of words of every text."""
    words = byte_words.words_of(texts)
    runs = [byte_words.runs_of(words, n) for n in range(1, max_run + 1)]
    rows = np.concatenate([r.rows for r in runs])
    found = np.concatenate([byte_words.crc32(r) for r in runs])
    return rows, found % buckets, np.bincount(words.rows, minlength=len(texts))


def bucket_counts(texts: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over the whole column ``text``; added up in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, np.int64)
        for batch in batches:
            found += np.bincount(_features(batch.column(0), max_run, buckets)[1], minlength=buckets)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(found[some])], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()  # at most one row a bucket
    out = np.zeros(buckets, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed share in target and source."""
    n, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array(
        [math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)],
        np.int64,
    )


def weighed(docs: DataFrame, gain: np.ndarray, max_run: int = MAX_RUN) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row: the floored mean gain of its features."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            rows, buckets, n_words = _features(batch.column(1), max_run, len(gain))
            n = np.bincount(rows, minlength=batch.num_rows)
            total = np.zeros(batch.num_rows, np.int64)
            np.add.at(total, rows, gain[buckets])
            columns = [n_words.astype(np.int64), n.astype(np.int64), total // np.maximum(n, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a standard Gumbel value, from the first 32 bits of a digest of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    u = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def _probe(low: tuple, high: tuple, pivot: tuple):
    """Per task: number and median of the keys strictly between low and pivot, and pivot and high."""

    def before(keys: np.ndarray, bound: tuple) -> np.ndarray:
        a, b, c = keys
        return (a < bound[0]) | ((a == bound[0]) & ((b < bound[1]) | ((b == bound[1]) & (c < bound[2]))))

    def after(keys: np.ndarray, bound: tuple) -> np.ndarray:
        a, b, c = keys
        return (a > bound[0]) | ((a == bound[0]) & ((b > bound[1]) | ((b == bound[1]) & (c > bound[2]))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty((3, 0), np.int64)]
        for batch in batches:
            keys = np.stack([c.to_numpy() for c in batch.columns])
            held.append(keys[:, after(keys, low) & before(keys, high)])
        keys = np.concatenate(held, axis=1)
        sides = []
        for side, part in enumerate((keys[:, before(keys, pivot)], keys[:, after(keys, pivot)])):
            n = part.shape[1]
            if n:
                middle = np.lexsort(part[::-1])[(n - 1) // 2]
                sides.append([side, n, *part[:, middle].tolist()])
        yield pa.RecordBatch.from_arrays([pa.array([s[i] for s in sides], pa.int64()) for i in range(5)], ["side", "n", *_KEY])

    return run


def _weighted_median(medians: list[tuple], sizes: list[int]) -> tuple:
    """The first median, in order, up to which half of all keys are counted."""
    seen, half = 0, sum(sizes) / 2
    for median, n in sorted(zip(medians, sizes, strict=True)):
        seen += n
        if seen >= half:
            return median
    raise ValueError("no keys")


def cutoff(keys: DataFrame, wanted: int) -> tuple | None:
    """The ``wanted``-th smallest of the unique keys (three longs); None if nothing is wanted.

    The driver gets two rows per task and round. Each round at least a quarter of the remaining keys is
    ruled out; what remains is stored anew as it shrinks, so all rounds together read a few times the keys.
    """
    if wanted < 1:
        return None
    low, high, pivot, stored = _NONE, _OPEN, _OPEN, keys
    size = None
    while True:
        some = stored.where(F.col(_KEY[0]).between(low[0], high[0]))
        found = some.select(*_KEY).mapInArrow(_probe(low, high, pivot), "side long, n long, _neg long, _doc long, _nth long").collect()
        sides = [[r for r in found if r.side == s] for s in (0, 1)]
        n_before = sum(r.n for r in sides[0])
        if pivot is not _OPEN and wanted == n_before + 1:
            return pivot
        if wanted <= n_before:
            side, high = sides[0], pivot
        else:
            side, low, wanted = sides[1], pivot, wanted - n_before - 1
        left = sum(r.n for r in side)
        pivot = _weighted_median([tuple(r[2:]) for r in side], [r.n for r in side])
        if size is None:
            size = left
        elif left * SHRUNK <= size and size > LARGE:
            stored, size = materialize(stored.where(F.col(_KEY[0]).between(low[0], high[0])), "remaining-keys"), left


def _up_to(key: tuple) -> Column:
    a, b, c = (F.col(k) for k in _KEY)
    x, y, z = map(F.lit, key)
    return (a < x) | ((a == x) & ((b < y) | ((b == y) & (c <= z))))


def resample(
    docs: DataFrame, target: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED
) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every row of ``docs``; rank is NULL where it is not drawn.

    ``docs`` and ``target`` have a column ``text``; ids are integers. NULL and empty texts have no features and weight 0.
    Rows without id have no noise, so their score is NULL and they are never drawn nor counted. Texts are read whole.
    Ties go to the smaller id; rows with the same id and score follow one after the other. Repeated rows each count and can
    each be drawn. An empty table gives no rows; an empty target counts 0 everywhere. Other columns are ignored.
    """
    common.prepare(docs.sparkSession)
    gain = gains(bucket_counts(docs, max_run, buckets), bucket_counts(target, max_run, buckets))
    scored = weighed(docs, gain, max_run).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = materialize(
        scored.withColumns({"_neg": -F.col("score"), "_doc": F.col("doc_id").cast("long"), "_nth": F.monotonically_increasing_id()}), "weighed"
    )
    able = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    n = scored.where(able).count()
    last = cutoff(scored.where(able).select(*_KEY), n * percent // 100)
    columns = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if last is None:
        return scored.select(*columns, none)
    won = able & _up_to(last)
    ranked = with_position(scored.where(won), _KEY, "_place")
    lost = scored.where(~F.coalesce(won, F.lit(False)))
    return ranked.select(*columns, (F.col("_place") + 1).alias("rank")).unionByName(lost.select(*columns, none))
