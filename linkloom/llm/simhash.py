"""SimHash near-duplicates through an inverted index of byte positions.

A 64-bit fingerprint has eight positional bytes. At most four differing bits leave
at least four of them equal, so a pair that shares fewer than four is discarded by its
tally and only the others are compared bit by bit.

A list per (position, byte) would hold 1/256 of all rows. The index therefore joins
three such lists at a time: of any four positions, some triple of ``TRIPLES`` is
contained, so no pair with four shared bytes is missed, and a list holds about
1/2^24 of the distinct fingerprints. Equal fingerprints are one entry.

Lists of at most ``LIST_LIMIT`` entries are compared inside one task, which returns
only links to the smallest member of each linked set. Longer lists (large families of
near copies) take another exact way: two fingerprints differ in at most four bits exactly if
some value lies within two bits of both. Every member is written under the 2,081 values within two
bits of it; at most 2,081 distinct fingerprints can meet under one value.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm import common
from linkloom.session import materialize

SHINGLE, SEED, MAX_BITS, MIN_SHARED = 4, 42, 4, 4
LIST_LIMIT = 4096
_CHUNK = 1 << 16


def _triples() -> list[tuple[int, int, int]]:
    """Triples of the positions 0..7 such that every four positions contain one.

    Positions fall into the classes 0, 1, 2 by remainder. A triple counts if it lies in one class, or
    has two positions in one class and the third in the class after it.
    """
    kept = []
    for triple in combinations(range(8), 3):
        classes = [sum(p % 3 == c for p in triple) for c in range(3)]
        if 3 in classes or any(classes[c] == 2 and classes[(c + 1) % 3] == 1 for c in range(3)):
            kept.append(triple)
    return kept


TRIPLES = _triples()


def fingerprint(text: str | None) -> int:
    """SimHash of the shingles of whole words, as an unsigned number; no words: 0."""
    words = (text or "").encode().lower().split()  # both treat ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        shingles = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[: -SHINGLE] + 1)).tolist()
        shingles = [joined[a:b] for a, b in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        some = hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


@F.arrow_udf(T.LongType())
def fingerprints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        values = np.fromiter((fingerprint(t.as_py()) for t in batch), np.uint64, len(batch))
        yield pa.array(values.view(np.int64))


def shared_bytes(differing: np.ndarray) -> np.ndarray:
    """Tally of equal positional bytes, given the exclusive-or of pairs."""
    return (differing.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)


def near(values: np.ndarray, other: np.ndarray | np.uint64) -> np.ndarray:
    """Which pairs keep enough shared bytes and then differ in few enough bits."""
    differing = values ^ other
    kept = shared_bytes(differing) >= MIN_SHARED
    kept[kept] = np.bitwise_count(differing[kept]) <= MAX_BITS
    return kept


def linked_sets(members: np.ndarray) -> Iterator[tuple[np.uint64, np.ndarray]]:
    """Sets of members connected by near pairs: (first, the others)."""
    rest = members
    while len(rest) > 1:
        first, rest = rest[0], rest[1:]
        queue, found = [first], []
        while queue and len(rest):
            hit = near(rest, queue.pop())
            if hit.any():
                found.append(rest[hit])
                queue.extend(rest[hit])
                rest = rest[~hit]
        if found:
            yield first, np.concatenate(found)


def _list_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside lists; rows come sorted by key, a list may span batches."""
    keys, values = np.empty(0, np.int64), np.empty(0, np.uint64)

    def links(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
        sizes = np.diff(starts, append=len(keys))
        pairs = starts[sizes == 2]
        pairs = pairs[near(values[pairs], values[pairs + 1])]
        a, b = [values[pairs]], [values[pairs + 1]]
        for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            for first, others in linked_sets(values[start : start + size]):
                a.append(np.full(len(others), first))
                b.append(others)
        a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        keys = np.concatenate((keys, batch.column(0).to_numpy()))
        values = np.concatenate((values, batch.column(1).to_numpy().view(np.uint64)))
        if len(keys) and keys[0] != keys[-1]:
            whole = np.searchsorted(keys, keys[-1])  # the last list may go on
            yield links(keys[:whole], values[:whole])
            keys, values = keys[whole:], values[whole:]
    if len(keys):
        yield links(keys, values)


def _postings(values: DataFrame) -> DataFrame:
    def byte(p: int) -> F.Column:
        return F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255))

    keys = [
        F.lit(n << 24).cast("long") + byte(i) * (1 << 16) + byte(j) * (1 << 8) + byte(k)
        for n, (i, j, k) in enumerate(TRIPLES)
    ]
    return values.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _halfway_links(values: DataFrame) -> DataFrame:
    flips = [0] + [1 << i for i in range(64)] + [(1 << i) | (1 << j) for i, j in combinations(range(64), 2)]
    flips = np.array(flips, np.uint64).view(np.int64).tolist()
    met = values.select(
        "fp", F.explode(F.transform(F.lit(flips), lambda m: F.col("fp").bitwiseXOR(m))).alias("between")
    )
    # Distinct members within two bits of one value: 2,081 at most.
    groups = met.groupBy("between").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return groups.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b").distinct()


def near_links(values: DataFrame, list_limit: int = LIST_LIMIT) -> DataFrame:
    """Links (a, b) with the same connected sets as all pairs of distinct fingerprints
    ``fp`` that differ in at most four bits."""
    postings = _postings(values)
    long_lists = materialize(postings.groupBy("key").count().where(F.col("count") > list_limit), "long-lists")
    short = postings
    some_long = not long_lists.isEmpty()
    if some_long:
        short = postings.join(long_lists, "key", "left_anti")
    links = short.repartition("key").sortWithinPartitions("key").mapInArrow(_list_links, "a long, b long").distinct()
    if some_long:
        in_long = postings.join(long_lists, "key", "left_semi").select("fp").distinct()
        links = links.unionByName(_halfway_links(in_long))
    return links


def components(prints: DataFrame, list_limit: int = LIST_LIMIT) -> DataFrame:
    """(fp, component_id) for every distinct fingerprint of rows (doc_id, fp)."""
    values = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = common.connected(near_links(values.select("fp"), list_limit), "near-components")
    named = values.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    named = materialize(named.withColumn("root", F.coalesce("root", "fp")), "near-roots")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(least, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, list_limit: int = LIST_LIMIT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``.

    NULL and wordless texts have fingerprint zero and are linked like any other. The component
    is the smallest doc_id of the linked rows; it is NULL if none has an id. Repeated
    rows stay; other columns of the input are not read. An empty table gives no rows.
    """
    common.prepare(docs.sparkSession)
    prints = materialize(docs.select("doc_id", fingerprints("text").alias("fp")), "simhash")
    named = prints.join(components(prints, list_limit), "fp")
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, list_limit: int = LIST_LIMIT) -> DataFrame:
    """Rows of ``docs``, one of each linked group: the one with the smallest doc_id.

    Rows without id come last; of rows with the same id the first stored one stays. NULL and empty texts have
    fingerprint zero and are linked like any others. All columns stay as they are, whatever they are called; an empty table stays empty.
    """
    common.prepare(docs.sparkSession)
    row_id, simhash = (common.unused(c, docs.columns) for c in ("_row_id", "_simhash"))
    rows = common.with_row_id(docs.withColumn(simhash, fingerprints("text")), "near-rows", row_id)
    prints = rows.select("doc_id", F.col(simhash).alias("fp"), F.col(row_id).alias("_row_id"))
    placed = prints.join(_components_with_null(prints, list_limit), "fp")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row_id"))
    kept = placed.groupBy("_group").agg(first["_row_id"].alias("_row_id"))
    return rows.join(kept.select(F.col("_row_id").alias(row_id)), row_id, "left_semi").select(*docs.columns)


def _components_with_null(prints: DataFrame, list_limit: int) -> DataFrame:
    values = materialize(prints.select("fp").distinct(), "fingerprints")
    roots = common.connected(near_links(values, list_limit), "near-components")
    named = values.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return named.select("fp", F.coalesce("root", "fp").alias("_group"))
