"""Approximate nearest neighbours with balanced posting lists.

Centroids come from a bounded sample by splitting clusters until none exceeds its share; every
vector goes to the list of its nearest centroid and, near a boundary, to the lists of further ones
that lie in other directions. A query walks an in-memory graph of the centroids and reads the lists whose
distance is within a ratio of the nearest one. Lists and the queries that read them are cut into
parts of bounded size that meet in one task each. Scores are computed on the original vectors in
double precision.

Equal vectors are one entry with its smallest ids: no more of them can be among a query's nearest.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm import common
from linkloom.session import materialize

NEAREST, QUERY_STEP, SEED = 5, 50, 3
#: Vectors that training sees, centroids, and aimed-at vectors of a list.
SAMPLE_ROWS, SAMPLE_BYTES, MOST_CENTROIDS, LIST_ROWS = 20_000, 64 << 20, 4096, 256
#: A vector is copied to centroids within this ratio of its nearest distance, at most so many lists.
COPY_RATIO, MOST_COPIES = 1.06, 3
#: A query reads lists within this ratio of the nearest list's distance, and so many vectors at least.
READ_RATIO, READ_ROWS = 1.26, 512
LINKS, BEAM = 16, 48
#: Vectors of one part of a list, and queries of one cut.
PART_ROWS = 4096


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def balanced_centroids(sample: np.ndarray, most: int, seed: int = SEED) -> np.ndarray:
    """Directions of clusters of the sample, none of more than ``most`` members."""
    rng, done, waiting = np.random.default_rng(seed), [], [sample]
    while waiting:
        x = waiting.pop()
        if len(x) <= most:
            done.append(x.mean(axis=0))
            continue
        k = min(8, -(-len(x) // most))
        centres = x[rng.choice(len(x), k, replace=False)]
        for _ in range(6):
            near = (x @ centres.T).argmax(axis=1)
            centres = np.stack([x[near == j].mean(axis=0) if (near == j).any() else centres[j] for j in range(k)])
            centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
        near = (x @ centres.T).argmax(axis=1)
        parts = [x[near == j] for j in range(k)]
        if max(map(len, parts)) == len(x):  # cannot be told apart
            parts = np.array_split(x, k)
        waiting += [p for p in parts if len(p)]
    found = np.stack(done)
    lengths = np.linalg.norm(found, axis=1, keepdims=True)
    return found / np.where(lengths > 1e-9, lengths, 1)


class CentroidGraph:
    """Each centroid linked to its nearest ones and to a few random ones."""

    def __init__(self, centroids: np.ndarray, sizes: np.ndarray | None = None, seed: int = SEED):
        self.centroids = centroids
        self.sizes = np.full(len(centroids), LIST_ROWS) if sizes is None else sizes
        rng, n = np.random.default_rng(seed), len(centroids)
        near = np.concatenate(
            [np.argsort(-(centroids[a : a + 512] @ centroids.T), axis=1, kind="stable")[:, : LINKS + 1] for a in range(0, n, 512)]
        )
        links = [set(row.tolist()) - {i} for i, row in enumerate(near)]
        for i in range(n):
            links[i].update(rng.integers(0, n, 4).tolist())
            for j in list(links[i]):
                links[j].add(i)
        self.links = [np.array(sorted(s - {i}), np.int64) for i, s in enumerate(links)]

    def lists(self, query: np.ndarray, ratio: float = READ_RATIO, rows: int = READ_ROWS) -> list[int]:
        """Centroids within ``ratio`` of the nearest distance, nearest first, with ``rows``
        vectors in them at least; a best-first walk that goes on while it finds such."""
        seen = np.zeros(len(self.centroids), bool)
        seen[0] = True
        first = self._distance(query, np.array([0]))[0]
        frontier, found = [(first, 0)], [(first, 0)]
        best = first
        beam: list[float] = [-first]
        while frontier:
            distance, at = heapq.heappop(frontier)
            if distance > ratio * best and len(beam) >= BEAM and distance > -beam[0]:
                break
            new = self.links[at][~seen[self.links[at]]]
            if len(new):
                seen[new] = True
                for d, j in zip(self._distance(query, new).tolist(), new.tolist(), strict=True):
                    heapq.heappush(frontier, (d, j))
                    found.append((d, j))
                    heapq.heappush(beam, -d)
                    if len(beam) > BEAM:
                        heapq.heappop(beam)
                    best = min(best, d)
        found.sort()
        chosen, held = [], 0
        for d, j in found:
            if d > ratio * best and held >= rows:
                break
            chosen.append(j)
            held += self.sizes[j]
        return chosen

    def _distance(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 - 2 * (self.centroids[rows] @ query), 0))


def copies(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) of unit vectors: the nearest centroid, and others within the ratio unless
    one already taken is nearer to that centroid than the vector is."""
    rows, lists = [], []
    k = min(MOST_COPIES, len(centroids))
    for a in range(0, len(x), 1024):
        distance = np.sqrt(np.maximum(2 - 2 * (x[a : a + 1024] @ centroids.T), 0))
        near = np.argsort(distance, axis=1, kind="stable")[:, :k]
        d = np.take_along_axis(distance, near, 1)
        taken = d <= COPY_RATIO * d[:, :1]
        taken[:, 0] = True
        for j in range(1, k):
            for i in range(j):
                between = np.linalg.norm(centroids[near[:, j]] - centroids[near[:, i]], axis=1)
                taken[:, j] &= ~(taken[:, i] & (between < d[:, j]))
        r, c = np.nonzero(taken)
        rows.append(r + a)
        lists.append(near[r, c])
    return np.concatenate(rows), np.concatenate(lists)


def _usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding of rows whose vector can have a cosine."""
    e = F.col("embedding")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    some = F.exists(e, lambda x: x != 0)
    return vectors.select("vec_id", e.cast("array<double>").alias("embedding")).where(e.isNotNull() & fine & some)


def _matrix(column) -> np.ndarray:
    """The vectors, each scaled by a power of two to components below one: cosines stay the same to the last
    digit, and no norm or product can over- or underflow."""
    x = np.stack(column.to_numpy()).astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def _assigned(centroids: np.ndarray):
    def run(batches):
        for frame in batches:
            if len(frame):
                rows, lists = copies(unit(_matrix(frame["embedding"])), centroids)
                yield pd.DataFrame({"rep": frame["rep"].to_numpy()[rows], "list": lists, "embedding": frame["embedding"].to_numpy()[rows]})

    return run


def _routed(graph: CentroidGraph):
    def run(batches):
        for frame in batches:
            if len(frame):
                x = unit(_matrix(frame["embedding"]))
                lists = [graph.lists(v) for v in x]
                often = list(map(len, lists))
                yield pd.DataFrame(
                    {"query": frame["rep"].repeat(often).to_numpy(), "list": np.concatenate(lists), "embedding": frame["embedding"].repeat(often).to_numpy()}
                )

    return run


def _best_of(k: int):
    def run(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": np.empty(0, np.int64), "rep": np.empty(0, np.int64), "score": np.empty(0)})
        if not len(queries) or not len(entries):
            return empty
        q, x = _matrix(queries["embedding"]), _matrix(entries["embedding"])
        ids, lengths, found = entries["rep"].to_numpy(), np.linalg.norm(x, axis=1), [empty]
        for a in range(0, len(q), 256):
            some = q[a : a + 256]
            score = (some @ x.T) / (np.linalg.norm(some, axis=1)[:, None] * lengths)
            n = min(k, len(x))
            # Everything as near as the n-th, so that ties are decided later by id.
            least = np.partition(score, len(x) - n, axis=1)[:, len(x) - n]
            r, c = np.nonzero(score >= least[:, None] - 1e-12)
            found.append(pd.DataFrame({"query": queries["rep"].to_numpy()[a + r], "rep": ids[c], "score": score[r, c]}))
        return pd.concat(found)

    return run


def nearest(vectors: DataFrame, k: int = NEAREST, step: int = QUERY_STEP) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for every row whose id is
    divisible by ``step``; ties go to the smaller id.

    Vectors that are NULL, zero, or hold NULL or non-finite components take no part, nor do
    vectors of another length than most have. A row is never its own neighbour; another row
    with the same id may be one, and every repeated query row has its own result. Rows
    without id can be neighbours, last among ties. An empty table gives no rows; other columns are not read.
    """
    spark = common.prepare(vectors.sparkSession)
    rows = materialize(_usable(vectors).withColumn("_row", F.monotonically_increasing_id()), "ann-rows")
    length = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    result = "query_id long, rank int, vec_id long, score double"
    if length is None:
        return spark.createDataFrame([], result)
    d = length["d"]
    rows = rows.where(F.size("embedding") == d)
    # Of equal vectors the k + 1 smallest ids can be among the nearest; the first stands for all.
    same = Window.partitionBy("embedding").orderBy(F.col("vec_id").isNull(), "vec_id", "_row")
    few = rows.withColumn("_nth", F.row_number().over(same)).where(F.col("_nth") <= k + 1)
    member = F.sort_array(F.collect_list(F.struct("_nth", "vec_id", "_row")))
    entries = few.groupBy("embedding").agg(member.alias("members"))
    entries = materialize(entries.withColumn("rep", F.monotonically_increasing_id()), "ann-entries")
    wanted = rows.where(F.pmod("vec_id", F.lit(step)) == 0).select("vec_id", "_row", "embedding")
    asked = wanted.join(entries.select("rep", "embedding"), "embedding").select("rep", "vec_id", "_row")
    asked = materialize(asked, "ann-queries")
    n = entries.count()
    sample_rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * d)))
    taken = entries.orderBy(F.xxhash64("embedding", F.lit(SEED)), "rep").limit(sample_rows).select("embedding").toPandas()
    sample = unit(_matrix(taken["embedding"]))
    aimed = max(1, min(MOST_CENTROIDS, n // LIST_ROWS))
    centroids = balanced_centroids(sample, max(1, -(-len(sample) // aimed)))
    lists = entries.select("rep", "embedding").mapInPandas(_assigned(centroids), "rep long, list long, embedding array<double>")
    lists = materialize(lists, "ann-lists")
    sizes = np.zeros(len(centroids), np.int64)
    for number, count in lists.groupBy("list").count().collect():  # one row per centroid
        sizes[number] = count
    graph = CentroidGraph(centroids, sizes)
    queries = entries.select("rep", "embedding").join(asked.select("rep").distinct(), "rep", "left_semi")
    routed = materialize(queries.mapInPandas(_routed(graph), "query long, list long, embedding array<double>"), "ann-routed")
    asking = np.zeros(len(centroids), np.int64)
    for number, count in routed.groupBy("list").count().collect():  # one row per centroid
        asking[number] = count

    # A list's vectors are dealt into parts by hash, and the queries that read it into cuts: a vector is copied once for each
    # cut of its own list, so a list that few queries read is not copied, and one that no query reads does not move.
    def dealt(counts: np.ndarray) -> F.Column:
        of_list = F.array(*[F.lit(-(-c // PART_ROWS)) for c in counts.tolist()])
        return F.element_at(of_list, (F.col("list") + 1).cast("int"))

    parts, cuts = dealt(sizes), dealt(asking)
    left = routed.where(parts > 0).select(
        F.col("query").alias("rep"), "list", "embedding", F.pmod(F.xxhash64("query"), cuts).alias("cut"),
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"),
    )
    right = lists.where(cuts > 0).select(
        "rep", "list", "embedding", F.pmod(F.xxhash64("rep"), parts).alias("part"), F.explode(F.sequence(F.lit(0), cuts - 1)).alias("cut")
    )
    key = ["list", "part", "cut"]
    left, right = (x.withColumns({c: F.col(c).cast("long") for c in key}) for x in (left, right))
    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_best_of(k + 1), "query long, rep long, score double")
    # One entry may come from several lists; k + 1 entries hold k + 1 rows at least.
    best = met.groupBy("query", "rep").agg(F.max("score").alias("score"))
    named = best.join(entries.select("rep", "members"), "rep").select("query", "score", F.explode("members").alias("m"))
    order = [F.desc("score"), F.col("m.vec_id").isNull(), F.col("m.vec_id"), F.col("m._row")]
    top = named.withColumn("_nth", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("_nth") <= k + 1)
    top = materialize(top.select("query", "score", "_nth", "m.vec_id", F.col("m._row").alias("_other")), "ann-top")
    pairs = asked.select(F.col("rep").alias("query"), F.col("vec_id").alias("query_id"), "_row").join(top, "query").where("_row <> _other")
    rank = F.row_number().over(Window.partitionBy("query_id", "_row").orderBy("_nth"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
