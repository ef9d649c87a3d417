"""Quality scores from supervised subword embeddings.

Words, marks for words that repeat the one before, and the character n-grams of words are hashed to buckets, each with a learned
vector; a document is the mean of its vectors, a softmax layer gives the
probability of the better class. Vectors and layer are trained together by stochastic gradient descent in
numpy, on a bounded sample of labelled documents (``PER_CLASS`` each), with class weights that
restore the classes' shares. Hashing is arithmetic on whole byte arrays.

The layer is linear in the mean, so when scoring, a bucket's vector acts through one number: its
product with the layer. Scores are the same, and a text costs one table read per feature.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm import common
from linkloom.session import materialize

BITS, DIMENSION, GRAMS = 17, 16, (3, 4, 5)
#: A word equal to the one before it also counts as so many mark words, about as many as it has n-grams.
MARKS = 12
#: Labelled documents of a class that training sees at most.
PER_CLASS, SEED = 1500, 8
EPOCHS, RATE, THRESHOLD = 6, 0.5, 0.3
_PRIME, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))
_CHUNK = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, base, np.uint64))))


def _buckets(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (((hashes + np.uint64(kind)) * _MIX) >> np.uint64(64 - BITS)).astype(np.intp)


def _chunk_features(x: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of the words and n-grams of bytes that begin and end with white space."""
    space = _SPACE[x]
    value = np.where(space, np.uint64(32), x.astype(np.uint64))  # any white space marks a word's edge
    edges = np.flatnonzero(space)
    starts, ends = edges[:-1] + 1, edges[1:]
    some = ends > starts
    starts, ends = starts[some], ends[some]
    sums = np.concatenate(([np.uint64(0)], np.cumsum(value * _powers(_PRIME, len(x) - 1)[: len(x)])))
    words = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(x))[starts]
    yield _buckets(words, 1)
    again = np.count_nonzero(words[1:] == words[:-1])
    yield _buckets(np.tile(np.arange(MARKS, dtype=np.uint64), again), 2)
    rolled = value
    inner = ~space  # position k of the gram may not be white space, except its first and last byte
    usable = np.ones(len(x), bool)
    for n in range(2, max(GRAMS) + 1):
        rolled = rolled[:-1] * _PRIME + value[n - 1 :]
        usable = usable[: len(x) - n + 1]
        if n > 2:
            usable = usable & inner[n - 2 : len(x) - 1]
        if n in GRAMS:
            yield _buckets(rolled[usable], n)


def features(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of a whole text, in chunks that end between words."""
    data = (text or "").encode()
    at = 0
    while at < len(data):
        end = at + _CHUNK
        if end < len(data):
            while end < len(data) and not _SPACE[data[end]]:
                end += 1
        yield from _chunk_features(np.frombuffer(b" " + data[at:end] + b" ", np.uint8))
        at = end


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares of all its features."""
    counts = np.zeros(1 << BITS, np.int64)
    for some in features(text):
        counts += np.bincount(some, minlength=1 << BITS)
    buckets = np.flatnonzero(counts)
    return buckets.astype(np.int32), (counts[buckets] / max(1, counts.sum())).astype(np.float32)


class Classifier:
    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.vectors = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (1 << BITS, DIMENSION)).astype(np.float32)
        self.layer = np.zeros((DIMENSION, 2), np.float32)
        self.bias = np.zeros(2, np.float32)

    def train(self, bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, weights: np.ndarray, seed: int = SEED) -> None:
        rng, done = np.random.default_rng(seed), 0
        for _ in range(EPOCHS):
            for i in rng.permutation(len(bags)):
                rate = RATE * (1 - done / (EPOCHS * len(bags))) * weights[i]
                buckets, shares = bags[i]
                mean = shares @ self.vectors[buckets]
                z = mean @ self.layer + self.bias
                wrong = np.exp(z - z.max())
                wrong /= wrong.sum()
                wrong[y[i]] -= 1
                step = (self.layer @ wrong).astype(np.float32)
                self.layer -= rate * np.outer(mean, wrong).astype(np.float32)
                self.bias -= 0.1 * rate * wrong.astype(np.float32)
                # The mean divides a bucket's gradient by the features; the step is scaled back.
                self.vectors[buckets] -= rate * np.sqrt(len(buckets)) * shares[:, None] * step
                done += 1

    def compiled(self) -> tuple[np.ndarray, float]:
        """Per bucket its part of the log-odds, and the log-odds of an empty text."""
        toward = self.layer[:, 1] - self.layer[:, 0]
        return (self.vectors @ toward).astype(np.float32), float(self.bias[1] - self.bias[0])


def score(compiled: tuple[np.ndarray, float], text: str | None) -> float:
    odds, bias = compiled
    total, n = 0.0, 0
    for some in features(text):
        total += float(odds[some].sum(dtype=np.float64))
        n += len(some)
    return float(1 / (1 + np.exp(-np.clip(bias + total / max(1, n), -50, 50))))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [bag(t.as_py()) for t in batch.column(2)]
        columns = [batch.column(0), batch.column(1)]
        columns += [pa.array([f[k].tobytes() for f in found], pa.binary()) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "buckets", "shares"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out: tuple[int, int] = (5, 0)) -> Classifier | None:
    """A classifier from labelled documents outside the held-out fold; None without both classes."""
    n, remainder = held_out
    learned = labels.where(common.crc_mod("doc_id", n) != remainder).where(F.col(label).isin(0, 1))
    sample = materialize(common.class_sample(learned, label, PER_CLASS, SEED), "quality-sample")
    # At most 2 * PER_CLASS narrow rows.
    few = sample.select("doc_id", F.col(label).cast("int").alias("_label"))
    chosen = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").select("doc_id", "_label", "text")
    made = chosen.mapInArrow(_bags, "doc_id long, label int, buckets binary, shares binary")
    one = made.groupBy("doc_id").agg(F.min(F.struct("label", "buckets", "shares")).alias("b")).select("doc_id", "b.*")
    rows = sorted(one.collect(), key=lambda r: r["doc_id"])
    sizes = dict(sample.groupBy(label).agg(F.max("class_size")).collect())
    y = np.array([r["label"] for r in rows], np.int64)
    if len(set(y.tolist())) < 2:
        return None
    bags = [(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["shares"], np.float32)) for r in rows]
    share = np.array([sizes.get(c, 0) / max(1, (y == c).sum()) for c in (0, 1)])
    weights = share[y] / share[y].mean()
    model = Classifier()
    model.train(bags, y, weights)
    return model


def predict_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    NULL and empty texts get the score of a text without features. Labels that are NULL or
    not 0 or 1 are left out; without labels of both classes outside the held-out fold every
    score is 0.5. Rows without id are never learned from. Repeated rows stay; of contradicting
    labels of one id the smaller counts. An empty table gives no rows.
    """
    common.prepare(docs.sparkSession)
    model = train(docs, labels)
    compiled = (np.zeros(1 << BITS, np.float32), 0.0) if model is None else model.compiled()
    shared = docs.sparkSession.sparkContext.broadcast(compiled)  # 512 KB, whatever the corpus

    @F.arrow_udf(T.DoubleType())
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([score(shared.value, t.as_py()) for t in batch], pa.float64())

    out = docs.select("doc_id", common.is_held_out("doc_id", 5, 0).alias("held_out"), scored("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
