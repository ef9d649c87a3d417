"""Language identification with a small convolutional network over bytes.

Filters of several widths run over a window of bytes, the largest response of each
filter goes to a softmax layer. The network is trained in numpy on the driver from
windows of a bounded sample of labelled documents (``PER_LANGUAGE`` each) and
applied to every window of every text, in batches; a document's probabilities are the mean of its
windows', weighted by their bytes.
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

WINDOW, WIDTHS, FILTERS = 128, (2, 3, 4), 8
#: Documents of a language and windows of a document that training sees at most.
PER_LANGUAGE, WINDOWS_EACH, SEED = 600, 3, 7
EPOCHS, BATCH, RATE = 8, 64, 0.01
#: Windows scored at a time: keeps the responses within the cache.
_BLOCK = 64
UNDETERMINED, LEAST_SCORE = "und", 0.3


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole texts as consecutive windows (the last one padded with zero bytes): the
    windows, the text each belongs to, and its bytes."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts], np.int64)
    joined = b"".join(t.ljust(n * WINDOW, b"\0") for t, n in zip(texts, counts.tolist(), strict=True))
    owner = np.repeat(np.arange(len(texts)), counts)
    sizes = np.full(len(owner), WINDOW)
    some = counts > 0
    sizes[np.cumsum(counts)[some] - 1] = [len(t) - (n - 1) * WINDOW for t, n in zip(texts, counts.tolist(), strict=True) if n]
    return np.frombuffer(joined, np.uint8).reshape(-1, WINDOW), owner, sizes


class ByteNetwork:
    """Tables instead of weights times one-hot bytes: ``tables[w][k][byte]`` is what the
    byte at offset k adds to the responses of the filters of width w."""

    def __init__(self, labels: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.tables = {w: rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(labels))).astype(np.float32)
        self.bias = np.zeros(len(labels), np.float32)

    def _respond(self, x: np.ndarray, pairs: np.ndarray, width: int) -> np.ndarray:
        """Largest response of each filter; two bytes per table read."""
        last = x.shape[1] - width + 1
        total = None
        for k in range(0, width, 2):
            if k + 1 < width:
                part = np.take(self._pairs(width, k), pairs[:, k : k + last], axis=0, mode="clip")
            else:
                part = np.take(self.tables[width][k], x[:, k : k + last], axis=0, mode="clip")
            total = part if total is None else np.add(total, part, out=total)
        return total.max(axis=1)

    def _pairs(self, width: int, k: int) -> np.ndarray:
        cached = self.__dict__.setdefault("_pair_tables", {})
        if (width, k) not in cached:
            a, b = self.tables[width][k], self.tables[width][k + 1]
            cached[width, k] = (a[:, None, :] + b[None, :, :]).reshape(-1, FILTERS)
        return cached[width, k]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.labels)), np.float32)
        for at in range(0, len(x), _BLOCK):
            block = x[at : at + _BLOCK].astype(np.intp)
            pairs = block[:, :-1] * 256 + block[:, 1:]
            pooled = np.concatenate([self._respond(block, pairs, w) for w in WIDTHS], axis=1)
            out[at : at + _BLOCK] = softmax(np.maximum(pooled, 0) @ self.out + self.bias)
        return out

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> None:
        """Cross entropy by mini-batches with adaptive steps; only the position of a filter's
        largest response has a gradient."""
        rng = np.random.default_rng(seed)
        weights = [*self.tables.values(), self.out, self.bias]
        first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                rows = order[at : at + BATCH]
                gradients = self._gradients(x[rows], y[rows])
                step += 1
                for w, g, m, v in zip(weights, gradients, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                self.__dict__.pop("_pair_tables", None)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        n = len(x)
        responses = []
        for w in WIDTHS:
            last = x.shape[1] - w + 1
            responses.append(sum(self.tables[w][k][x[:, k : k + last]] for k in range(w)))
        at = [r.argmax(axis=1) for r in responses]
        pooled = np.concatenate([np.take_along_axis(r, a[:, None], 1)[:, 0] for r, a in zip(responses, at, strict=True)], 1)
        active = np.maximum(pooled, 0)
        wrong = softmax(active @ self.out + self.bias)
        wrong[np.arange(n), y] -= 1
        wrong /= n
        back = (wrong @ self.out.T) * (pooled > 0)
        found = []
        for j, w in enumerate(WIDTHS):
            g = np.zeros_like(self.tables[w])
            part = back[:, j * FILTERS : (j + 1) * FILTERS]
            filters = np.broadcast_to(np.arange(FILTERS), part.shape)
            for k in range(w):
                np.add.at(g[k], (np.take_along_axis(x, at[j] + k, 1), filters), part)
            found.append(g)
        return [*found, active.T @ wrong, wrong.sum(axis=0)]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def prepared(text: str) -> bytes:
    return text.encode().lower()


def _training_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some windows of each document, and a short piece of one, so that short texts are known too."""
    for batch in batches:
        langs, found = [], []
        for doc_id, lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = prepared(text)
            rng = np.random.default_rng([SEED, doc_id & 0xFFFFFFFF])
            for n in range(WINDOWS_EACH):
                start = int(rng.integers(0, max(1, len(data) - WINDOW + 1)))
                piece = data[start : start + (int(rng.integers(8, 64)) if n == WINDOWS_EACH - 1 else WINDOW)]
                langs.append(lang)
                found.append(piece.ljust(WINDOW, b"\0"))
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary())], ["lang", "piece"])


def train(docs: DataFrame, held_out: tuple[int, int] = (4, 2)) -> ByteNetwork | None:
    """A network from the labelled documents outside the held-out fold; None without any."""
    n, remainder = held_out
    labelled = docs.where(common.crc_mod("doc_id", n) != remainder).where("lang is not null and text is not null")
    sample = materialize(common.class_sample(labelled, "lang", PER_LANGUAGE, SEED), "lang-sample")
    # At most PER_LANGUAGE narrow rows per language.
    chosen = labelled.select("doc_id", "text").join(F.broadcast(sample.select("doc_id", "lang")), "doc_id")
    pieces = chosen.select("doc_id", "lang", "text").mapInArrow(_training_windows, "lang string, piece binary")
    rows = sorted((r["lang"], bytes(r["piece"])) for r in pieces.collect())
    if not rows:
        return None
    labels = sorted({lang for lang, _ in rows})
    network = ByteNetwork(labels)
    x = np.frombuffer(b"".join(p for _, p in rows), np.uint8).reshape(-1, WINDOW)
    network.train(x, np.array([labels.index(lang) for lang, _ in rows]))
    return network


def languages(network: ByteNetwork | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and its probability for whole texts; without a letter: ``und`` and 0."""
    known = [t is not None and any(map(str.isalpha, t)) for t in texts]
    named, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if network is None or not any(known):
        return named, scores
    x, owner, sizes = windows_of([prepared(t) if k else b"" for t, k in zip(texts, known, strict=True)])
    weighted = network.probabilities(x) * sizes[:, None]
    sums = np.zeros((len(texts), len(network.labels)))
    np.add.at(sums, owner, weighted)
    for i in np.flatnonzero(known):
        p = sums[i] / sums[i].sum()
        best = int(p.argmax())
        named[i], scores[i] = network.labels[best], float(min(1.0, p[best]))
    return named, scores


def predictor(network: ByteNetwork | None):
    """Column function: text -> struct(lang_pred, score)."""
    schema = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.arrow_udf(schema)
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            named, scores = languages(network, batch.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(named, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return predict


def predict_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``.

    NULL texts and texts without a letter give ``und`` with score 0; so does every text when no
    labelled document is outside the held-out fold. Rows without id are never learned
    from and not held out. Repeated rows stay. An empty table gives no rows.
    """
    common.prepare(docs.sparkSession)
    predict = predictor(train(docs))
    scored = docs.select("doc_id", common.is_held_out("doc_id", 4, 2).alias("held_out"), predict("text").alias("_p"))
    return scored.select("doc_id", "held_out", "_p.lang_pred", "_p.score")


def keep_identified(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """Rows of ``docs`` whose text is in some language; all columns unchanged.

    Rejected are NULL texts, texts without a letter, and texts in which the network gives no language
    ``least_score``. Without labelled documents only the first two are rejected.
    """
    common.prepare(docs.sparkSession)
    network = train(docs)
    if network is None:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    # A text without a letter has score 0.
    return docs.where(predictor(network)("text")["score"] >= least_score)
