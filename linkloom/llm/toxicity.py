"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine.

Examples are a bounded sample of labelled documents (``PER_CLASS`` each). Every example is
indexed with all its words. Words weigh more the clearer they are associated with the toxic
class; families of near copies count once in that, so one copied text cannot make its own words look toxic. No
word weighs nothing, so a copy of an example always finds it. Document
frequencies come from all documents. Examples sit in an inverted index in blocks, each term with its
largest weight per block: a block is read only while its bound reaches the k-th best
similarity, so the neighbours are exact. The most frequent terms, which every block has, are whole columns
instead and are multiplied for many documents at once. Votes weigh by a power of similarity and by the share of their class, and
are calibrated on the examples themselves, each scored without itself.

Words are told apart by 64-bit numbers, which are made and looked up for a whole batch of texts at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm import byte_words, common
from linkloom.session import materialize

#: Labelled documents of a class that may be examples, and different words that all examples together may have.
PER_CLASS, SEED = 1500, 9
MAX_CELLS = 8_000_000
NEIGHBOURS, BLOCK, THRESHOLD = 10, 64, 0.5
#: Association (chi-square of one degree) and lift from which a term has its full weight, and the part of it that any term has.
ASSOCIATION, LIFT, LEAST_PART = 25.0, 4.0, 0.01
#: Near copies agree in all least hashes of one of the bands.
BANDS, BAND_ROWS = 8, 8
#: Vote that speaks for the overall share, in votes of the lightest example; power of the similarity in a vote.
PRIOR_VOTE, SHARPNESS = 0.05, 4
#: Blocks that are read before others are ruled out; most frequent terms, held as whole columns, and the least part of examples with one.
FIRST_BLOCKS, COLUMNS, COLUMN_PART = 4, 1024, 1 / 16
_ROWS = 1 << 16


def words(text: str | None) -> list[str]:
    """The words of one text, as they are counted."""
    found = byte_words.words_of(pa.array([text], pa.string()))
    return [found.buffer[a:b].tobytes().decode() for a, b in zip(found.starts, found.ends, strict=True)]


def cells_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, word number and count of every different word of every text, by text and number."""
    found = byte_words.words_of(texts)
    numbers = byte_words.hash64(found)
    order = np.lexsort((numbers, found.rows))
    rows, numbers = found.rows[order], numbers[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (numbers[1:] != numbers[:-1])
    first = np.flatnonzero(new)
    return rows[first], numbers[first], np.diff(np.append(first, len(rows)))


class Vocabulary:
    """Terms are places in the sorted numbers of the words of all examples."""

    def __init__(self, numbers: np.ndarray):
        self.numbers = numbers

    def known(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which numbers are terms, and those terms."""
        if not len(self.numbers):
            return np.zeros(len(numbers), bool), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.numbers, numbers), len(self.numbers) - 1)
        here = self.numbers[at] == numbers
        return here, at[here]

    def bags(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Terms and counts of every text."""
        rows, numbers, counts = cells_of(texts)
        here, terms = self.known(numbers)
        edges = np.searchsorted(rows[here], np.arange(len(texts) + 1))
        counts = counts[here].astype(float)
        return [(terms[a:b], counts[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def families(bags: list) -> np.ndarray:
    """Number of the family of near copies of each bag of words or word numbers: bags that agree in all least
    hashes of a band, in any of the bands, are together."""
    parent = np.arange(len(bags))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    odd = np.random.default_rng(SEED).integers(1 << 62, size=BANDS * BAND_ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    first: dict[tuple, int] = {}
    for i, bag in enumerate(bags):
        if len(bag):
            hashes = np.array([zlib.crc32(w.encode()) if isinstance(w, str) else w & 0xFFFFFFFF for w in bag], np.uint64)
            least = np.full(BANDS * BAND_ROWS, ~np.uint64(0))
            for at in range(0, len(hashes), _ROWS):
                least = np.minimum(least, ((hashes[at : at + _ROWS, None] * odd) >> np.uint64(16)).min(axis=0))
            for band, values in enumerate(least.reshape(BANDS, BAND_ROWS).tolist()):
                parent[root(i)] = root(first.setdefault((band, *values), i))
    return np.array([root(i) for i in range(len(bags))])


def parts(n_terms: int, rows: np.ndarray, of: np.ndarray, family: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Part of its weight that each term has, from the cells (``rows``, term number ``of``) of all
    examples: rising to one with its association with class 1, families counted once per class.
    Of terms in the same families one stands for all."""
    places, place = np.unique(family * 2 + y, return_inverse=True)
    toxic = places % 2
    n1, n0 = int(toxic.sum()), int((1 - toxic).sum())
    part = np.full(n_terms, LEAST_PART)
    if not n0 or not n1:
        return part
    cells = np.unique(of.astype(np.int64) * len(places) + place[rows])
    at, where = cells // len(places), cells % len(places)
    seen = np.bincount(at, minlength=n_terms).astype(float)
    has = np.bincount(at, toxic[where], n_terms)
    expected = n1 * seen / (n0 + n1)
    spread = expected * (n0 / (n0 + n1)) * (1 - seen / (n0 + n1))
    strength = np.where(spread > 0, (has - expected) ** 2 / np.maximum(spread, 1e-300), 0.0)
    lift = (has + 0.5) * n0 / ((seen - has + 0.5) * n1)
    wanted = np.where(lift >= LIFT, np.minimum(strength / ASSOCIATION, 1.0) ** 2, 0.0)
    key = np.zeros(n_terms, np.uint64)
    np.add.at(key, at, np.random.default_rng(SEED).integers(1 << 63, size=len(places)).astype(np.uint64)[where])
    strong = np.flatnonzero(wanted > LEAST_PART)
    _, stands = np.unique(key[strong], return_index=True)
    part[strong[stands]] = wanted[strong[stands]]
    return part


def weights(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of one document, of length one; ``idf`` has the parts of the terms in it."""
    w = (1 + np.log(counts)) * idf[terms]
    return w / np.sqrt((w * w).sum())


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class BlockMaxIndex:
    """Unit vectors of examples by term, in blocks with the largest weight of each term."""

    def __init__(self, ids: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, vote: np.ndarray, n_terms: int):
        self.ids, self.y, self.vote = ids, y, vote
        self.n_blocks = -(-len(ids) // BLOCK)
        terms = np.concatenate([t for t, _ in vectors]) if vectors else np.empty(0, np.int64)
        rows = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(t) for t, _ in vectors])
        # Frequent terms: one column each, in the number of the term's column.
        often = np.bincount(terms, minlength=n_terms)
        held = np.argsort(-often, kind="stable")[:COLUMNS]
        held = held[often[held] >= max(1, COLUMN_PART * len(ids))]
        self.column = np.full(n_terms, -1, np.int32)
        self.column[held] = np.arange(len(held))
        weight = np.concatenate([w for _, w in vectors]) if vectors else np.empty(0)
        of = self.column[terms]
        self.columns = np.zeros((len(held), len(ids)))
        self.columns[of[of >= 0], rows[of >= 0]] = weight[of >= 0]
        terms, rows, weight = terms[of < 0], rows[of < 0], weight[of < 0]
        order = np.argsort(terms, kind="stable")  # rows ascend within a term
        terms, self.rows = terms[order], rows[order]
        self.values = weight[order]
        # A cell is a term in a block; cells of a term and entries of a cell lie together.
        key = terms * max(1, self.n_blocks) + self.rows // BLOCK
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
        self.starts = np.append(first, len(key)).astype(np.int32)
        self.blocks = (self.rows[first] // BLOCK).astype(np.int32)
        self.largest = np.maximum.reduceat(self.values, first) if len(first) else np.empty(0)
        self.cells = np.searchsorted(terms[first], np.arange(n_terms + 1)).astype(np.int32)

    def column_sums(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the frequent terms add to the cosines of some documents with all examples."""
        wanted = np.zeros((len(vectors), len(self.columns)))
        for row, (terms, w) in zip(wanted, vectors, strict=True):
            of = self.column[terms]
            row[of[of >= 0]] = w[of >= 0]
        return wanted @ self.columns

    def search(self, terms: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS, skip: int = -1, sums: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the k nearest examples with a common term, and their cosines; ties go
        to the earlier row. ``skip`` leaves one row out; ``sums`` is its row of ``column_sums``."""
        sums = self.column_sums([(terms, w)])[0] if sums is None else sums
        rare = self.column[terms] < 0
        terms, w = terms[rare], w[rare]
        n_cells = self.cells[terms + 1] - self.cells[terms]
        starts = self.starts[self.cells[terms]]
        lengths = self.starts[self.cells[terms + 1]] - starts
        if lengths.sum() <= 2 * n_cells.sum():  # bounds would cost as much as the lists themselves
            return self._best(sums + self._read(starts, lengths, w), k, skip)
        cells, x = _ranges(self.cells[terms], n_cells), np.repeat(w, n_cells)
        blocks = self.blocks[cells]
        bounds = np.bincount(blocks, self.largest[cells] * x, self.n_blocks) + np.maximum.reduceat(sums, np.arange(0, len(sums), BLOCK))
        order = np.argsort(-bounds, kind="stable")
        rows, found = np.empty(0, np.int64), np.empty(0)
        for wave in (order[:FIRST_BLOCKS], order[FIRST_BLOCKS:]):
            reached = bounds[wave] > 0
            if len(rows) == k:
                reached &= bounds[wave] >= found[-1] - 1e-12
            read = np.zeros(self.n_blocks, bool)
            read[wave[reached]] = True
            if not read.any():
                break
            some = read[blocks]
            starts = self.starts[cells[some]]
            got = self._read(starts, self.starts[cells[some] + 1] - starts, x[some])
            at, got = self._best(got + np.where(np.repeat(read, BLOCK)[: len(sums)], sums, 0.0), k, skip)
            rows, found = np.concatenate((rows, at)), np.concatenate((found, got))
            best = np.lexsort((rows, -np.round(found, 12)))[:k]
            rows, found = rows[best], found[best]
        return rows, found

    def _read(self, starts: np.ndarray, lengths: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Sums over ranges of entries, each range times its ``x``."""
        entries = _ranges(starts, lengths)
        return np.bincount(self.rows[entries], self.values[entries] * np.repeat(x, lengths), len(self.ids))

    @staticmethod
    def _best(sums: np.ndarray, k: int, skip: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.flatnonzero(sums)
        if len(rows) > 4 * k:  # none below the k-th best, one left out, can be among the nearest
            rows = rows[sums[rows] >= np.partition(sums[rows], -k - 1)[-k - 1] - 1e-11]
        rows = rows[rows != skip]
        best = np.lexsort((rows, -np.round(sums[rows], 12)))[:k]
        return rows[best], sums[rows[best]]


class ToxicityModel:
    def __init__(self, vocabulary: Vocabulary, idf: np.ndarray, index: BlockMaxIndex | None, share: float, bare: float = 0.0, slope: float = 1.0, offset: float = 0.0):
        self.vocabulary = vocabulary
        self.idf, self.index, self.share, self.bare, self.slope, self.offset = idf, index, share, bare, slope, offset

    def votes(self, texts: list[tuple[np.ndarray, np.ndarray]], skips: list[int] | None = None) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """Log-odds of the weighted votes, and the rows and similarities that voted, of each text."""
        vectors = [(t, weights(t, c, self.idf) if len(t) else c) for t, c in texts]
        for at in range(0, len(texts), common.BATCH_ROWS):
            some = vectors[at : at + common.BATCH_ROWS]
            sums = [None] * len(some) if self.index is None else self.index.column_sums(some)
            for n, (terms, w) in enumerate(some):
                yield self._vote(terms, w, -1 if skips is None else skips[at + n], sums[n])

    def _vote(self, terms: np.ndarray, w: np.ndarray, skip: int, sums: np.ndarray | None) -> tuple[float, np.ndarray, np.ndarray]:
        rows, sims = np.empty(0, np.int64), np.empty(0)
        p = self.bare
        if len(terms) and self.index is not None:
            rows, sims = self.index.search(terms, w, skip=skip, sums=sums)
            power = sims**SHARPNESS * self.index.vote[rows]
            prior = PRIOR_VOTE * self.index.vote.min()
            p = ((power * self.index.y[rows]).sum() + prior * self.share) / (power.sum() + prior)
        p = min(max(p, 1e-6), 1 - 1e-6)
        return float(np.log(p / (1 - p))), rows, sims

    def score(self, odds: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * odds + self.offset, -50, 50))))

    def calibrate(self, odds: np.ndarray, y: np.ndarray, vote: np.ndarray) -> None:
        """Logistic regression of the labels on the log-odds, by Newton steps."""
        x = np.stack([odds, np.ones(len(odds))], 1)
        beta = np.array([1.0, 0.0])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            gradient = x.T @ (vote * (y - p)) - (beta - [1.0, 0.0])  # prior: the odds as they are
            beta = beta + np.linalg.solve((x * (vote * p * (1 - p))[:, None]).T @ x + np.eye(2), gradient)
        if np.isfinite(beta).all() and beta[0] > 0:
            self.slope, self.offset = float(beta[0]), float(beta[1])


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, numbers, counts = cells_of(batch.column(2))
        edges = pa.array(np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32))
        bags = [pa.ListArray.from_arrays(edges, pa.array(x)) for x in (numbers, counts.astype(np.int32))]
        n = pa.array(np.diff(edges.to_numpy()).astype(np.int64))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], n, *bags], ["doc_id", "label", "n", "bag", "counts"])


def _frequencies(vocabulary):
    """Documents with each term, counted per partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        found = np.zeros(len(vocabulary.value.numbers), np.int64)
        for batch in batches:
            n += batch.num_rows
            _, terms = vocabulary.value.known(cells_of(batch.column(0))[1])
            found += np.bincount(terms, minlength=len(found))
        some = np.flatnonzero(found)
        # Term -1 counts the documents.
        for at in range(-1, len(some), _ROWS):
            part = some[max(at, 0) : at + _ROWS]
            terms, counts = (np.append(part, -1), np.append(found[part], n)) if at < 0 else (part, found[part])
            yield pa.RecordBatch.from_arrays([pa.array(terms.astype(np.int32)), pa.array(counts)], ["term", "n"])

    return run


def _examples(bags: DataFrame) -> pa.Table:
    """The bags to learn from: all, or as many whole ones, in seeded order and as many of each class, as have
    ``MAX_CELLS`` cells in all. The driver holds 12 bytes a cell."""
    sizes = bags.select("doc_id", "label", "n").toPandas()  # at most 2 * PER_CLASS narrow rows
    sizes["order"] = [zlib.crc32(f"{SEED}:{d}".encode()) for d in sizes.doc_id]
    sizes["nth"] = sizes.sort_values(["order", "doc_id"]).groupby("label").cumcount()
    sizes = sizes.sort_values(["nth", "label"])
    taken = sizes[sizes.n.cumsum() <= MAX_CELLS]
    few = bags.sparkSession.createDataFrame([(int(d),) for d in taken.doc_id], "doc_id long")
    return bags.join(F.broadcast(few), "doc_id").select("doc_id", "label", "bag", "counts").toArrow().sort_by("doc_id").combine_chunks()


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", held_out: tuple[int, int] = (5, 0)) -> ToxicityModel:
    n, remainder = held_out
    learned = labels.where(common.crc_mod("doc_id", n) != remainder).where(F.col(label).isin(0, 1))
    sample = materialize(common.class_sample(learned, label, PER_CLASS, SEED), "toxic-sample")
    few = sample.select("doc_id", F.col(label).cast("int").alias("_label"))
    # At most 2 * PER_CLASS narrow rows.
    chosen = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").select("doc_id", "_label", "text")
    bags = chosen.mapInArrow(_bags, "doc_id long, label int, n long, bag array<long>, counts array<int>")
    one = bags.groupBy("doc_id").agg(F.min(F.struct("label", "n", "bag", "counts")).alias("b")).select("doc_id", "b.*")
    rows = _examples(materialize(one, "toxic-bags"))
    vocabulary = Vocabulary(np.empty(0, np.int64))
    if not rows.num_rows:
        return ToxicityModel(vocabulary, np.empty(0), None, 0.0)
    y = rows["label"].to_numpy().astype(np.int64)
    bag, counts = (rows[c].combine_chunks() for c in ("bag", "counts"))
    edges = bag.offsets.to_numpy()
    numbers, times = bag.values.to_numpy(), counts.values.to_numpy().astype(float)
    vocabulary = Vocabulary(np.unique(numbers[edges[0] : edges[-1]]))
    terms = np.searchsorted(vocabulary.numbers, numbers)
    bare = [(terms[a:b], times[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    family = families([numbers[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)])
    cells = np.repeat(np.arange(len(bare)), np.diff(edges))
    n_terms = len(vocabulary.numbers)
    part = parts(n_terms, cells, np.concatenate([t for t, _ in bare]), family, y)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    counted = docs.select("text").mapInArrow(_frequencies(shared), "term int, n long")
    df, n_docs = np.zeros(n_terms), 0
    found = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # one row per term
    of, n_of = found["term"].to_numpy(), found["n"].to_numpy()
    df[of[of >= 0]], n_docs = n_of[of >= 0], int(n_of[of < 0].sum())
    idf = (np.log((1 + n_docs) / (1 + df)) + 1) * part
    sizes = dict(sample.groupBy(label).agg(F.max("class_size")).collect())
    vote = np.array([sizes.get(c, 0) / max(1, (y == c).sum()) for c in (0, 1)])[y]
    vote = vote / vote.mean()
    share = float((vote * y).sum() / vote.sum())
    known = [i for i, (terms, _) in enumerate(bare) if len(terms)]
    index = None
    if known:
        made = [(bare[i][0], weights(*bare[i], idf)) for i in known]
        index = BlockMaxIndex(rows["doc_id"].to_numpy()[known], made, y[known], vote[known], n_terms)
    # What the examples without a word say is the share of texts without one.
    silent = np.setdiff1d(np.arange(len(bare)), known)
    said = float((vote[silent] * y[silent]).sum() / vote[silent].sum()) if len(silent) else share
    model = ToxicityModel(vocabulary, idf, index, share, said)
    if len(set(y.tolist())) == 2:
        place = {i: n for n, i in enumerate(known)}
        odds = np.array([odds for odds, *_ in model.votes(bare, [place.get(i, -1) for i in range(len(bare))])])
        model.calibrate(odds, y, vote)
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence for every row of ``docs``; evidence lists
    the nearest examples (doc_id, similarity, toxic), nearest first.

    NULL and empty texts, and texts without a word of any example, get the share of toxic examples that
    have no words. Labels that are NULL or not 0 or 1 are left out; without labels outside
    the held-out fold every score is 0. Rows without id are never learned from. Repeated rows stay; of
    contradicting labels of one id the smaller counts. An empty table gives no rows.
    """
    common.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores, evidence = [], []
            for odds, rows, sims in model.votes(model.vocabulary.bags(batch.column(1))):
                scores.append(model.score(odds) if model.index is not None or model.share else 0.0)
                evidence.append(
                    [{"doc_id": int(model.index.ids[r]), "similarity": float(s), "toxic": int(model.index.y[r])} for r, s in zip(rows, sims, strict=True)]
                )
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(evidence, kind)], ["doc_id", "score", "evidence"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, evidence array<struct<doc_id:long,similarity:double,toxic:int>>"
    scored = docs.select("doc_id", "text").mapInArrow(run, schema)
    return scored.select(
        "doc_id", common.is_held_out("doc_id", 5, 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence",
    )
