"""Hierarchical Pitman-Yor language model over words.

Every word that comes before another one, and the beginning of a text, is a context with a restaurant
of its own. All share one parent, whose own parent is uniform over the known words and one unknown
word. Customers of a context's dish are the word's occurrences there, its tables are customers of the
parent. The number of restaurants grows with the corpus.

1. Words of the training texts are counted. The most frequent ones, as many as a table of bounded size
   holds, get short codes; all others are told apart by their hashes.
2. All texts become chunks of codes, stored by chunk. Pairs of neighbours are counted per chunk and
   dealt by context to parts; contexts with more than a quarter of a part's tokens are dealt by context
   and word. A part is one row of sorted arrays, stored by part; pairs of held-out texts lie there with
   no customers, so that every pair that is scored has its place.
3. Gibbs sweeps redraw the number of tables of every (context, word) from its conditional
   (generalised Stirling numbers; above ``EXACT`` customers from their limit), with the tables
   of the restaurant as they stand. After a sweep the parts send tables per word to the parent, where the
   word's own tables are drawn, and get its customers and tables back. The parts
   themselves stay where they are. Discount and strength of the contexts are the ones under which the
   seating so far is likeliest. Several samples are averaged.
4. Parts send the probabilities of their pairs to the chunks, which sum them per text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import common
from linkloom.session import new_path

END = 0
#: Code of the context at the beginning of a text; codes of words outside the table have the bit RARE.
BEGIN, RARE = np.uint64(1 << 62), np.uint64(1 << 63)
#: Tokens of a chunk and of a part; bytes of text looked at together.
CHUNK_TOKENS, PART_TOKENS, PIECE_BYTES = 1 << 20, 1 << 19, 1 << 20
#: Rounds before samples are kept, samples, customers up to which the conditional is exact.
BURN_IN, SAMPLES, EXACT = 2, 3, 64
STRENGTH, SEED = 1.0, 4
#: Discounts and strengths of contexts that are tried after a round.
DISCOUNTS, STRENGTHS = np.arange(0.05, 0.96, 0.05).round(2), np.geomspace(0.02, 20, 10).round(3)
#: Words with a short code: a table of 24 MB.
TABLE_WORDS = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


# --- tokens ---------------------------------------------------------------------


@lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, np.uint64(base), np.uint64))))


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word; data begins and ends with white space."""
    x = np.frombuffer(data, np.uint8)
    edges = np.flatnonzero(_SPACE[x])
    starts, ends = edges[:-1] + 1, edges[1:]
    some = ends > starts
    starts, ends = starts[some], ends[some]
    room = 1 << max(16, len(x).bit_length())
    terms = (x.astype(np.uint64) + np.uint64(1)) * _powers(int(_BASE), room)[: len(x)]
    sums = np.concatenate(([np.uint64(0)], np.cumsum(terms)))
    h = (sums[ends] - sums[starts]) * _powers(int(_INVERSE), room)[starts]
    return starts, (h ^ (h >> np.uint64(29))) * _INVERSE


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Words of whole texts in pieces of bounded size: text number, hash; and the range of
    texts that end in the piece."""
    waiting, first, size = [], 0, 0

    def flush(last: int):
        data = b" " + b"".join(waiting)
        starts, h = _words(data)
        begins = np.cumsum([1, *map(len, waiting[:-1])])
        return np.searchsorted(begins, starts, "right") - 1 + first, h, first, last

    for n, text in enumerate(texts):
        data = (text or "").encode().lower() + b" "
        if len(data) > PIECE_BYTES:
            if waiting:
                yield flush(n)
            at = 0
            while at < len(data):
                end = min(at + PIECE_BYTES, len(data))
                while end < len(data) and not _SPACE[data[end - 1]]:
                    end += 1
                _, h = _words(b" " + data[at:end])
                yield np.full(len(h), n), h, n, n + (end == len(data))
                at = end
            waiting, first, size = [], n + 1, 0
            continue
        if not waiting:
            first = n
        waiting.append(data)
        size += len(data)
        if size >= PIECE_BYTES:
            yield flush(n + 1)
            waiting, size = [], 0
    if waiting:
        yield flush(len(texts))


def tokens(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, word hash) of every token of whole texts in order, ends included."""
    for owner, h, first, done in _pieces(texts):
        owner = np.concatenate((owner, np.arange(first, done)))
        order = np.argsort(owner, kind="stable")
        yield owner[order], np.concatenate((h, np.full(max(0, done - first), END, np.uint64)))[order]


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, without the bytes that are zero in all of them; codes from BEGIN on follow whole."""
    x = np.ascontiguousarray(x).ravel().view(np.uint64)
    odd = x >= BEGIN
    low = np.where(odd, np.uint64(0), x + np.uint64(1))
    width = (int(low.max()).bit_length() + 7) // 8 if len(low) else 0
    head = np.array([len(x), width], np.int64).tobytes()
    return head + low.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes() + x[odd].tobytes()


def _unplaned(data: bytes, kind: type = np.int64) -> np.ndarray:
    n, width = np.frombuffer(data, np.int64, 2).tolist()
    x = np.zeros((n, 8), np.uint8)
    x[:, :width] = np.frombuffer(data, np.uint8, n * width, 16).reshape(width, n).T
    x = x.view(np.uint64).ravel()
    odd = x == 0
    x -= np.uint64(1)
    x[odd] = np.frombuffer(data[16 + n * width :], np.uint64)
    return x.view(kind)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _BASE
    return (x ^ (x >> np.uint64(29))) * _INVERSE >> np.uint64(20)


# --- words and codes --------------------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the training texts with their counts, chunk by chunk."""

    def summed(held: list) -> Iterator[pa.RecordBatch]:
        w, n = np.unique(np.concatenate(held), return_counts=True)
        whole = pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n)], ["w", "n"])
        yield from (whole.slice(at, 1 << 16) for at in range(0, whole.num_rows, 1 << 16))

    held, n = [], 0
    for batch in batches:
        for _, h in tokens(batch.column(0).to_pylist()):
            held.append(h)
            n += len(h)
            if n >= CHUNK_TOKENS:
                yield from summed(held)
                held, n = [], 0
    if n:
        yield from summed(held)


class Codes:
    """Frequent words with their counts; a word's code is its rank, or its hash if it is not here."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        by_rank = np.lexsort((words, -counts))
        self.counts = counts[by_rank]
        self.words, self.ranks = words[by_rank], np.arange(len(words), dtype=np.uint64)
        order = np.argsort(self.words)
        # One word past the end stops every search; hashes are spread evenly, so their first bits say where to look.
        self.words = np.append(self.words[order], np.uint64((1 << 64) - 1))
        self.ranks = np.append(self.ranks[order], RARE)
        self.bits = max(1, len(words).bit_length())
        self.starts = np.searchsorted(self.words, np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits))
        self.end = self.of(np.array([END], np.uint64))[0]

    def of(self, h: np.ndarray) -> np.ndarray:
        at = self.starts[(h >> np.uint64(64 - self.bits)).astype(np.int64)]
        behind = np.flatnonzero(self.words[at] < h)
        while len(behind):
            at[behind] += 1
            behind = behind[self.words[at[behind]] < h[behind]]
        ranks = self.ranks[at]
        return np.where((self.words[at] == h) & (ranks != RARE), ranks, h | RARE)


def _frequent(words: DataFrame) -> Codes:
    """The words counted ``least`` times or more: as many as the table may hold."""
    size = F.floor(F.log2("n") * 16).cast("int")
    held, least = 0, None
    for row in words.groupBy(size.alias("size")).count().orderBy(F.desc("size")).collect():  # 16 per doubling
        held += row["count"]
        if held > TABLE_WORDS:
            break
        least = int(np.ceil(2 ** (row["size"] / 16)))
    if least is None:
        return Codes(np.empty(0, np.uint64), np.empty(0, np.int64))
    rows = words.where(F.col("n") >= least).toArrow()
    return Codes(rows.column("w").to_numpy().view(np.uint64), rows.column("n").to_numpy())


def _encoded(shared, most: int):
    """Chunks of codes, the code before the first one, and the texts (or parts of texts) within."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, number = shared.value, TaskContext.get().partitionId() << 33
        held, texts, n, before, last = [], [], 0, codes.end, codes.end

        def chunk() -> pa.RecordBatch:
            rows = pa.Table.from_batches(texts).combine_chunks().to_batches()[0].to_struct_array()
            spans = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
            data = pa.array([_planes(np.concatenate(held))], pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), spans, pa.array([int(before)], pa.uint64()).view(pa.int64()), data], ["chunk", "texts", "before", "codes"]
            )

        for batch in batches:
            for owner, h in tokens(batch.column("text").to_pylist()):
                if not len(h):
                    continue
                starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                part = batch.drop_columns("text").take(pa.array(owner[starts]))
                texts.append(part.append_column("n", pa.array(np.diff(np.append(starts, len(h))))))
                held.append(codes.of(h))
                n += len(h)
                last = held[-1][-1]
                if n >= most:
                    yield chunk()
                    held, texts, n, before, number = [], [], 0, last, number + 1
        if n:
            yield chunk()

    return run


# --- pairs by part ------------------------------------------------------------------


class Deal:
    """Where pairs and words belong: parts of pairs, contexts dealt by word as well, shares of the parent."""

    def __init__(self, codes: Codes, parts: int, n_tokens: int):
        # A share answers for some words to all parts: sixteen parts send about as many words as one task holds well.
        self.parts, self.shares, self.end = parts, max(8, parts // 16), codes.end
        busy = np.flatnonzero(codes.counts > max(1, n_tokens // (4 * parts))).astype(np.uint64)
        # The beginning of a text is as frequent as its end.
        self.busy = np.append(busy, BEGIN) if self.end in busy else busy

    def part(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        key = np.where(np.isin(u, self.busy), u * _BASE + w, u)
        return (_mixed(key) % np.uint64(self.parts)).astype(np.int64)

    def share(self, w: np.ndarray) -> np.ndarray:
        return (_mixed(w + np.uint64(1)) % np.uint64(self.shares)).astype(np.int64)


def _pairs(data: bytes, before: int, deal: Deal):
    """Different (part, context, word) of a chunk, sorted, and the number of each token's pair."""
    w = np.concatenate((np.array([before], np.int64).view(np.uint64), _unplaned(data, np.uint64)))
    u = np.where(w[:-1] == deal.end, BEGIN, w[:-1])
    w = w[1:]
    # Numbers of 31 bits in the order of the codes: ranks as they are, then the beginning, then the rare words here.
    rare, size = np.unique(np.append(w[w >= RARE], u[u >= RARE])), 1 << 30
    names = np.append(BEGIN, rare)

    def numbers(x: np.ndarray) -> np.ndarray:
        found = x.astype(np.int64)
        odd = np.flatnonzero(x >= BEGIN)
        found[odd] = size + np.searchsorted(names, x[odd])
        return found

    key, at = np.unique(numbers(u) << 31 | numbers(w), return_inverse=True)

    def codes(x: np.ndarray) -> np.ndarray:
        return np.where(x < size, x, names[np.maximum(x - size, 0)].view(np.int64)).view(np.uint64)

    u, w = codes(key >> 31), codes(key & ((1 << 31) - 1))
    part = deal.part(u, w)
    order = np.argsort(part, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    return part[order], u[order], w[order], place[at]


def _dealt(deal: Deal):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part, u, w, at = _pairs(row["codes"], row["before"], deal)
                learned = np.repeat(row["learned"], row["n"])
                c = np.bincount(at[learned], minlength=len(u))
                cuts = np.append(np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))), len(part))
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(part[a])], pa.int32()), pa.array([row["chunk"]]), *(pa.array([_planes(x[a:b])], pa.binary()) for x in (u, w, c))],
                        ["part", "chunk", "u", "w", "c"],
                    )

    return run


class Part:
    """The cells of a part: contexts, and the context, word and customers of each cell."""

    def __init__(self, row: dict):
        self.part, self.refs = row["part"], row["refs"]
        self.u, lengths = _unplaned(row["u"], np.uint64), _unplaned(row["k"])
        self.context = np.repeat(np.arange(len(self.u)), lengths)
        self.words, self.word = _unplaned(row["words"], np.uint64), _unplaned(row["word"])
        self.c = _unplaned(row["c"])

    def per_context(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.context, x, len(self.u)).astype(np.int64)

    def sent(self, tables: list[np.ndarray], deal: Deal) -> dict:
        """Sums per word for the parent, last the occurrences; sums per context that other parts share."""
        columns = [np.bincount(self.word, x, len(self.words)).astype(np.int64) for x in (*tables, self.c)]
        share = deal.share(self.words)
        order = np.argsort(share, kind="stable")
        cuts = np.append(np.flatnonzero(np.concatenate(([True], np.diff(share[order]) != 0))), len(order))
        messages = [
            {"share": int(share[order[a]]), "w": _planes(self.words[order[a:b]]), "s": _planes(np.concatenate([x[order[a:b]] for x in columns]))}
            for a, b in zip(cuts[:-1], cuts[1:], strict=True)
        ]
        own = [self.per_context(x) for x in (*tables, self.c)]
        busy = [{"u": int(self.u.view(np.int64)[i]), "s": [int(x[i]) for x in own]} for i in np.flatnonzero(np.isin(self.u, deal.busy))]
        return {"sent": messages, "busy": busy}

    def received(self, rows: list[dict], deal: Deal) -> tuple[np.ndarray, np.ndarray]:
        """Customers (last row: occurrences) and tables of the part's words at the parent, per sample."""
        order = np.argsort(deal.share(self.words), kind="stable")
        rows = sorted(rows, key=lambda r: r["share"])
        found = []
        for name in ("rc", "rt"):
            x = np.concatenate([_unplaned(r[name]).reshape(-1, r["m"]) for r in rows], axis=1)
            found.append(np.empty_like(x))
            found[-1][:, order] = x
        return found[0], found[1]


_REFS = pa.list_(pa.struct([("chunk", pa.int64()), ("at", pa.binary())]))
_MESSAGES = [
    ("sent", pa.list_(pa.struct([("share", pa.int32()), ("w", pa.binary()), ("s", pa.binary())]))),
    ("busy", pa.list_(pa.struct([("u", pa.int64()), ("s", pa.list_(pa.int64()))]))),
]
_SENT = "sent array<struct<share:int,w:binary,s:binary>>, busy array<struct<u:long,s:array<long>>>"
_ARRAYS = ("u", "k", "words", "word", "c")
_CELLS = f"part int, {', '.join(f'{x} binary' for x in _ARRAYS)}, refs array<struct<chunk:long,at:binary>>, once long, twice long, {_SENT}"
_CELLS_TYPES = pa.schema([
    ("part", pa.int32()), *[(x, pa.binary()) for x in _ARRAYS], ("refs", _REFS), ("once", pa.int64()), ("twice", pa.int64()), *_MESSAGES,
])


def _merged(deal: Deal):
    """The pairs of one part from all chunks, counts of equal ones added, and where each chunk's pairs are."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        lists = [[_unplaned(r[x], kind) for r in rows] for x, kind in (("u", np.uint64), ("w", np.uint64), ("c", np.int64))]
        sizes = [len(x) for x in lists[0]]
        u, w, c = map(np.concatenate, lists)
        contexts, words = np.unique(u), np.unique(w)
        key = np.searchsorted(contexts, u) << 32 | np.searchsorted(words, w)
        order = np.argsort(key)
        key, c = key[order], c[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.flatnonzero(new)
        place = np.empty_like(order)
        place[order] = np.cumsum(new) - 1
        refs, at = [], 0
        for r, n in zip(rows, sizes, strict=True):
            refs.append({"chunk": r["chunk"], "at": _planes(np.diff(place[at : at + n], prepend=0))})
            at += n
        key, c = key[first], np.add.reduceat(c, first)
        row = {"part": rows[0]["part"], "refs": refs, "once": int((c == 1).sum()), "twice": int((c == 2).sum())}
        row |= {"u": _planes(contexts), "k": _planes(np.bincount(key >> 32)), "words": _planes(words), "word": _planes(key & 0xFFFFFFFF), "c": _planes(c)}
        return pa.Table.from_pylist([row | Part(row).sent([np.minimum(c, 1)], deal)], _CELLS_TYPES)

    return run


# --- seating ------------------------------------------------------------------------


@lru_cache(maxsize=32)
def _stirling(discount: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: [customers, tables]."""
    table = np.full((EXACT + 1, EXACT + 1), -np.inf)
    table[0, 0] = 0.0
    for c in range(EXACT):
        with np.errstate(divide="ignore"):
            stay = table[c, 1:] + np.log(np.maximum(c - discount * np.arange(1, EXACT + 1), 0))
        table[c + 1, 1:] = np.logaddexp(table[c, :-1], stay)
    return table


def draw_tables(c: np.ndarray, mass: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes with ``c`` customers, given the mass with which a new table opens."""
    t = np.minimum(c, 1)
    more = np.flatnonzero((c > 1) & (c <= EXACT))
    more = more[np.argsort(c[more], kind="stable")]
    log_mass = np.log(np.maximum(mass, 1e-300))
    bounds = np.searchsorted(c[more], np.arange(2, EXACT + 2))
    for n in range(2, EXACT + 1):
        some = more[bounds[n - 2] : bounds[n - 1]]
        if len(some):
            z = _stirling(discount)[n, 1 : n + 1] + log_mass[some, None] * np.arange(1, n + 1)
            share = np.cumsum(np.exp(z - z.max(axis=1, keepdims=True)), axis=1)
            t[some] = 1 + (share < rng.random((len(some), 1)) * share[:, -1:]).sum(axis=1).clip(max=n - 1)
    many = np.flatnonzero(c > EXACT)
    if len(many):
        # Tables past the first are Poisson for many customers, with a tail that thins as
        # tables near customers ** discount; its mode solves y + tail = log(mass / discount).
        aim, size, power = np.log(np.maximum(mass[many], 1e-300) / discount), c[many].astype(float), discount / (1 - discount)
        y = np.minimum(aim, np.log(size))
        for _ in range(40):
            tail = (discount * np.exp(y) / size) ** power
            y = y - (y + tail - aim) / (1 + power * tail)
        mean = np.exp(y)
        spread = np.sqrt(mean / (1 + power * tail))
        drawn = np.where(mean < 50, rng.poisson(np.minimum(mean, 50)), np.rint(rng.normal(mean, spread)))
        t[many] = np.clip(1 + drawn, 1, c[many])
    return t


class Parent:
    """Totals of the parent restaurant per sample, the vocabulary, the discounts of both levels (contexts
    first) and the strength of the contexts."""

    def __init__(self, words: int, discounts: tuple[float, float], strength: float, customers: list[int], tables: list[int]):
        self.words, self.discounts, self.strength = words, discounts, strength
        self.customers, self.tables = np.array(customers, float), np.array(tables, float)

    def base(self) -> np.ndarray:
        """Mass of a word that comes from the uniform base, per sample."""
        return (STRENGTH + self.discounts[1] * self.tables) / (self.words + 1)

    def probability(self, c: np.ndarray, t: np.ndarray, s: int = 0, less: np.ndarray | int = 0) -> np.ndarray:
        """Of words with ``c`` customers at ``t`` tables, ``less`` others having left."""
        return (np.maximum(c - self.discounts[1] * t, 0) + self.base()[s]) / (STRENGTH + self.customers[s] - less)


def _seated_above(base: float, discount: float, round_: int):
    """Customers and tables at the parent of the words of one share, for every part that sent some."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        w = [_unplaned(r["w"], np.uint64) for r in rows]
        sums = [_unplaned(r["s"]).reshape(-1, len(x)) for r, x in zip(rows, w, strict=True)]
        names, at = np.unique(np.concatenate(w), return_inverse=True)
        rng = np.random.default_rng([SEED, round_, rows[0]["share"]])
        rc = np.stack([np.bincount(at, x, len(names)).astype(np.int64) for x in np.concatenate(sums, axis=1)])
        rt = np.stack([draw_tables(x, np.full(len(x), base), discount, rng) for x in rc[:-1]])
        found, done = [], 0
        totals = {"customers": rc[:-1].sum(axis=1).tolist(), "tables": rt.sum(axis=1).tolist(), "few": [int((rc[0] == n).sum()) for n in (1, 2)]}
        for r, x in zip(rows, w, strict=True):
            mine = at[done : done + len(x)]
            done += len(x)
            found.append({"part": r["part"], "share": r["share"], "m": len(x), "rc": _planes(rc[:, mine]), "rt": _planes(rt[:, mine]), **totals})
            totals = {}
        return pa.Table.from_pylist(found, _ROOTS_TYPES)

    return run


_ROOTS = "part int, share int, m int, rc binary, rt binary, customers array<long>, tables array<long>, few array<long>"
_ROOTS_TYPES = pa.schema([
    ("part", pa.int32()), ("share", pa.int32()), ("m", pa.int32()), ("rc", pa.binary()), ("rt", pa.binary()),
    ("customers", pa.list_(pa.int64())), ("tables", pa.list_(pa.int64())), ("few", pa.list_(pa.int64())),
])


def _asked(swept: DataFrame, parent: Parent, round_: int, samples: int) -> tuple[DataFrame, list[int], list[int], float]:
    """The parent's answer to what parts sent, stored, its totals per sample, and its discount by counts of counts."""
    sent = swept.select("part", F.explode("sent").alias("m")).select("part", "m.*")
    roots = sent.groupBy("share").applyInArrow(_seated_above(float(parent.base()[0]), parent.discounts[1], round_), _ROOTS)
    roots = common.stored_tightly(roots, "lm-parent")
    sums = [F.sum(F.col(x)[s]) for x in ("customers", "tables") for s in range(samples)]
    found = [int(x or 0) for x in roots.agg(*sums, F.sum(F.col("few")[0]), F.sum(F.col("few")[1])).first()]
    return roots, found[:samples], found[samples:-2], _by_counts(*found[-2:])


def _by_counts(once: int, twice: int) -> float:
    """A discount from how many dishes have one and two customers."""
    return float(np.clip(once / max(1, once + 2 * twice), 0.05, 0.95))


def _shared_contexts(swept: DataFrame) -> dict[int, list[int]]:
    """Sums of the contexts that many parts share: at most four times as many as there are parts."""
    rows = swept.select(F.explode("busy").alias("b")).select("b.*")
    if not rows.take(1):
        return {}
    n = len(rows.first()["s"])
    return {r[0]: list(r[1:]) for r in rows.groupBy("u").agg(*[F.sum(F.col("s")[i]) for i in range(n)]).collect()}


def _others(cells: Part, own: np.ndarray, shared: dict[int, list[int]], column: int) -> np.ndarray:
    """Per context, what the other parts hold of a sum, given this part's own."""
    found = np.zeros(len(cells.u), np.int64)
    for i in np.flatnonzero(np.isin(cells.u.view(np.int64), np.array(list(shared), np.int64))):
        found[i] = shared[int(cells.u.view(np.int64)[i])][column] - own[i]
    return found


def _fit(cells: Part, t: np.ndarray, parent: Parent, deal: Deal) -> list[float]:
    """Log likelihood of a seating for every discount tried, then every strength. Contexts count that are whole
    in the part and give no word more than EXACT customers."""
    inside = ~np.isin(cells.u, deal.busy) & (np.maximum.reduceat(cells.c, np.flatnonzero(np.diff(cells.context, prepend=-1))) <= EXACT)
    some = inside[cells.context] & (cells.c > 0)
    opened, customers = (np.unique(x[inside & (x > 0)], return_counts=True) for x in (cells.per_context(t), cells.per_context(cells.c)))
    seats = np.bincount(cells.c[some] * (EXACT + 1) + t[some], minlength=(EXACT + 1) ** 2).reshape(EXACT + 1, -1)

    def rising(found: tuple[np.ndarray, np.ndarray], strength: float, step: float) -> float:
        if not len(found[0]):
            return 0.0
        sums = np.concatenate(([0.0], np.cumsum(np.log(strength + step * np.arange(1, found[0][-1])))))
        return float(sums[found[0] - 1] @ found[1])

    filled = seats > 0
    d, strength = parent.discounts[0], parent.strength
    by_discount = [rising(opened, strength, x) + float(_stirling(float(x))[filled] @ seats[filled]) for x in DISCOUNTS]
    return by_discount + [rising(opened, x, d) - rising(customers, x, 1.0) for x in STRENGTHS]


def _likeliest(swept: DataFrame, parent: Parent) -> tuple[float, float]:
    n = len(DISCOUNTS) + len(STRENGTHS)
    found = np.array([x or 0.0 for x in swept.agg(*[F.sum(F.col("fit")[i]) for i in range(n)]).first()])
    if not found.any():
        return parent.discounts[0], parent.strength
    return float(DISCOUNTS[found[: len(DISCOUNTS)].argmax()]), float(STRENGTHS[found[len(DISCOUNTS) :].argmax()])


_SWEPT = f"part int, t binary, opened binary, fit array<double>, {_SENT}"
_SWEPT_TYPES = pa.schema([("part", pa.int32()), ("t", pa.binary()), ("opened", pa.binary()), ("fit", pa.list_(pa.float64())), *_MESSAGES])


def _swept(deal: Deal, parent: Parent, shared: dict[int, list[int]], round_: int, samples: int):
    """One sweep per sample over a part. ``t``: tables of the cells, summed over samples; ``opened``:
    those of the contexts, per sample."""
    d = parent.discounts[0]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_pylist([], _SWEPT_TYPES)
        cells, rows = Part(left.to_pylist()[0]), right.to_pylist()
        rc, rt = cells.received([r for r in rows if r["share"] >= 0], deal)
        before = [_unplaned(r["rc"]) for r in rows if r["share"] < 0]
        some = np.flatnonzero(cells.c)
        t = before[0] if before else np.minimum(cells.c, 1)
        left_behind = rc[0][cells.word[some]] - t[some]
        p = parent.probability(left_behind, np.minimum(rt[0][cells.word[some]], left_behind), less=t[some])
        rng = np.random.default_rng([SEED + 1, round_, cells.part])
        others = _others(cells, cells.per_context(t), shared, 0)
        drawn, opened = [], []
        for _ in range(samples):
            mass = parent.strength + d * (others + cells.per_context(t))
            t = np.zeros_like(cells.c)
            t[some] = draw_tables(cells.c[some], mass[cells.context[some]] * p, d, rng)
            drawn.append(t)
            opened.append(cells.per_context(t))
        row = {"part": cells.part, "t": _planes(np.sum(drawn, axis=0)), "opened": _planes(np.concatenate(opened)), "fit": _fit(cells, t, parent, deal) if samples == 1 else None}
        return pa.Table.from_pylist([row | cells.sent(drawn, deal)], _SWEPT_TYPES)

    return run


# --- model and scores ------------------------------------------------------------------


class Model:
    """Parts, the parent's last answer, the last sweep, and what all tasks need to know."""

    def __init__(self, cells, roots, swept, parent: Parent, shared: dict, deal: Deal, tokens: int):
        self.cells, self.roots, self.swept = cells, roots, swept
        self.parent, self.shared, self.deal, self.tokens = parent, shared, deal, tokens


class Tables:
    """Tables of the shared folder that are bucketed by a column, so that joins on it leave them where they are."""

    def __init__(self, spark: SparkSession):
        self.spark, self.names = spark, []

    def store(self, df: DataFrame, column: str) -> DataFrame:
        name = f"linkloom_lm_{uuid.uuid4().hex}"
        self.names.append(name)
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        # Rows are megabytes: small row groups bound what a reader holds.
        options = {"path": new_path(self.spark, "lm"), "compression": "zstd", "parquet.block.size": str(16 << 20)}
        df.write.bucketBy(buckets, column).options(**options).saveAsTable(name)
        return self.spark.table(name)

    def forget(self) -> None:
        """Drop the catalog entries; the files stay in the shared folder."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _right(roots: DataFrame, swept: DataFrame | None) -> DataFrame:
    """What a part gets: the parent's answer and its own last state."""
    rows = roots.select("part", "share", "m", "rc", "rt")
    if swept is None:
        return rows
    return rows.unionByName(swept.select("part", F.lit(-1).alias("share"), F.lit(0).alias("m"), F.col("t").alias("rc"), F.col("opened").alias("rt")))


def chunks(docs: DataFrame, codes: Codes, tables: Tables) -> DataFrame:
    """All texts as codes; ``docs`` has doc_id, held_out, learned, _row_id and text."""
    shared = docs.sparkSession.sparkContext.broadcast(codes)
    kinds = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    schema = f"chunk long, texts array<struct<{kinds},n:long>>, before long, codes binary"
    return tables.store(docs.mapInArrow(_encoded(shared, CHUNK_TOKENS), schema), "chunk")


def train(stored: DataFrame, words: tuple[int, int, int, int], codes: Codes, tables: Tables) -> Model:
    """A model of the learned texts among the chunks. ``words``: tokens, different words, those seen once and twice."""
    n_tokens, n_words, once, twice = words
    total = stored.agg(F.sum(F.aggregate("texts", F.lit(0).cast("long"), lambda a, x: a + x["n"]))).first()[0] or 0
    deal = Deal(codes, max(1, -(-total // PART_TOKENS)), total)
    narrow = stored.select("chunk", "before", "codes", F.col("texts.learned").alias("learned"), F.col("texts.n").alias("n"))
    pairs = narrow.mapInArrow(_dealt(deal), "part int, chunk long, u binary, w binary, c binary")
    cells = tables.store(pairs.groupBy("part").applyInArrow(_merged(deal), _CELLS), "part")
    ones, twos = (int(x or 0) for x in cells.agg(F.sum("once"), F.sum("twice")).first())
    discount, above, strength = _by_counts(ones, twos), _by_counts(once, twice), STRENGTH
    parent = Parent(n_words, (discount, above), strength, [0], [n_words])
    swept, at = None, cells
    for k in range(BURN_IN + 1):
        roots, customers, opened, above = _asked(at, parent, k, 1)
        parent = Parent(n_words, (discount, above), strength, customers, opened)
        run = _swept(deal, parent, _shared_contexts(at), k, SAMPLES if k == BURN_IN else 1)
        swept = common.stored_tightly(cells.groupBy("part").cogroup(_right(roots, swept).groupBy("part")).applyInArrow(run, _SWEPT), "lm-swept")
        at = swept
        if k < BURN_IN:
            discount, strength = _likeliest(swept, parent)
    roots, customers, opened, _ = _asked(swept, parent, BURN_IN + 1, SAMPLES)
    parent = Parent(n_words, parent.discounts, parent.strength, customers, opened)
    return Model(cells, roots, swept, parent, _shared_contexts(swept), deal, n_tokens)


_REPLIES = "chunk long, part int, p binary, n binary"
_REPLY_TYPES = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("p", pa.binary()), ("n", pa.binary())])


def cell_probabilities(cells: Part, rows: list[dict], parent: Parent, shared: dict, deal: Deal) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each cell's word after its context, averaged over samples; occurrences of the word."""
    rc, rt = cells.received([r for r in rows if r["share"] >= 0], deal)
    state = next(r for r in rows if r["share"] < 0)
    d, own = parent.discounts[0], cells.per_context(cells.c)
    opened = _unplaned(state["rt"]).reshape(SAMPLES, -1)
    seated = parent.strength + own + _others(cells, own, shared, SAMPLES)
    p = (cells.c - d * _unplaned(state["rc"]) / SAMPLES) / seated[cells.context]
    for s in range(SAMPLES):
        leave = (parent.strength + d * (opened[s] + _others(cells, opened[s], shared, s))) / seated
        p += leave[cells.context] * parent.probability(rc[s], rt[s], s)[cells.word] / SAMPLES
    return p, rc[-1][cells.word]


def _replied(parent: Parent, shared: dict, deal: Deal):
    """To every chunk: the logarithms of its pairs' probabilities, and occurrences of words outside the table."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_pylist([], _REPLY_TYPES)
        cells = Part(left.to_pylist()[0])
        p, n = cell_probabilities(cells, right.to_pylist(), parent, shared, deal)
        logs, n = np.log10(p).astype(np.float32).view(np.uint32).astype(np.uint64), np.where(cells.words[cells.word] >= RARE, n, 0)
        replies = []
        for ref in cells.refs:
            at = np.cumsum(_unplaned(ref["at"]))
            replies.append({"chunk": ref["chunk"], "part": cells.part, "p": logs[at].astype(np.uint32).tobytes(), "n": _planes(n[at])})
        return pa.Table.from_pylist(replies, _REPLY_TYPES)

    return run


def _summed(shared, deal: Deal, seen: int, n_words: int):
    """Sums over each text of a chunk, from the replies of all parts."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row, replies = left.to_pylist()[0], sorted(right.to_pylist(), key=lambda r: r["part"])
        _, _, w, at = _pairs(row["codes"], row["before"], deal)
        logs = np.concatenate([np.frombuffer(r["p"], np.float32) for r in replies]).astype(float)
        n = np.concatenate([_unplaned(r["n"]) for r in replies])
        known = w < RARE
        n[known] = shared.value.counts[w[known].astype(np.int64)]
        texts = left.column("texts").combine_chunks().flatten()
        starts = np.append(0, np.cumsum(texts.field("n").to_numpy())[:-1])
        base = np.log10((n + 1) / (seen + n_words + 1))
        columns = {f.name: texts.field(f.name) for f in texts.type if f.name != "learned"}
        columns |= {"known": pa.array(np.add.reduceat((n > 0)[at].astype(np.int64), starts))}
        columns |= {name: pa.array(np.add.reduceat(x[at], starts)) for name, x in (("base", base), ("score", logs))}
        return pa.table(columns)

    return run


def score(stored: DataFrame, model: Model, codes: Codes) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    parts = model.cells.groupBy("part").cogroup(_right(model.roots, model.swept).groupBy("part"))
    replies = parts.applyInArrow(_replied(model.parent, model.shared, model.deal), _REPLIES)
    shared = stored.sparkSession.sparkContext.broadcast(codes)
    fields = stored.schema["texts"].dataType.elementType.fields
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields if f.name != "learned") + ", known long, base double, score double"
    of_chunks = stored.groupBy("chunk").cogroup(replies.groupBy("chunk"))
    pieces = of_chunks.applyInArrow(_summed(shared, model.deal, model.tokens, model.parent.words), schema)
    # A very long text lies in several chunks.
    return pieces.groupBy("_row_id").agg(
        F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"),
        F.sum("n").alias("n_tokens"), F.sum("known").alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        F.sum("base").alias("base_score"), F.sum("score").alias("score"),
    ).drop("_row_id")


def counted_words(texts: DataFrame) -> tuple[DataFrame, tuple[int, int, int, int]]:
    """Words of the texts (column ``text``) with counts, stored; tokens, words, words seen once and twice."""
    counted = texts.select("text").mapInArrow(_counted, "w long, n long")
    words = common.stored_tightly(counted.groupBy("w").agg(F.sum("n").alias("n")), "lm-words")
    found = words.agg(F.sum("n"), F.count("*"), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    return words, tuple(int(x or 0) for x in found)


def score_documents(docs: DataFrame) -> DataFrame:
    """Train on the rows outside the held-out fold, score all.

    A NULL text is empty: one token, its end. Rows without id are learned from by no one and are
    not held out. Words and contexts never seen have the probabilities the parent leaves them. Without
    training texts every known count is 0 and all probabilities are 1. Repeated rows stay. Words
    are told apart by 63-bit hashes. An empty table gives no rows. Other columns are not read.
    """
    common.prepare(docs.sparkSession)
    learned = F.coalesce(common.crc_mod("doc_id", 7) != 2, F.lit(False))
    words, counts = counted_words(docs.where(learned))
    codes = _frequent(words)
    rows = docs.select(
        "doc_id", common.is_held_out("doc_id", 7, 2).alias("held_out"), learned.alias("learned"),
        F.monotonically_increasing_id().alias("_row_id"), "text",
    )
    tables = Tables(docs.sparkSession)
    try:
        stored = chunks(rows, codes, tables)
        return common.stored_tightly(score(stored, train(stored, counts, codes, tables), codes), "lm-scores")
    finally:
        tables.forget()
