"""Personal data in texts, and the words that would give it away once it is masked.

Spans of four fixed kinds are found by their patterns. Each distinct value (an address, a number) is
a protected entity. How strongly a term reveals an entity is estimated from co-occurrence in the whole corpus: the
pointwise mutual information of the term and the entity, against the information
content of the entity itself. Of the documents that mention an entity, a term that discloses at least ``DISCLOSURE``
of that content is generalised to its stem, if the stem discloses less, or removed.

A term is estimated once it stands near the entity beside ``MIN_CONTEXTS`` different
neighbours on either side, so one passage that is copied is no evidence. Terms are counted in all documents; a bitmap
of fixed size rules out most other words before anything is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm import byte_words, common
from linkloom.session import materialize

#: Kinds of base spans in their order; the method adds the last two.
KINDS = ("email", "ip", "card", "phone")
ADDED = ("generalised", "removed")
#: Words on each side of a mention that are near it; words that tell contexts apart; least number of contexts.
WINDOW, NEIGHBOURS, MIN_CONTEXTS = 8, 2, 3
#: Part of an entity's information content from which a term discloses it.
DISCLOSURE = 0.9
#: Characters of a stem, and of the shortest word that has one.
STEM, STEMMED = 3, 5
#: Bits of the table that rules words out (its set bits come to the driver), and terms a task counts before it hands them on.
BITS, HELD_TERMS = 1 << 22, 1 << 20

# The patterns of the kinds, with possessive runs where nothing has to be given back.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]")

_ROW = "_pii_row"
_SPAN = "array<struct<kind:int,start:int,end:int>>"
Span = tuple[int, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ with a domain behind it back over the characters of a name, but not into the match before."""
    floor = 0
    for m in _DOMAIN.finditer(text):
        begin = max(floor, text.rfind("@", floor, m.start()) + 1)
        name = text[begin : m.start()]
        kept = len(name.rstrip(_LOCAL))
        if kept < len(name):
            yield begin + kept, m.end()
            floor = m.end()


def _is_ip(found: str) -> bool:
    parts = [p.lstrip("0") or "0" for p in found.split(".")]
    return all(len(p) <= 3 and int(p) <= 255 for p in parts)


def _is_card(found: str) -> bool:
    digits = [int(d) for d in _DIGITS.findall(found)] if len(found) <= 40 else []
    if not 13 <= len(digits) <= 19:
        return False
    twice = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[::-2]) + sum(twice)) % 10 == 0


def _is_phone(found: str) -> bool:
    return 9 <= len(_DIGITS.findall(found)) <= 15


_TESTS: tuple[tuple[int, re.Pattern, Callable[[str], bool]], ...] = ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone))


def base_spans(text: str | None) -> list[Span]:
    """(kind number, start, end) in code points, by kind and start."""
    text = text or ""
    spans = [(0, a, b) for a, b in _emails(text)]
    for kind, pattern, holds in _TESTS:
        spans += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if holds(m[0])]
    return spans


def value_of(kind: int, found: str) -> str:
    """What two mentions of one entity have in common: lower case, or the digits."""
    if kind == 0:
        return f"{KINDS[kind]}:{found.lower()}"
    return f"{KINDS[kind]}:{found if kind == 1 else ''.join(_DIGITS.findall(found))}"


def number_of(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little", signed=True)


class Terms:
    """Words of a column of texts: their numbers, the numbers of their stems (0 if they
    have none), and their places in code points."""

    def __init__(self, texts: pa.Array):
        w = self.words = byte_words.words_of(texts)
        lead = (w.buffer & 0xC0) != 0x80  # first byte of a character
        at = np.concatenate((np.cumsum(lead), [lead.sum() + 1]))  # characters up to and with this byte
        first, after = at[w.starts] - 1, at[w.ends - 1]
        begins = np.flatnonzero(lead)
        self.rows, base = w.rows, np.concatenate(([0], np.cumsum(lead)))[w.offsets]
        self.starts, self.ends = first - base[w.rows], after - base[w.rows]
        self.numbers = byte_words.hash64(w)
        long = np.flatnonzero(after - first >= STEMMED)
        stem_ends = begins[first[long] + STEM]
        stems = byte_words.Words(w.buffer, w.offsets, w.rows[long], w.starts[long], stem_ends)
        self.stems = np.zeros(len(self.numbers), np.int64)
        self.stems[long] = ~byte_words.hash64(stems)
        self.edges = np.searchsorted(self.rows, np.arange(len(texts) + 1))

    def outside(self, row: int, spans: list[Span]) -> np.ndarray:
        """Words of a text that no span touches."""
        some = np.arange(self.edges[row], self.edges[row + 1])
        starts, ends = self.starts[some], self.ends[some]
        free = np.ones(len(some), bool)
        for _, begin, end in spans:
            free[np.searchsorted(ends, begin, "right") : np.searchsorted(starts, end, "left")] = False
        return some[free]


def _near(terms: Terms, row: int, text: str, spans: list[Span]) -> list[tuple[int, int, int, int, int]]:
    """(entity, term, stem, left, right) once per entity and term near any of its mentions, stems as
    terms too; left and right tell the neighbours of its first mention."""
    free = terms.outside(row, spans)
    starts, ends = terms.starts[free].tolist(), terms.ends[free].tolist()
    numbers, stems = terms.numbers[free].tolist(), terms.stems[free].tolist()
    first: dict[int, tuple[int, int]] = {}
    found: dict[tuple[int, int], int] = {}
    for kind, begin, end in sorted(spans, key=lambda s: s[1]):
        entity = number_of(value_of(kind, text[begin:end]))
        left, right = bisect_right(ends, begin), bisect_left(starts, end)
        if entity not in first:
            sides = numbers[max(0, left - NEIGHBOURS) : left], numbers[right : right + NEIGHBOURS]
            first[entity] = tuple(number_of(repr(s)) for s in sides)
        for i in (*range(max(0, left - WINDOW), left), *range(right, min(len(numbers), right + WINDOW))):
            found[entity, numbers[i]] = stems[i]
            if stems[i]:
                found[entity, stems[i]] = 0
    return [(entity, term, stem, *first[entity]) for (entity, term), stem in found.items()]


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{(*KINDS, *ADDED)[k]}:{a}:{b}" for k, a, b in spans)


_NEAR = ("entity", "term", "stem", "left", "right")


def _structs(names: tuple[str, ...], kind: pa.DataType) -> pa.DataType:
    return pa.list_(pa.struct([(n, kind) for n in names]))


_FOUND = (
    f"{', '.join(f'n_{k} long' for k in KINDS)}, base string, base_sha256 string, base_spans {_SPAN}, "
    f"entities array<long>, near array<struct<{','.join(f'{n}:long' for n in _NEAR)}>>, text string"
)


def find_base(docs: DataFrame, all_texts: bool = False) -> DataFrame:
    """Base spans of every row, what is near them, and the text of rows that have any."""
    schema = T.StructType([T.StructField(_ROW, T.LongType()), docs.schema["doc_id"], *T.StructType.fromDDL(_FOUND).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            spans = [base_spans(t) for t in texts]
            hit = [i for i, s in enumerate(spans) if s]
            terms = Terms(pa.array([texts[i] for i in hit], pa.string()))
            near: list[list] = [[] for _ in texts]
            entities: list[list[int]] = [[] for _ in texts]
            for n, i in enumerate(hit):
                near[i] = [dict(zip(_NEAR, x, strict=True)) for x in _near(terms, n, texts[i], spans[i])]
                entities[i] = sorted({number_of(value_of(k, texts[i][a:b])) for k, a, b in spans[i]})
            base = [spelled(s) for s in spans]
            columns = [pa.array([sum(k == kind for k, *_ in s) for s in spans], pa.int64()) for kind in range(len(KINDS))]
            columns += [pa.array(x, pa.string()) for x in (base, [hashlib.sha256(b.encode()).hexdigest() for b in base])]
            columns.append(pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans], _structs(("kind", "start", "end"), pa.int32())))
            columns += [pa.array(entities, pa.list_(pa.int64())), pa.array(near, _structs(_NEAR, pa.int64()))]
            columns.append(pa.array([t if s or all_texts else None for t, s in zip(texts, spans, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], schema.names)

    numbered = docs.select(F.monotonically_increasing_id().alias(_ROW), "doc_id", "text")
    return common.stored_tightly(numbered.mapInArrow(run, schema), "personal-data")


def _bit(numbers: np.ndarray) -> np.ndarray:
    """Place of a number in the table of bits."""
    return ((numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)


def _bitmap(terms: DataFrame) -> np.ndarray:
    """Bits of all numbers in the column ``term``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BITS, bool)
        for batch in batches:
            seen[_bit(batch.column(0).to_numpy())] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen).astype(np.int32))], ["bit"])

    bits = np.zeros(BITS, bool)
    bits[terms.select("term").mapInArrow(run, "bit int").distinct().toArrow()["bit"].to_numpy()] = True  # at most BITS rows
    return np.packbits(bits)


def _has(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    at = _bit(numbers)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def documents_with(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """term and the number of documents with it, at least for all terms of the bitmap; stems count as terms."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # BITS / 8 bytes

    def rows(found: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(found), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[at : at + (1 << 16)]) for x in (found, n)], ["term", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            terms = Terms(batch.column(0))
            rows_of, numbers = np.concatenate((terms.rows, terms.rows)), np.concatenate((terms.numbers, terms.stems))
            some = (numbers != 0) & _has(shared.value, numbers)
            rows_of, numbers = rows_of[some], numbers[some]
            order = np.lexsort((rows_of, numbers))
            rows_of, numbers = rows_of[order], numbers[order]
            new = np.ones(len(numbers), bool)
            new[1:] = (numbers[1:] != numbers[:-1]) | (rows_of[1:] != rows_of[:-1])
            more, times = np.unique(numbers[new], return_counts=True)
            merged, at = np.unique(np.concatenate((found, more)), return_inverse=True)
            total = np.bincount(at, np.concatenate((n, times)), len(merged)).astype(np.int64)
            found, n = merged, total
            if len(found) > HELD_TERMS:
                yield from rows(found, n)
                found, n = found[:0], n[:0]
        yield from rows(found, n)

    return docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n_term"))


def disclosing(found: DataFrame, docs: DataFrame) -> DataFrame | None:
    """entity, term, kind of every term that discloses an entity: kind 4 is generalised, 5 removed. None if there is none."""
    near = found.select(F.explode("near").alias("x")).select("x.*")
    told = near.groupBy("entity", "term").agg(
        F.count("*").alias("n_both"), F.count_distinct("left").alias("n_left"), F.count_distinct("right").alias("n_right"), F.max("stem").alias("stem")
    )
    known = materialize(told.where(F.least("n_left", "n_right") >= MIN_CONTEXTS), "near-terms")
    if known.isEmpty():
        return None
    n_docs = found.count()
    mentions = found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    counted = documents_with(docs, _bitmap(known))
    weighed = known.join(counted, "term").join(mentions, "entity")
    p_entity, share = F.col("n_entity") / n_docs, F.col("n_both") / F.col("n_term")
    content, shared = -F.log2(p_entity), F.log2(share / p_entity)
    flagged = materialize(weighed.where((content > 0) & (shared >= DISCLOSURE * content)).select("entity", "term", "stem"), "disclosing")
    stems = flagged.select("entity", F.col("term").alias("stem"), F.lit(True).alias("_stem_too"))
    # Stems have no stem of their own; they are in ``flagged`` only to be looked up.
    whole = flagged.join(stems, ["entity", "stem"], "left")
    kind = F.when((F.col("stem") != 0) & F.col("_stem_too").isNull(), len(KINDS)).otherwise(len(KINDS) + 1)
    out = materialize(whole.select("entity", "term", kind.alias("kind")), "disclosing-terms")
    return None if out.isEmpty() else out


def _hits(found: DataFrame, bits: np.ndarray) -> DataFrame:
    """Rows with base spans: the places of each word outside of them that the bitmap has."""
    shared = found.sparkSession.sparkContext.broadcast(bits)
    schema = f"{_ROW} long, term long, places array<struct<start:int,end:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = Terms(batch.column(1))
            rows, numbers, places = [], [], []
            for i, spans in enumerate(batch.column(2).to_pylist()):
                free = terms.outside(i, [(s["kind"], s["start"], s["end"]) for s in spans])
                of: dict[int, list] = {}
                for j in free[_has(shared.value, terms.numbers[free])].tolist():
                    of.setdefault(int(terms.numbers[j]), []).append({"start": int(terms.starts[j]), "end": int(terms.ends[j])})
                rows += [batch.column(0)[i].as_py()] * len(of)
                numbers += of.keys()
                places += of.values()
            columns = [pa.array(rows, pa.int64()), pa.array(numbers, pa.int64()), pa.array(places, _structs(("start", "end"), pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, [_ROW, "term", "places"])

    return found.where(F.size("base_spans") > 0).select(_ROW, "text", "base_spans").mapInArrow(run, schema)


def added_spans(found: DataFrame, told: DataFrame) -> DataFrame:
    """Per row the spans of terms that disclose an entity mentioned in it, by kind and start."""
    hits = _hits(found, _bitmap(told))
    mentions = found.select(_ROW, F.explode("entities").alias("entity"))
    # A term discloses few entities: their shares of its documents add up to at most the mentions in a window.
    own = hits.join(told, "term").join(mentions, [_ROW, "entity"])
    # A term that has to go for one entity is not merely generalised for another.
    each = own.groupBy(_ROW, "term").agg(F.max("kind").alias("kind"), F.any_value("places").alias("places"))
    places = each.select(_ROW, "kind", F.explode("places").alias("p")).select(_ROW, F.struct("kind", "p.start", "p.end").alias("span"))
    return places.groupBy(_ROW).agg(F.array_sort(F.collect_list("span")).alias("added"))


def find(docs: DataFrame, all_texts: bool = False) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (text), base_spans and added (arrays), text for every row.

    NULL and empty texts have no spans; texts of any length are read whole. Only documents with base spans get others, and
    no added span touches a base one. Repeated rows each count as a document. An empty table gives no rows; other
    columns are ignored. ``text`` is NULL for rows without spans unless ``all_texts``.
    """
    common.prepare(docs.sparkSession)
    found = find_base(docs, all_texts)
    told = disclosing(found, docs)
    if told is None:
        found = found.withColumn("added", F.array().cast(_SPAN))
    else:
        found = found.join(added_spans(found, told), _ROW, "left").withColumn("added", F.coalesce("added", F.array().cast(_SPAN)))
    names = F.array(*map(F.lit, (*KINDS, *ADDED)))
    said = F.array_join(F.transform("added", lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    spans = F.concat_ws(",", F.nullif("base", F.lit("")), F.nullif(said, F.lit("")))
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", spans.alias("spans"), "base_spans", "added", "text")


def masked(text: str, spans: list[Span], stem: int = STEM) -> str:
    """The text with its spans replaced: base ones by their kind, terms by their stem or a mark.
    Spans that overlap are replaced together, named after the first."""
    out, at = [], 0
    merged: list[list] = []
    for kind, begin, end in sorted(spans, key=lambda s: (s[1], s[0])):
        if merged and begin < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, begin, end])
    for kind, begin, end in merged:
        out.append(text[at:begin])
        out.append(f"{text[begin : begin + stem]}…" if kind == len(KINDS) else f"[{(*KINDS, *ADDED)[kind]}]")
        at = end
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """doc_id, text and spans of every row, with personal data and the terms that disclose it masked.

    NULL texts become empty; the rest is as for ``find``.
    """

    @F.arrow_udf(T.StringType())
    def mask(texts: pa.Array, base: pa.Array, added: pa.Array) -> pa.Array:
        rows = zip(texts.to_pylist(), base.to_pylist(), added.to_pylist(), strict=True)
        return pa.array([masked(t, [(s["kind"], s["start"], s["end"]) for s in (*a, *b)]) for t, a, b in rows], pa.string())

    found = find(docs, all_texts=True)
    return found.select("doc_id", mask("text", "base_spans", "added").alias("text"), "spans")
