"""Alignment of the tokens of two tokenizers over the same bytes.

Both token sequences of a text are intervals of its bytes. Sorted by start together, with the running
maximum of their ends, a group ends where a start reaches that maximum; inside a group every
overlap of an A with a B token is a link. Links are counted by pair of ids over all texts, in each
task first.

Texts are encoded once; the ids are stored and read again for the counts and for the sums of each text.
The counts of the most frequent pairs, at most ``TABLE_PAIRS`` of them, go to all tasks as a sorted
table. What a text links beyond these is looked up by a join, so no pair is left out; pairs outside
the table are rare, so no key of that join is hot.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm import common
from linkloom.session import materialize

#: Pairs of ids whose counts every task holds (16 bytes each), and pairs a task counts before it hands them on.
TABLE_PAIRS, HELD_PAIRS = 1 << 20, 1 << 21
_ROW, _B_BITS = "_align_row", 32
#: Characters of texts that are encoded at once; a longer text is encoded alone.
TOGETHER = 1 << 18


@lru_cache(maxsize=1)
def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes stand for
    themselves, the others for the letters from 256 on, in order."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


# Fixed value: how byte-level tokenizers cut a text before they merge.
_CUTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Characters beyond these may be classed by one version of Unicode and not by another; runs from here on are left to the tokenizer's own heap.
_UNSETTLED, _LONG_RUN = re.compile("[^\x00-\u024f]"), re.compile(r"(?<!\S)\S{1000}|(?<!\s)\s{1000}")


class ByteLevel:
    """Tokens of a byte-level tokenizer (A); their bytes by id.

    Where the vocabulary numbers its tokens in the order of its merges, merging by rank gives the same tokens, in a third of
    the time; texts in settled characters are encoded so, all others by the tokenizer itself.
    """

    def __init__(self, raw: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(raw)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True
        letters = byte_letters()
        names = {i: name for name, i in self.library.get_vocab(with_added_tokens=True).items()}
        self.tokens = [self._bytes(names.get(i, ""), letters) for i in range(max(names) + 1)]
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.by_rank = self._ranked(json.loads(raw), letters)

    def _ranked(self, parts: dict, letters: dict[str, int]):
        """An encoder by rank, or None if the file asks for anything beyond merges in order of the ids."""
        model, cuts = parts["model"], parts["pre_tokenizer"]
        vocabulary = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        plain = parts["normalizer"] is None and cuts["type"] == "ByteLevel" and cuts["use_regex"] and not cuts["add_prefix_space"]
        extra = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if not plain or any(model.get(x) for x in extra) or any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        from tiktoken import Encoding

        ranks = {self._bytes(name, letters): i for name, i in vocabulary.items() if i < 256 + len(merges)}
        return Encoding("by_rank", pat_str=_CUTS, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _bytes(name: str, letters: dict[str, int]) -> bytes:
        return bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        ranked = [self.by_rank is not None and not _UNSETTLED.search(t) and not _LONG_RUN.search(t) for t in texts]
        others = [" " + t for t, quick in zip(texts, ranked, strict=True) if not quick]
        ids = iter(self.library.encode_batch_fast(others, add_special_tokens=False) if others else [])
        return [self.by_rank.encode_ordinary(" " + t) if quick else next(ids).ids for t, quick in zip(texts, ranked, strict=True)]


class Pieces:
    """Tokens of a piece tokenizer (B), which puts a space before the text; their bytes by id."""

    def __init__(self, raw: bytes):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_proto=raw)
        self.tokens = [self._bytes(self.library.id_to_piece(i)) for i in range(self.library.get_piece_size())]
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)

    @staticmethod
    def _bytes(piece: str) -> bytes:
        one = re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece)
        return bytes([int(one[1], 16)]) if one else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


@lru_cache(maxsize=1)
def _tokenizers(a: str, b: bytes) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(a), Pieces(b)


def _together(texts: list[str]) -> Iterator[list[str]]:
    some: list[str] = []
    size = 0
    for text in texts:
        if some and size + len(text) > TOGETHER:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


def encoded(texts: list[str | None], a: ByteLevel, b: Pieces) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of both tokenizers for each text; none where the text is empty or its bytes don't come back."""
    none = np.empty(0, np.int32)
    for some in _together([t or "" for t in texts]):
        for text, x, y in zip(some, a.encode(some), b.encode(some), strict=True):
            whole = b" " + text.encode() if text else None
            if whole and b"".join([a.tokens[i] for i in x]) == whole and b"".join([b.tokens[i] for i in y]) == whole:
                yield np.array(x, np.int32), np.array(y, np.int32)
            else:
                yield none, none


def groups(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of both sides in order of groups, A before B in each: their group, their side (0 is A) and place."""
    ends = np.concatenate((np.cumsum(a_lengths), np.cumsum(b_lengths)))
    starts = ends - np.concatenate((a_lengths, b_lengths))
    side = np.repeat(np.array([0, 1], np.int8), [len(a_lengths), len(b_lengths)])
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    begins = np.ones(len(order), bool)
    begins[1:] = starts[order][1:] >= reach[:-1]
    group = np.cumsum(begins) - 1
    final = np.lexsort((side[order], group))  # keeps the order of starts within a side
    order, group = order[final], group[final]
    place = order - np.where(side[order] == 1, len(a_lengths), 0)
    return group, side[order], place


def overlaps(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every A token the place of the first B token that overlaps it, and how many do."""
    a_ends, b_ends = np.cumsum(a_lengths), np.cumsum(b_lengths)
    first = np.searchsorted(b_ends, a_ends - a_lengths, "right")
    last = np.searchsorted(b_ends - b_lengths, a_ends, "left")
    return first, np.maximum(last - first, 0)


def links(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the A and the B token of every overlap, in order."""
    first, n = overlaps(a_lengths, b_lengths)
    at = np.cumsum(n)
    return np.repeat(np.arange(len(n)), n), np.arange(at[-1] if len(at) else 0) + np.repeat(first - at + n, n)


def _numbers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Every number below ``size`` in decimal digits with one place for what follows, and where each begins."""
    spelled = [b"%d " % i for i in range(size)]
    return np.frombuffer(b"".join(spelled), np.uint8), np.concatenate(([0], np.cumsum([len(s) for s in spelled])))


def spelled(a_ids: np.ndarray, b_ids: np.ndarray, group: np.ndarray, side: np.ndarray, place: np.ndarray, numbers: tuple) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: ids of a side joined by commas, sides by a bar, groups by a semicolon."""
    if not len(place):
        return b""
    buffer, offsets = numbers
    ids = np.where(side == 0, a_ids[np.minimum(place, len(a_ids) - 1)], b_ids[np.minimum(place, len(b_ids) - 1)])
    starts, lengths = offsets[ids], offsets[ids + 1] - offsets[ids]
    after = np.cumsum(lengths)
    out = buffer[np.arange(after[-1]) + np.repeat(starts - after + lengths, lengths)]
    follows = np.full(len(ids), ord(","), np.uint8)
    follows[:-1][side[1:] != side[:-1]] = ord("|")
    follows[:-1][group[1:] != group[:-1]] = ord(";")
    out[after - 1] = follows
    return out[:-1].tobytes()


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *rows])))


def encode_both(docs: DataFrame, a_raw: str, b_raw: bytes) -> DataFrame:
    """doc_id, the ids a_ids and b_ids, n_a, n_b, n_groups, n_links, groups_sha256 of every row with a row number."""
    shared = docs.sparkSession.sparkContext.broadcast((a_raw, b_raw))  # bounded: two vocabularies
    numbers = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    ids = [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("a_ids", "b_ids")]
    schema = T.StructType([T.StructField(_ROW, T.LongType()), docs.schema["doc_id"], *ids, *numbers, T.StructField("groups_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _tokenizers(*shared.value)
        digits = _numbers(max(len(a.tokens), len(b.tokens)))
        for batch in batches:
            xs, ys, counts, shas = [], [], [], []
            for x, y in encoded(batch.column(2).to_pylist(), a, b):
                group, side, place = groups(a.lengths[x], b.lengths[y])
                n_groups = int(group[-1]) + 1 if len(group) else 0
                n_links = int(overlaps(a.lengths[x], b.lengths[y])[1].sum())
                xs.append(x)
                ys.append(y)
                counts.append((len(x), len(y), n_groups, n_links))
                shas.append(hashlib.sha256(spelled(x, y, group, side, place, digits)).hexdigest() if len(x) else "")
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], _lists(xs), _lists(ys), *columns, pa.array(shas, pa.string())], schema.names)

    numbered = docs.select(F.monotonically_increasing_id().alias(_ROW), "doc_id", "text")
    return numbered.mapInArrow(run, schema)


def _pairs_of(batch: pa.RecordBatch, lengths: tuple[np.ndarray, np.ndarray]) -> Iterator[np.ndarray]:
    """Pairs of ids of all links of each row, A in the upper half of the number."""
    sides = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in batch.columns[-2:]]
    for row in range(batch.num_rows):
        x, y = (values[offsets[row] : offsets[row + 1]] for offsets, values in sides)
        at, to = links(lengths[0][x], lengths[1][y])
        yield (x[at].astype(np.int64) << _B_BITS) | y[to]


def pair_counts(ids: DataFrame, lengths: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """pair and the number n of links that hold it, over all rows."""
    shared = ids.sparkSession.sparkContext.broadcast(lengths)  # bounded: one number a token

    def added(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        found, at = np.unique(np.concatenate(pairs), return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, at, np.concatenate(counts))
        return found, total

    def rows(found: np.ndarray, total: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(found), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[at : at + (1 << 16)]) for x in (found, total)], ["pair", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, held = [], [], 0
        for batch in batches:
            of_rows = [np.empty(0, np.int64), *_pairs_of(batch, shared.value)]
            found, n = np.unique(np.concatenate(of_rows), return_counts=True)
            pairs.append(found)
            counts.append(n)
            held += len(found)
            if held > HELD_PAIRS:
                found, total = added(pairs, counts)
                if len(found) > HELD_PAIRS // 2:  # hardly any repeat: the shuffle adds them up
                    yield from rows(found, total)
                    found, total = found[:0], total[:0]
                pairs, counts, held = [found], [total], len(found)
        if pairs:
            yield from rows(*added(pairs, counts))

    return ids.select("a_ids", "b_ids").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _least_in_table(counts: DataFrame, size: int) -> int:
    """The smallest power of two so that at most ``size`` pairs have that count or more."""
    bits = F.length(F.bin("n"))
    found = counts.groupBy(bits.alias("bits")).agg(F.count("*").alias("n")).collect()  # at most 64 rows
    left, least = size, 62
    for n in sorted(found, key=lambda r: -r.bits):
        left -= n.n
        if left < 0:
            break
        least = n.bits - 1
    return 1 << least


def align(docs: DataFrame, a_path: str, b_path: str, table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs``.

    A encodes a space and the text, B the text, to which it adds the space itself; strings of special tokens are plain
    text. NULL and empty texts, and those whose bytes do not come back from both, have no tokens: zeros and an
    empty digest. Repeated rows each count. Texts of any length are read whole; an empty table gives no rows. Other
    columns are ignored.
    """
    spark = common.prepare(docs.sparkSession)
    with open(a_path, encoding="utf-8") as a_file, open(b_path, "rb") as b_file:
        a_raw, b_raw = a_file.read(), b_file.read()
    both = common.stored_tightly(encode_both(docs, a_raw, b_raw), "aligned-ids")
    a, b = _tokenizers(a_raw, b_raw)
    lengths = (a.lengths, b.lengths)
    counts = materialize(pair_counts(both, lengths), "pair-counts")
    b_id = F.col("pair").bitwiseAND((1 << _B_BITS) - 1)
    # One row per id of B: bounded by its vocabulary.
    most = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))
    known = materialize(
        counts.join(F.broadcast(most), b_id == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best")), "known-pairs"
    )
    least = _least_in_table(counts, table_pairs)
    table = known.where(F.col("n") >= least).orderBy("pair").toArrow()  # at most table_pairs rows
    shared = spark.sparkContext.broadcast((lengths, table["pair"].to_numpy(), table["n"].to_numpy(), table["best"].to_numpy().astype(np.int8)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, pairs, n, best = shared.value
        for batch in batches:
            sums, bests, rest, at = [], [], [np.empty(0, np.int64)], [0]
            for found in _pairs_of(batch, lengths):
                spot = np.minimum(np.searchsorted(pairs, found), max(0, len(pairs) - 1))
                known = pairs[spot] == found if len(pairs) else np.zeros(len(found), bool)
                sums.append(int(n[spot[known]].sum()))
                bests.append(int(best[spot[known]].sum(dtype=np.int64)))
                rest.append(found[~known])
                at.append(at[-1] + len(rest[-1]))
            beyond = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(rest)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(sums, pa.int64()), pa.array(bests, pa.int64()), beyond], schema.names)

    own = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    sums = [T.StructField("_sum", T.LongType()), T.StructField("_best", T.LongType()), T.StructField("_beyond", T.ArrayType(T.LongType()))]
    schema = T.StructType([*[both.schema[c] for c in [_ROW, *own]], *sums])
    summed = both.select(_ROW, *own, "a_ids", "b_ids").mapInArrow(run, schema)
    n_best, count_sum = F.col("_best"), F.col("_sum")
    if least > 1:  # some pairs are outside the table
        summed = materialize(summed, "aligned-sums")
        beyond = summed.select(_ROW, F.explode("_beyond").alias("pair")).groupBy(_ROW, "pair").agg(F.count("*").alias("times"))
        more = beyond.join(known.where(F.col("n") < least), "pair").groupBy(_ROW)
        more = more.agg(F.sum(F.col("times") * F.col("n")).alias("_more"), F.sum(F.col("times") * F.col("best")).alias("_more_best"))
        summed = summed.join(more, _ROW, "left")
        count_sum, n_best = count_sum + F.coalesce("_more", F.lit(0)), n_best + F.coalesce("_more_best", F.lit(0))
    return summed.select(*own[:-1], n_best.alias("n_best"), count_sum.alias("count_sum"), "groups_sha256")
