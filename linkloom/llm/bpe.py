"""Byte-pair encoding with word ends, and decoding, without replaying merges.

Facts used: the encoding of a piece is the only row of valid tokens in which every two
neighbours are compatible, that is, in which merging their joined characters gives the
two again. The encoder takes the longest token at each position from an Aho-Corasick
automaton and checks it against its left neighbour in a table of pairs; a token that
does not fit gives way to its next shorter prefix, and a position that was left once is never
entered again, so the work is linear in the piece. A pair enters the table when it is first
seen, from the ranks along the two edges that meet.

Decoding and the decimal form of ids are reads from one byte buffer with an offset table.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm import common

# Fixed values of the vocabulary format.
WORD_END = "</w>"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
SPACES = "\t\n\v\f\r \x85\xa0  -     　"
LATIN_LETTERS, LATIN_NUMBERS, LATIN_SPACES = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"

_END = "\n"  # stands for the word end inside the automaton; white space is in no token
# Letters come first, as they are the most frequent; no contraction begins with one.
_ANY = regex.compile(rf"\p{{L}}+|{CONTRACTIONS}|\p{{N}}|[^{SPACES}\p{{L}}\p{{N}}]+")
_LATIN = re.compile(
    rf"[{LATIN_LETTERS}]+|{CONTRACTIONS}|[{LATIN_NUMBERS}]|[^{LATIN_SPACES}{LATIN_LETTERS}{LATIN_NUMBERS}]+"
)
#: Bounds of what one worker remembers.
CACHED_PIECES, CACHED_PAIRS, CACHED_LENGTH = 300_000, 500_000, 48
_CHUNK = 1 << 16
_NEVER = 1 << 40


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte: itself, or the next free one above 255."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(others)}


_STANDS = byte_characters()


class Encoder:
    """Tables of one vocabulary, built from the text of its file."""

    def __init__(self, raw: str):
        file = json.loads(raw)
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.names = {i: t for t, i in file["model"]["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.ids = {self._key(t): i for t, i in file["model"]["vocab"].items() if t not in self.special}
        self.ranks = {(self._key(a), self._key(b)): n for n, (a, b) in enumerate(map(self._parts, file["model"]["merges"]))}
        self.text = {i: k for k, i in self.ids.items()}
        self.parts = {a + b: (a, b, n) for (a, b), n in self.ranks.items()}
        self.spines: dict[tuple[str, int], list[tuple[str, int]]] = {}
        valid: list[str] = []
        known: set[str] = set()
        for k in sorted(self.ids, key=len):
            a, b, _ = self.parts.get(k, ("", "", 0))
            # A token is its own encoding if its last merge is the first to cross its two parts.
            single = len(k) == 1 or (len(k) == 2 and k[1] == _END)
            if k != _END and (single or (a in known and b in known and not self._crossed(a, b, whole=False))):
                valid.append(k)
                known.add(k)
        self.automaton = ahocorasick.Automaton()
        for k in valid:
            self.automaton.add_word(k, self.ids[k])
        self.automaton.make_automaton()
        self.shorter = {
            self.ids[k]: next((self.ids[k[:n]] for n in range(len(k) - 1, 0, -1) if k[:n] in known), None) for k in valid
        }
        self.length = {i: len(k) for i, k in self.text.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}
        pattern = "|".join(map(re.escape, self.special))
        self.split_special = re.compile(f"({pattern})") if pattern else None
        size = max(self.names) + 1
        self.token_table = _table([self.names.get(i, "") for i in range(size)])
        self.number_table = _table([str(i) for i in range(size)])

    @staticmethod
    def _key(token: str) -> str:
        return token[: -len(WORD_END)] + _END if token.endswith(WORD_END) else token

    @staticmethod
    def _parts(merge) -> tuple[str, str]:
        return tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge)

    def _spine(self, key: str, side: int) -> list[tuple[str, int]]:
        """The token and its parts down its right (1) or left (0) edge, each with the rank
        of the merge that ends it."""
        found = self.spines.get((key, side))
        if found is None:
            *parts, rank = self.parts.get(key, (0,))
            found = [(key, _NEVER)]
            if parts:
                (inner, _), *rest = self._spine(parts[side], side)
                found += [(inner, rank), *rest]
            self.spines[key, side] = found
        return found

    def _crossed(self, left: str, right: str, whole: bool = True) -> bool:
        """Whether a merge joins characters of both tokens before each is complete.

        A part on the inner edge of one token can merge with a part of the other while both
        exist; parts are older than what they form, so ranks are times. Equal merges run
        from left to right. Without ``whole`` the merge of the complete tokens is left out.
        """
        ranks = self.ranks
        for x, x_ends in self._spine(left, 1):
            for y, y_ends in self._spine(right, 0):
                rank = ranks.get((x, y))
                if rank is not None and rank < x_ends and rank <= y_ends and (whole or x_ends < _NEVER or y_ends < _NEVER):
                    return True
        return False

    def add_pair(self, a: int, b: int) -> bool:
        """Whether two tokens may be neighbours, entered into the table."""
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        fits = self.pairs[a, b] = not self._crossed(self.text[a], self.text[b])
        return fits

    def encode_key(self, key: str) -> list[int]:
        """Ids of one piece, written in byte characters with the end mark."""
        longest, length, shorter, fit, add = self.automaton.iter_long, self.length, self.shorter, self.pairs.get, self.add_pair
        out: list[int] = []
        left: set[int] = set()
        at, n, last = 0, len(key), None
        while at < n:
            for end, token in longest(key, at):  # the first is the longest token here, or lies further on
                if end - length[token] + 1 != at:
                    token = None
                break
            else:
                token = None
            while True:
                if token is None:  # nothing fits here: the token before is wrong
                    left.add(at)
                    token = out.pop()
                    at -= length[token]
                    last = out[-1] if out else None
                elif at + length[token] not in left:
                    fits = last is None or fit((last, token))
                    if fits is None:
                        fits = add(last, token)
                    if fits:
                        break
                token = shorter[token]
            out.append(token)
            at += length[token]
            last = token
        return out

    def encode_piece(self, piece: str) -> bytes:
        key = "".join(map(_STANDS.__getitem__, piece.encode())) + _END
        found = np.array(self.encode_key(key), np.int32).tobytes()
        if len(piece) <= CACHED_LENGTH:
            if len(self.pieces) >= CACHED_PIECES:
                self.pieces.clear()
            self.pieces[piece] = found
        return found

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        try:
            text.encode("latin-1")
            pieces = _LATIN.findall(text)
        except UnicodeEncodeError:
            pieces = _ANY.findall(text)
        known, encode = self.pieces.get, self.encode_piece
        return b"".join([known(p) or encode(p) for p in pieces])

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; NULL is empty."""
        if not text:
            return np.empty(0, np.int32)
        if self.split_special is None or "<|" not in text:
            return np.frombuffer(self._plain(text), np.int32)
        parts = self.split_special.split(text)
        ids = [
            np.array([self.special[p]], np.int32) if n % 2 else np.frombuffer(self._plain(p), np.int32)
            for n, p in enumerate(parts)
        ]
        return np.concatenate(ids)

    def decode_bytes(self, ids: np.ndarray) -> Iterator[bytes]:
        return _spelled(ids, *self.token_table)

    def decode(self, ids: np.ndarray) -> str:
        """Names of the tokens, special ones too, joined by one space."""
        return b"".join(self.decode_bytes(np.asarray(ids, np.int32))).decode()


def _table(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Every name and a blank after it in one buffer, and where each begins."""
    encoded = [n.encode() + b" " for n in names]
    offsets = np.concatenate(([0], np.cumsum([len(e) for e in encoded])))
    return np.frombuffer(b"".join(encoded), np.uint8), offsets


def _spelled(ids: np.ndarray, buffer: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
    """Names of the ids with one space between them, in chunks."""
    for at in range(0, len(ids), _CHUNK):
        some = ids[at : at + _CHUNK]
        starts, lengths = offsets[some], offsets[some + 1] - offsets[some]
        before = np.cumsum(lengths) - lengths
        spelled = buffer[np.arange(lengths.sum()) + np.repeat(starts - before, lengths)].tobytes()
        yield spelled if at + _CHUNK < len(ids) else spelled[:-1]


@lru_cache(maxsize=2)
def encoder(raw: str) -> Encoder:
    return Encoder(raw)


def _digest(chunks: Iterator[bytes]) -> str:
    sha = hashlib.sha256()
    for chunk in chunks:
        sha.update(chunk)
    return sha.hexdigest()


def read_vocabulary(path: str) -> str:
    """The text of a vocabulary file on the driver; a few MB at most."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def digests(docs: DataFrame, path: str, keep: list[str] | None = None, tokens: bool = False) -> DataFrame:
    """The columns ``keep`` (default doc_id), n_tokens, ids_sha256, decoded_sha256, and with
    ``tokens`` the ids themselves, for every row of ``docs``.

    NULL texts are empty: no token, digests of nothing. Texts of any length are read whole.
    Rows and their order within a partition stay as they are; an empty table gives no rows.
    """
    keep = keep or ["doc_id"]
    spark = common.prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(read_vocabulary(path))  # bounded: one vocabulary
    fields = [docs.schema[c] for c in keep]
    fields += [T.StructField("tokens", T.ArrayType(T.IntegerType()))] if tokens else []
    fields += [T.StructField(n, t) for n, t in (("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shared.value)
        for batch in batches:
            rows = [own.encode(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            columns = [*batch.columns[:-1]]
            if tokens:
                ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *rows]))))
            columns += [
                pa.array([len(r) for r in rows], pa.int64()),
                pa.array([_digest(_spelled(r, *own.number_table)) for r in rows], pa.string()),
                pa.array([_digest(own.decode_bytes(r)) for r in rows], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return docs.select(*keep, F.col("text")).mapInArrow(run, T.StructType(fields))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the token ids (array<int>) of every row."""
    return digests(docs, path, tokens=True).select("doc_id", "tokens")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the decoded text of rows (doc_id, tokens); NULL tokens give NULL."""
    shared = common.prepare(encoded.sparkSession).sparkContext.broadcast(read_vocabulary(path))

    @F.arrow_udf(T.StringType())
    def spell(ids: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(shared.value)
        for batch in ids:
            yield pa.array([None if x is None else own.decode(np.array(x, np.int32)) for x in batch.to_pylist()], pa.string())

    return encoded.select("doc_id", spell("tokens").alias("text"))
