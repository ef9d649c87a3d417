"""Words of a whole Arrow column of texts at once, as ranges of its UTF-8 bytes.

A word is a run of ASCII digits, ASCII letters and characters beyond ASCII; A-Z count as a-z. All
bytes of a character beyond ASCII are 128 or more, so runs of characters are runs of bytes.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Ranges up to this many bytes are hashed together, byte by byte; longer ones singly.
TOGETHER = 64
_SPACE = 32


def _folded() -> np.ndarray:
    """What a byte counts as: itself, its lower-case letter, or a space between words."""
    codes = np.arange(256, dtype=np.uint8)
    upper = (codes >= ord("A")) & (codes <= ord("Z"))
    lower = np.where(upper, codes + np.uint8(32), codes)
    digit = (codes >= ord("0")) & (codes <= ord("9"))
    letter = (lower >= ord("a")) & (lower <= ord("z"))
    return np.where(digit | letter | (codes >= 128), lower, np.uint8(_SPACE))


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


FOLDED, CRC_TABLE = _folded(), _crc_table()


@dataclass(frozen=True)
class Words:
    """Word i is ``buffer[starts[i]:ends[i]]`` of text ``rows[i]``; words are in order.

    ``offsets`` says where each text begins; NULL texts have no words.
    """

    buffer: np.ndarray
    offsets: np.ndarray
    rows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def words_of(texts: pa.Array) -> Words:
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, last = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
    raw = np.frombuffer(data, np.uint8)[first:last] if last > first else np.empty(0, np.uint8)
    offsets = offsets - first
    buffer = FOLDED[raw]
    inside = np.zeros(len(buffer) + 1, bool)
    inside[:-1] = buffer != _SPACE
    cut = np.zeros(len(buffer) + 1, bool)  # a text ends before this byte
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:]
    ends = np.zeros(len(buffer) + 1, bool)
    ends[1:] = inside[:-1] & (~inside[1:] | cut[1:])
    starts, ends = np.flatnonzero(begins), np.flatnonzero(ends)
    rows = np.searchsorted(offsets, starts, "right") - 1
    return Words(buffer, offsets, rows, starts, ends)


def runs_of(words: Words, n: int) -> Words:
    """All runs of ``n`` consecutive words of a text, joined by one space."""
    if n == 1 or len(words.rows) < n:
        return words if n == 1 else Words(words.buffer, words.offsets, *[np.empty(0, np.int64)] * 3)
    lengths = words.ends - words.starts + 1  # a space after each word
    at = np.concatenate(([0], np.cumsum(lengths)))
    source = np.arange(at[-1]) + np.repeat(words.starts - at[:-1], lengths)
    source[at[1:] - 1] = 0
    joined = words.buffer[source]
    joined[at[1:] - 1] = _SPACE
    firsts = np.flatnonzero(words.rows[: -n + 1] == words.rows[n - 1 :])
    return Words(joined, words.offsets, words.rows[firsts], at[firsts], at[firsts + n] - 1)


def crc32(words: Words) -> np.ndarray:
    """Unsigned crc32 of each word."""
    lengths = words.ends - words.starts
    short = np.flatnonzero(lengths <= TOGETHER)
    short = short[np.argsort(TOGETHER - lengths[short].astype(np.uint8), kind="stable")]  # longest first
    at, sizes = words.starts[short], lengths[short]
    crc = np.full(len(short), 0xFFFFFFFF, np.uint32)
    left = np.searchsorted(-sizes, -np.arange(TOGETHER), "left")  # how many are longer than 0, 1, ...
    for place, n in enumerate(left):
        if not n:
            break
        some = crc[:n]
        crc[:n] = CRC_TABLE[(some ^ words.buffer[at[:n] + place]) & np.uint32(0xFF)] ^ (some >> np.uint32(8))
    out = np.empty(len(lengths), np.uint32)
    out[short] = ~crc
    for i in np.flatnonzero(lengths > TOGETHER).tolist():
        out[i] = zlib.crc32(words.buffer[words.starts[i] : words.ends[i]].tobytes())
    return out


def hash64(words: Words) -> np.ndarray:
    """A 64-bit number of each word: multiplied up byte by byte, or a digest if the word is long."""
    lengths = words.ends - words.starts
    short = np.flatnonzero(lengths <= TOGETHER)
    short = short[np.argsort(TOGETHER - lengths[short].astype(np.uint8), kind="stable")]  # longest first
    at, sizes = words.starts[short], lengths[short]
    value = np.full(len(short), 0xCBF29CE484222325, np.uint64)
    left = np.searchsorted(-sizes, -np.arange(TOGETHER), "left")
    for place, n in enumerate(left):
        if not n:
            break
        value[:n] = (value[:n] ^ words.buffer[at[:n] + place]) * np.uint64(0x100000001B3)
    out = np.empty(len(lengths), np.int64)
    out[short] = (value ^ (value >> np.uint64(29))).view(np.int64)
    for i in np.flatnonzero(lengths > TOGETHER).tolist():
        word = words.buffer[words.starts[i] : words.ends[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little", signed=True)
    return out
