"""Words of whole texts as 64-bit hashes, computed by numpy over blocks of UTF-8 bytes.

Two words share a hash by chance with a probability of about 2 ** -64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_BYTES = np.arange(256)
FOLD = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
BLANK = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))  # word bytes: all but blanks
ALNUM = (((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
         | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits in which each input bit sways every output bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base, modulo 2 ** 64."""
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(max(n, 256), _BASE))), dtype=np.uint64)
    return _powers[:n]


def _hash_piece(data: bytes, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first byte positions of the words in ``data``."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = word_bytes[raw]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    first = np.empty(len(at), bool)
    first[0] = True
    np.not_equal(at[1:], at[:-1] + 1, out=first[1:])
    begin = np.flatnonzero(first)
    length = np.diff(np.append(begin, len(at)))
    place = np.arange(len(at)) - np.repeat(begin, length)
    value = _BYTE_CODE[FOLD[raw[at]]] * powers(int(length.max()))[place]
    return mix64(np.add.reduceat(value, begin) + length.astype(np.uint64)), at[begin]


def hash_words(texts: list[bytes], word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, and where each text's words begin (one more offset at the end)."""
    words, offsets = [], [np.zeros(1, np.int64)]
    total = 0
    for lo, hi in blocks(texts):
        if hi - lo == 1 and len(texts[lo]) > 2 * BLOCK_BYTES:
            part = np.concatenate([_hash_piece(p, word_bytes)[0] for p in _pieces(texts[lo], word_bytes)])
            ends = np.array([len(part)])
        else:
            part, at = _hash_piece(b" ".join(texts[lo:hi]), word_bytes)
            ends = np.searchsorted(at, np.cumsum([len(t) + 1 for t in texts[lo:hi]]))
        words.append(part)
        offsets.append(ends + total)
        total += len(part)
    return np.concatenate(words) if words else np.empty(0, np.uint64), np.concatenate(offsets)


def _pieces(text: bytes, word_bytes: np.ndarray) -> Iterator[bytes]:
    """Parts of about a block, cut between words (a word longer than a block stays whole)."""
    lo = 0
    while lo < len(text):
        hi = min(len(text), lo + BLOCK_BYTES)
        while hi < len(text) and word_bytes[text[hi]] and word_bytes[text[hi - 1]]:
            hi += 1
        yield text[lo:hi]
        lo = hi


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes; a longer text is a range of its own."""
    lo, held = 0, 0
    for i, t in enumerate(texts):
        if i > lo and held + len(t) > limit:
            yield lo, i
            lo, held = i, 0
        held += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def text_bytes(column: pa.Array) -> list[bytes]:
    """A string column's values in UTF-8; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]
