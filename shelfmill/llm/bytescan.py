"""Vectorised helpers over UTF-8 bytes of many texts at once.

Tasks hand Arrow string columns to numpy without making Python strings. A
block holds whole texts, one after the other, and is processed in one go;
hashes are computed for any span in constant time after one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that are processed at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, BLOCK_BYTES + (1 << 16))
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


class SpanHash:
    """64-bit hashes of spans of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        up, self._down = _powers(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self._sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        x = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        return mix(x + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def rolling(self, n: int) -> np.ndarray:
        """Hash of every span of ``n`` values, by its start."""
        count = len(self._sums) - n
        if count <= 0:
            return np.zeros(0, np.uint64)
        x = (self._sums[n:] - self._sums[:count]) * self._down[:count]
        return mix(x + np.uint64(n * 0xD6E8FEB86659FD93 & _MASK))


def byte_hash(data: np.ndarray) -> SpanHash:
    return SpanHash(_BYTE_VALUES[data])


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    buffers = texts.buffers()
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, after the last, bytes, offsets) of runs of texts of about ``size`` bytes."""
    data, offsets = flat(texts)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by the first of them."""
    n = len(values)
    if n < width:
        return values[:0]
    if width == 1:
        return values.copy()
    pad = -n % width
    padded = np.concatenate([values, np.full(pad, values[-1], values.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def sliding_max(values: np.ndarray, width: int) -> np.ndarray:
    return ~sliding_min(~values, width)


def runs_of(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal true runs of ``mask`` within each text."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = mask.copy()
    begin[1:] &= ~mask[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(mask))]
    begin[inner] = mask[inner]
    end = mask.copy()
    end[:-1] &= ~mask[1:]
    end[inner - 1] = mask[inner - 1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


_ALNUM = np.zeros(256, bool)  # the complement of \x00-\x2F \x3A-\x60 \x7B-\x7F
_ALNUM[0x30:0x3A] = _ALNUM[0x61:0x7B] = _ALNUM[0x80:] = True
_SPACE = np.zeros(256, bool)  # \x20 and \x09-\x0D
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def alnum_words(lowered: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of words of digits, a-z and non-ASCII characters in lower-cased bytes."""
    return runs_of(_ALNUM[lowered], offsets)


def spaced_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of words between ASCII white space."""
    return runs_of(~_SPACE[data], offsets)


def per_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the first word of each text and after the last, by offsets."""
    return np.searchsorted(starts, offsets)


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Mask of the n places inside any span ``[start, start + length)``."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + lengths, -1)
    return np.cumsum(edges[:n]) > 0
