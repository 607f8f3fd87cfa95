"""Texts of Arrow batches as numpy arrays: chunks of bounded size, words, hashes, n-grams.

A word is a run of bytes other than the six ASCII blanks (20, 09-0D); UTF-8 text can be cut there
without looking at code points. Hashes are 64 bits, equal in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Bytes of code points' ends; the others (80-BF) continue one.
STARTS_POINT = (np.arange(256) & 0xC0) != 0x80

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_CODES = np.random.default_rng(11).integers(1, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: np.uint64, count: int) -> np.ndarray:
    powers = np.full(count, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


_TABLES: dict[str, np.ndarray] = {}


def _tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, kept up to a chunk's length."""
    kept = CHUNK_BYTES + 2
    if count > kept:
        return _powers(_BASE, count), _powers(_INVERSE, count)
    if not _TABLES:
        _TABLES["up"], _TABLES["down"] = _powers(_BASE, kept), _powers(_INVERSE, kept)
    return _TABLES["up"][:count], _TABLES["down"][:count]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every bit of the result depends on every bit of ``h``."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every ``data[start:end]``, from one running sum over the bytes."""
    up, down = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


@dataclass
class Chunk:
    """Some rows of a batch: their bytes one after the other, a line feed after each text."""

    first: int
    last: int
    data: np.ndarray
    edges: np.ndarray  # text k of the chunk is data[edges[k] : edges[k + 1] - 1]

    def __len__(self) -> int:
        return self.last - self.first


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The column in pieces of about ``size`` bytes; a longer text is a piece of its own.

    A null text is read as the empty text.
    """
    column = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    view = memoryview(raw) if raw is not None else memoryview(b"")
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        joined = b"\n".join([*(view[offsets[k] : offsets[k + 1]] for k in range(first, last)), b""])
        edges = offsets[first : last + 1] - offsets[first] + np.arange(last - first + 1)
        yield Chunk(first, last, np.frombuffer(joined, np.uint8), edges)
        first = last


def words(chunk: Chunk, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a chunk, and where each text's words begin (one more entry than texts)."""
    data = LOWER[chunk.data] if lower else chunk.data
    hashes, places, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + CHUNK_BYTES)
        if end < len(data):  # back to a blank, else on to the next one
            blanks = np.flatnonzero(BLANK[data[at:end]])
            if len(blanks):
                end = at + int(blanks[-1]) + 1
            else:
                far = np.flatnonzero(BLANK[data[end:]])
                end = end + int(far[0]) + 1 if len(far) else len(data)
        piece = data[at:end]
        starts, ends = spans(~BLANK[piece])
        hashes.append(span_hashes(piece, starts, ends))
        places.append(starts + at)
        at = end
    places = np.concatenate(places) if places else np.zeros(0, np.int64)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), np.searchsorted(places, chunk.edges)


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    change = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` values from each place on; short inputs give none."""
    count = max(0, len(hashes) - size + 1)
    out = np.zeros(count, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + count]
    return mix(out)


def shingles(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word windows; a shorter text is one window, no words are none."""
    if not len(hashes):
        return hashes
    return np.unique(grams(hashes, min(size, len(hashes))))


def sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sum of ``values[edges[k]:edges[k + 1]]`` for every k, empty ranges included."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[edges[1:]] - total[edges[:-1]]
