"""Vectorised word splitting and hashing of Arrow text columns."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@dataclass
class Words:
    """Words [^\\x20\\x09-\\x0D]+ of some texts: byte range, index of the text and 64-bit hash of each, in text order."""

    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    hashes: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=len(self.offsets) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (wraps by design)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers as compressed byte planes, as many as the largest needs."""
    wide = np.ascontiguousarray(values, np.uint64)
    planes = max(1, (int(wide.max()).bit_length() + 7) // 8) if len(wide) else 1
    return zstandard.compress(bytes([planes]) + wide.view(np.uint8).reshape(-1, 8).T[:planes].tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    raw = zstandard.decompress(data)
    planes = raw[0]
    body = np.frombuffer(raw, np.uint8, offset=1).reshape(planes, -1)
    out = np.zeros((body.shape[1], 8), np.uint8)
    out[:, :planes] = body.T
    return out.view(np.int64).ravel()


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; nulls become empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def runs(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about limit bytes; a longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Splitter:
    """Splits and hashes; keeps the powers that it has made. lower: A-Z as a-z."""

    def __init__(self, lower: bool = False):
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True
        self.fold = np.arange(256, dtype=np.uint8)
        if lower:
            self.fold[65:91] += 32
        self.lower, self.up, self.down = lower, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def hash_ranges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte ranges of data."""
        n = len(data)
        if len(self.up) <= n:
            self.up, self.down = _powers(_BASE, n + 1), _powers(_INVERSE, n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.down[:n], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.up[ends])

    def split(self, data: np.ndarray, offsets: np.ndarray) -> Words:
        n = len(data)
        if self.lower:
            data = self.fold[data]
        blank = self.space[data]
        first, last = np.ones(n + 1, bool), np.ones(n + 1, bool)
        first[1:n] = blank[:-1]
        first[offsets[:-1]] = True  # a text begins; an index n stands for empty texts at the end
        last[: n - 1] = blank[1:]
        last[offsets[1:] - 1] = True
        starts = np.flatnonzero(first[:n] & ~blank)
        ends = np.flatnonzero(last[:n] & ~blank) + 1
        return Words(starts, ends, np.searchsorted(offsets[1:], starts, side="right"), self.hash_ranges(data, starts, ends), data, offsets)


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every run of size words inside a text; a text with fewer words gives one of all its words."""
    h, doc = words.hashes, words.doc
    if len(h) >= size:
        m = len(h) - size + 1
        out = np.zeros(m, np.uint64)
        for k in range(size):
            out = out * np.uint64(_BASE) + h[k : k + m]
        inside = doc[:m] == doc[size - 1 :]
        full, of = mix(out[inside]), doc[:m][inside]
    else:
        full, of = np.zeros(0, np.uint64), np.zeros(0, doc.dtype)
    counts = words.counts()
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        ends = np.cumsum(counts)
        extra = []
        for d in short:
            x = int(counts[d])
            for v in h[ends[d] - counts[d] : ends[d]].tolist():
                x = (x * _BASE + v) & 0xFFFFFFFFFFFFFFFF
            extra.append(x)
        full, of = np.append(full, mix(np.array(extra, np.uint64))), np.append(of, short)
        order = np.argsort(of, kind="stable")
        full, of = full[order], of[order]
    return full, of
