"""Words and word shingles of whole texts as 64-bit hashes, a batch of texts at a time.

A word is a run of bytes other than space and U+0009 to U+000D; A to Z are lower-cased and
nothing else is. The hash of a word depends on its bytes alone, so that it is the same in
every task. Work goes over slices of a few million bytes whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Bytes hashed at once; a longer text is cut at white space.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


class Words(NamedTuple):
    """Words of consecutive texts: hash, first byte, byte after the last, and where each text begins.

    ``starts`` and ``ends`` are byte offsets within the word's own text. ``bounds`` has one
    more entry than there are texts: the words of text ``i`` are ``bounds[i]:bounds[i + 1]``.
    """

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers which spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for ``i`` below ``n``."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        table = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        table[0] = 1
        np.cumprod(table, out=table)
        if n <= 4 * SLICE_BYTES:  # tables for a single huge word are not kept
            _powers[base] = table
    return table


def _hash_slice(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, first and end bytes of the words of ``data``; no word crosses an offset in ``begins``."""
    inside = ~_SPACE[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    before[begins[begins < len(data)]] = False
    first = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    cut = begins[(begins > 0) & (begins <= len(data))] - 1
    after[cut] = False
    end = np.flatnonzero(inside & ~after) + 1
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power_table(_BASE, len(data))[: len(data)], out=total[1:])
    return mix((total[end] - total[first]) * _power_table(_INVERSE, len(data))[first]), first, end


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Slices ``low:high`` of the bytes, cut between texts or, within a long text, at white space."""
    low, last = int(offsets[0]), int(offsets[-1])
    while low < last:
        high = min(low + SLICE_BYTES, last)
        if high < last:
            text = int(offsets[np.searchsorted(offsets, high, "right") - 1])
            if text > low:
                high = text
            else:
                stop = int(offsets[np.searchsorted(offsets, high, "right")])
                while high < stop and not _SPACE[data[high]]:
                    near = np.flatnonzero(_SPACE[data[high : min(high + SLICE_BYTES, stop)]])
                    high = high + int(near[0]) if len(near) else min(high + SLICE_BYTES, stop)
        yield low, high
        low = high


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offsets at which they begin; null counts as empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets


def words_of(texts: pa.Array, lower: bool = True) -> Words:
    """Words of each text of an Arrow array of strings."""
    data, offsets = text_bytes(texts)
    hashes, firsts, ends = [], [], []
    for low, high in _pieces(data, offsets):
        piece = data[low:high]
        if lower:
            piece = np.frombuffer(piece.tobytes().lower(), dtype=np.uint8)
        begins = offsets[np.searchsorted(offsets, low) : np.searchsorted(offsets, high, "right")] - low
        h, first, end = _hash_slice(piece, begins)
        hashes.append(h)
        firsts.append(first + low)
        ends.append(end + low)
    empty = np.zeros(0, dtype=np.int64)
    h = np.concatenate(hashes) if hashes else empty.astype(np.uint64)
    first = np.concatenate(firsts) if firsts else empty
    end = np.concatenate(ends) if ends else empty
    bounds = np.searchsorted(first, offsets)
    base = np.repeat(offsets[:-1], np.diff(bounds))
    return Words(h, first - base, end - base, bounds)


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words; a shorter, non-empty sequence is one shingle."""
    if len(hashes) == 0:
        return hashes
    n = min(n, len(hashes))
    out = np.full(len(hashes) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[i : len(hashes) - n + 1 + i]
    return mix(out)


def batches_by_bytes(batch: pa.RecordBatch, column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts take about ``most`` bytes; one longer text makes a slice of its own."""
    _, offsets = text_bytes(batch.column(column))
    low = 0
    while low < len(batch):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
        yield batch.slice(low, high - low)
        low = high
