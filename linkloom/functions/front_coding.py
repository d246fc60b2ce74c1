"""A dictionary of names in few bytes: front-coded sorted blocks found by a minimal perfect hash. Numpy only.

Names are sorted and cut into parts. Of each name a part keeps the number of bytes it shares with the name before it and the
rest; every ``BLOCK``-th name is whole. A perfect hash gives each name of the part a place of its own, at which its rank stands. Nothing
tells an unknown name there, so the name at that rank is compared with the one sought, byte by byte.

The hash works in levels: a level is a field of bits, in which those bits are set that exactly one of the remaining names falls on;
names that share a bit go to the next level. The place of a name is the number of set bits before its own. Names with
the same 64-bit hash can never be told apart so; they are kept whole, in ``rest``.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

BLOCK = 16
PART_NAMES = 1 << 16
LEVELS = 24
# Bits per remaining name in a level.
SPARSE = 1.5
_WORD = 64


def mixed(hashes: np.ndarray, level: int) -> np.ndarray:
    """Another 64-bit hash for each level, by multiplication and shifts."""
    x = hashes + np.uint64(((level + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Part(NamedTuple):
    """One part of a dictionary, as bytes: of ``n`` names from ``first`` on."""

    n: int
    first: bytes
    sizes: bytes
    bits: bytes
    ranks: bytes
    shared: bytes
    lengths: bytes
    rests: bytes
    ids: bytes
    rest: bytes


def common_prefix(a: bytes, b: bytes, most: int = 255) -> int:
    n = min(len(a), len(b), most)
    if a[:n] == b[:n]:
        return n
    low = 0
    while n - low > 1:
        middle = (low + n) // 2
        low, n = (middle, n) if a[:middle] == b[:middle] else (low, middle)
    return low


def encode_part(names: list[bytes], hashes: np.ndarray, ids: np.ndarray) -> Part:
    """A part of sorted different names, at most ``PART_NAMES`` of them."""
    n = len(names)
    shared = np.array([0 if i % BLOCK == 0 else common_prefix(names[i - 1], names[i]) for i in range(n)], dtype=np.uint8)
    rests = b"".join(name[s:] for name, s in zip(names, shared.tolist(), strict=True))
    lengths = np.array([len(name) for name in names], dtype=np.uint32) - shared

    sizes, fields, owners = [], [], []
    left = np.arange(n)
    for level in range(LEVELS):
        if not len(left):
            break
        size = -(-max(int(SPARSE * len(left)), 1) // _WORD) * _WORD
        bit = (mixed(hashes[left], level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(bit, minlength=size) == 1
        mine = alone[bit]
        owner = np.zeros(size, dtype=np.int64)
        owner[bit[mine]] = left[mine]
        sizes.append(size)
        fields.append(alone)
        owners.append(owner[alone])
        left = left[~mine]
    bits = np.packbits(np.concatenate(fields), bitorder="little") if fields else np.zeros(0, np.uint8)
    ranks = np.concatenate(owners).astype(np.uint16) if owners else np.zeros(0, np.uint16)
    padded = np.zeros(LEVELS, dtype=np.uint32)
    padded[: len(sizes)] = sizes
    return Part(
        n, names[0], padded.tobytes(), bits.tobytes(), ranks.tobytes(), shared.tobytes(), lengths.astype(np.uint32).tobytes(), rests,
        np.asarray(ids, dtype=np.int64).tobytes(), left.astype(np.uint32).tobytes(),
    )


def narrowed(values: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes each as the largest needs."""
    if len(values) and values.min() < 0:
        return values
    top = int(values.max()) if len(values) else 0
    return values.astype(np.min_scalar_type(top))


class Dictionary:
    """All parts of a dictionary in a few arrays; ``find`` looks up many names at once."""

    def __init__(self, parts: list[Part]):
        def joined(field: str, kind) -> np.ndarray:
            data = b"".join(getattr(p, field) for p in parts)
            return np.frombuffer(data, dtype=kind) if data else np.zeros(0, dtype=kind)

        counts = np.array([p.n for p in parts], dtype=np.int64)
        self.firsts = np.array([p.first for p in parts], dtype=object)
        self.begin = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.sizes = joined("sizes", np.uint32).reshape(len(parts), LEVELS).astype(np.int64)
        # Bits of a part lie one level after the other, those of the next part behind them.
        ends = np.cumsum(self.sizes.ravel())
        self.offsets = (ends - self.sizes.ravel()).reshape(len(parts), LEVELS)
        self.bits = joined("bits", np.uint8)
        ones = np.bitwise_count(self.bits.view(np.uint64)) if len(self.bits) else np.zeros(0, np.uint8)
        self.before = narrowed(np.concatenate([[0], np.cumsum(ones, dtype=np.int64)]))
        self.ranks = joined("ranks", np.uint16)
        self.shared = joined("shared", np.uint8)
        self.lengths = narrowed(joined("lengths", np.uint32))
        self.rests = joined("rests", np.uint8)
        self.ids = narrowed(joined("ids", np.int64))
        # Blocks do not cross parts, so a part's blocks are counted by themselves.
        blocks = -(-counts // BLOCK)
        self.first_block = np.concatenate([[0], np.cumsum(blocks)]).astype(np.int64)
        heads = np.concatenate([b + np.arange(0, n, BLOCK) for b, n in zip(self.begin, counts)]) if len(parts) else np.zeros(0, np.int64)
        total = np.add.reduceat(self.lengths.astype(np.int64), heads) if len(heads) else np.zeros(0, np.int64)
        self.text_at = narrowed(np.cumsum(total) - total)
        self.rest = {}
        for p, part in enumerate(parts):
            for r in np.frombuffer(part.rest, dtype=np.uint32).tolist():
                self.rest[self.name(p, r)] = int(self.ids[self.begin[p] + r])

    def name(self, part: int, rank: int) -> bytes:
        """The name of a rank, put together from its block."""
        at = int(self.begin[part]) + rank // BLOCK * BLOCK
        text, name = int(self.text_at[self.first_block[part] + rank // BLOCK]), b""
        for i in range(at, int(self.begin[part]) + rank + 1):
            length = int(self.lengths[i])
            name = name[: self.shared[i]] + self.rests[text : text + length].tobytes()
            text += length
        return name

    def names(self, part: int) -> list[bytes]:
        """All names of a part in order."""
        text, out = 0, []
        for rank, i in enumerate(range(int(self.begin[part]), int(self.begin[part + 1]))):
            if rank % BLOCK == 0:
                text = int(self.text_at[self.first_block[part] + rank // BLOCK])
            length = int(self.lengths[i])
            before = out[-1][: self.shared[i]] if self.shared[i] else b""
            out.append(before + self.rests[text : text + length].tobytes())
            text += length
        return out

    def stored(self) -> int:
        """Bytes of the arrays."""
        return sum(v.nbytes for v in vars(self).values() if isinstance(v, np.ndarray)) + sum(len(f) for f in self.firsts)

    def find(self, names: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """The id of each name, -1 if it is unknown."""
        found = np.full(len(names), -1, dtype=np.int64)
        if not len(names) or not len(self.firsts):
            return found
        part = np.searchsorted(self.firsts, np.array([*names, b""], dtype=object)[:-1], "right") - 1
        rank = np.full(len(names), -1, dtype=np.int64)
        left = np.flatnonzero(part >= 0)
        for level in range(LEVELS):
            left = left[self.sizes[part[left], level] > 0]
            if not len(left):
                break
            size = self.sizes[part[left], level].astype(np.uint64)
            bit = self.offsets[part[left], level] + (mixed(hashes[left], level) % size).astype(np.int64)
            hit = (self.bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
            rank[left[hit]] = self.ranks[self._place(bit[hit])]
            left = left[~hit]
        known = np.flatnonzero(rank >= 0)
        same = self._same(names, known, part[known], rank[known])
        known = known[same]
        found[known] = self.ids[self.begin[part[known]] + rank[known]]
        if self.rest:
            for i in np.flatnonzero(found < 0).tolist():
                found[i] = self.rest.get(names[i], -1)
        return found

    def _place(self, bit: np.ndarray) -> np.ndarray:
        """Set bits before each bit."""
        word = bit >> 6
        below = (np.uint64(1) << (bit & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word].astype(np.int64) + np.bitwise_count(self.bits.view(np.uint64)[word] & below)

    def _same(self, names: list[bytes], rows: np.ndarray, part: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Whether names ``rows`` are those of the ranks.

        Goes through the blocks entry by entry with ``met``, the number of leading bytes that the name sought has in common with the
        entry. An entry that shares more than that with the one before differs at the same byte; one that shares less is
        compared from where its own bytes begin.
        """
        own = [names[i] for i in rows.tolist()]
        length = np.array([len(o) for o in own], dtype=np.int64)
        sought, begins = np.frombuffer(b"".join(own), dtype=np.uint8), np.cumsum(length) - length
        entry = self.begin[part] + rank // BLOCK * BLOCK
        last = self.begin[part] + rank
        text = self.text_at[self.first_block[part] + rank // BLOCK].astype(np.int64)
        met, whole = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        active = np.arange(len(own))
        while len(active):
            shared, size = self.shared[entry[active]].astype(np.int64), self.lengths[entry[active]].astype(np.int64)
            whole[active] = shared + size
            look = shared <= met[active]
            which, at = active[look], shared[look]
            width = np.minimum(size[look], length[which] - at)
            some = width > 0
            met[which] = at
            which, at, width = which[some], at[some], width[some]
            if len(which):
                starts = np.cumsum(width) - width
                step = np.arange(int(width.sum())) - np.repeat(starts, width)
                differs = sought[np.repeat(begins[which] + at, width) + step] != self.rests[np.repeat(text[which], width) + step]
                met[which] = at + np.minimum.reduceat(np.where(differs, step, np.repeat(width, width)), starts)
            text[active] += size
            active = active[entry[active] < last[active]]
            entry[active] += 1
        return (met == length) & (whole == length)
