"""Near-duplicate passages of fifty words or more, by compact windows over min-hashes.

A text is its sequence of five-word shingles, and a passage a run of at least ``SHINGLES`` of them, near another one if
``LEAST_EQUAL`` of them are equal. The five that may differ are those of one word, so that such a run has at most one gap, and an equal
stretch of ``STRETCH`` shingles. Under a hash function the Cartesian tree of a text has, at every node, a compact
window: all runs inside it that contain the node have that shingle as their min-hash. The nodes whose
window is at least ``WINDOW`` wide, about two per that length, are the anchors: the first ``WINDOW`` shingles of an equal
stretch have the same one in both texts, and at least ``AHEAD`` equal shingles follow it. So no passage is left to chance.

1. Texts that are equal but for the case of A to Z are one text. Its copies are reported with their representative.
2. The anchors of all texts are grouped with the ``AHEAD`` shingles after them; only those that lie in different texts stay.
3. Anchors with the same surroundings, as far as a passage can reach, are one class. Members of a class that lies in several
   texts match each other, however many there are. Each class is compared with all others of a small group. In a large one it is
   compared with its neighbours in sorted order, and then with all that agree with it at one of the places of each further run where fewest do;
   that is quadratic only where at most places of such a run many classes agree that are not near.
   A group of very many classes is cut into parts, and tasks compare two parts at a time.
4. A comparison verifies: some run of ``SHINGLES`` shingles around the anchor must agree in so many that the
   similarity is 0.8 or more, where words that were put in or left out may shift it by up to two places.
5. Verified runs of a document that overlap are one passage. It names one text that matches and the number of
   functions that led to it, of which there are ``FUNCTIONS``. All others are told by its class, the passages that can be
   reached over links between different texts: no link that ties two classes is left out, those within one are not listed.

Where a word is put in beside the same word, fewer shingles differ, and there may be two gaps: such a passage is found if it still has an equal stretch.

Defined results: null, blank and short texts hold no passage. Texts without id are not searched. Rows that repeat
an id are one document: a repeated text is no copy of itself. A passage repeated only within its own document does not
count. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm.common import HOT_ROWS, attach, ship_package, table, written
from linkloom.llm.components import components
from linkloom.llm.words import batches_by_bytes, mix, shingles, words_of

WORDS = 5
LEAST_WORDS = 50
SHINGLES = LEAST_WORDS - WORDS + 1
FUNCTIONS = 1
ENOUGH = 1
PERCENT = 80
# Equal shingles that make a run of SHINGLES similar enough: m / (2 SHINGLES - m) >= PERCENT / 100.
LEAST_EQUAL = -(-2 * SHINGLES * PERCENT // (100 + PERCENT))
# The equal shingles before or after the only gap, the places after an anchor that lie in them, and those before them that hold an anchor.
STRETCH = -(-LEAST_EQUAL // 2)
LOST = SHINGLES - LEAST_EQUAL
AHEAD = STRETCH // 2
WINDOW = STRETCH - AHEAD
# Shingles seen on each side of an anchor.
REACH = SHINGLES - 1
SHIFTS = (0, -1, 1, -2, 2)
# The anchors of all documents are broadcast to their texts up to this measured size; beyond it they are joined by key.
PLACES_BYTES = 64 << 20
# Classes of a group that one task compares with as many others; pairs compared at once, and verified at once.
PART_CLASSES = 32_768
HELD_ROWS = 16_384
# Groups up to this size are compared pair by pair.
FEW = 128
PAIRS, VERIFIED = 1 << 16, 4096

_FACTORS = np.random.default_rng(7).integers(0, 1 << 63, FUNCTIONS, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def nearest_smaller(values: np.ndarray, of: np.ndarray, ties: bool) -> np.ndarray:
    """Index of the nearest smaller value to the left within the same text, or else of the last one outside it.

    With ``ties`` an equal value counts as smaller. Every index jumps to what its target
    points at until the target is smaller; as all do so at once, a few rounds suffice.
    """
    before = np.arange(-1, len(values) - 1)
    active = np.arange(len(values))
    while len(active):
        target = before[active]
        inside = target >= 0
        inside[inside] = of[target[inside]] == of[active[inside]]
        bigger = np.zeros(len(active), dtype=bool)
        v, w = values[target[inside]], values[active[inside]]
        bigger[inside] = v > w if ties else v >= w
        active = active[bigger]
        before[active] = before[before[active]]
    return before


def compact_windows(values: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, first and last place of the compact windows of at least ``width`` values.

    Text ``i`` is ``values[bounds[i]:bounds[i + 1]]``. The nodes of the Cartesian tree with wide enough
    windows are minima of some run of ``width`` values, and the nearest smaller values on both sides
    are their ancestors, which are such minima too: the tree is built of these alone.
    """
    none = np.zeros(0, dtype=np.int64)
    n = len(values)
    if n < width:
        return none, none, none
    grid = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    grid[:n] = values
    grid = grid.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    lowest = np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    lowest = lowest[text[: n - width + 1] == text[width - 1 :]]
    if not len(lowest):
        return none, none, none
    minima = np.unique(lowest[np.append(True, lowest[1:] != lowest[:-1])])
    found = np.searchsorted(minima, values)
    found[found == len(minima)] = 0
    at = np.flatnonzero(minima[found] == values)
    own, of = values[at], text[at]
    left = nearest_smaller(own, of, ties=True)
    right = len(at) - 1 - nearest_smaller(own[::-1], of[::-1], ties=False)[::-1]
    begin, end = bounds[of], bounds[of + 1] - 1
    inside = left >= 0
    inside[inside] = of[left[inside]] == of[inside]
    first = np.where(inside, at[left] + 1, begin)
    inside = right < len(at)
    inside[inside] = of[right[inside]] == of[inside]
    last = np.where(inside, at[np.minimum(right, len(at) - 1)] - 1, end)
    wide = last - first + 1 >= width
    return at[wide], first[wide], last[wide]


def shingle_streams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of all texts of at least ``LEAST_WORDS`` words, one text after the other, and where each begins."""
    found = words_of(texts)
    counts = np.diff(found.bounds)
    lengths = np.where(counts >= LEAST_WORDS, counts - WORDS + 1, 0)
    if len(found.hashes) < WORDS:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    every = shingles(found.hashes, WORDS)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    return every[np.repeat(found.bounds[:-1] - bounds[:-1], lengths) + np.arange(bounds[-1])], bounds


def anchors_of(stream: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each place, a bit for every hash function under which it is the centre of a wide compact window."""
    mask = np.zeros(len(stream), dtype=np.int32)
    for i, factor in enumerate(_FACTORS):
        centre, _, _ = compact_windows(stream * factor, bounds, WINDOW)
        mask[centre] |= 1 << i
    return mask


def anchor_keys(stream: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of the anchors at ``at`` and the :data:`AHEAD` shingles that follow each."""
    key = mix(stream[at] + np.uint64(1))
    for i in range(1, AHEAD + 1):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + stream[at + i])
    return key


def text_names(docs: DataFrame) -> DataFrame:
    """``doc_id, name, n_words``: a 128-bit name of each text with A to Z lower-cased."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_by_bytes(whole, "text"):
                texts = batch.column("text")
                names = [hashlib.blake2b(t.encode().lower(), digest_size=16).digest() for t in texts.to_pylist()]
                arrays = [batch.column("doc_id"), pa.array(names, pa.binary()), pa.array(np.diff(words_of(texts).bounds))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "name", "n_words"])

    return docs.mapInArrow(run, "doc_id bigint, name binary, n_words bigint")


def anchor_rows(docs: DataFrame) -> DataFrame:
    """``anchor, doc_id, place, mask`` of every anchor of every text; ``anchor`` stands for it and the shingles that follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_by_bytes(whole, "text", 2 << 20):
                stream, bounds = shingle_streams(batch.column("text"))
                mask = anchors_of(stream, bounds)
                at = np.flatnonzero(mask)
                row = np.searchsorted(bounds, at, "right") - 1
                followed = at + AHEAD < bounds[row + 1]
                at, row = at[followed], row[followed]
                arrays = [
                    pa.array(anchor_keys(stream, at).view(np.int64)), batch.column("doc_id").take(pa.array(row)),
                    pa.array((at - bounds[row]).astype(np.int32)), pa.array(mask[at]),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["anchor", "doc_id", "place", "mask"])

    return docs.mapInArrow(run, "anchor bigint, doc_id bigint, place int, mask int")


def context_rows(docs: DataFrame) -> DataFrame:
    """The surroundings of each anchor of ``docs(doc_id, text, places)``.

    ``far`` holds two bytes per shingle from the anchor backwards, ``near`` the same beyond the shingles that the
    bucket has in common; zero is no shingle. ``context`` is a hash of both, ``before`` and ``after`` are the shingles there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_by_bytes(whole, "text", 1 << 20):
                stream, bounds = shingle_streams(batch.column("text"))
                places = batch.column("places")
                row = np.repeat(np.arange(len(batch)), places.value_lengths().to_numpy())
                packed = places.flatten().to_numpy()
                place, mask = packed >> FUNCTIONS, packed & ((1 << FUNCTIONS) - 1)
                # Rows that repeat an id may hold another, shorter text; its anchors are those within it.
                fits = bounds[row] + place + AHEAD < bounds[row + 1]
                row, place, mask = row[fits], place[fits], mask[fits].astype(np.int32)
                for low in range(0, len(row), 8192):
                    part = slice(low, low + 8192)
                    yield _contexts(stream, bounds, batch.column("doc_id"), row[part], place[part], mask[part])

    return docs.mapInArrow(run, CONTEXTS)


def _contexts(stream: np.ndarray, bounds: np.ndarray, ids: pa.Array, row: np.ndarray, place: np.ndarray, mask: np.ndarray) -> pa.RecordBatch:
    at = bounds[row] + place
    code = np.maximum(stream >> np.uint64(48), 1).astype(np.uint16)

    def outwards(steps: np.ndarray) -> np.ndarray:
        where = at[:, None] + steps
        inside = (where >= bounds[row][:, None]) & (where < bounds[row + 1][:, None])
        return np.where(inside, code[np.where(inside, where, 0)], np.uint16(0))

    far, near = outwards(-np.arange(1, REACH + 1)), outwards(np.arange(AHEAD + 1, REACH + 1))
    context = np.zeros(len(row), np.uint64)
    for column in (*far.T, *near.T):
        context = mix(context * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64) + np.uint64(1))
    arrays = [
        pa.array(anchor_keys(stream, at).view(np.int64)), pa.array(context.view(np.int64)), _bytes(far), _bytes(near), ids.take(pa.array(row)),
        pa.array(place.astype(np.int32)), pa.array(mask), pa.array((far > 0).sum(axis=1).astype(np.int32)), pa.array((AHEAD + (near > 0).sum(axis=1)).astype(np.int32)),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["bucket", "context", "far", "near", "doc_id", "place", "mask", "before", "after"])


CONTEXTS = "bucket bigint, context bigint, far binary, near binary, doc_id bigint, place int, mask int, before int, after int"
# How far passages around the anchors of a class reach, or -1, and a text that matches in ``equal`` shingles; another one if that is the own text.
# ``root`` is the context of one class of the same bucket for all that are tied by links.
REACHED = "bucket bigint, context bigint, to_left int, to_right int, equal int, one_id bigint, one_low int, two_id bigint, two_low int, root bigint"


def _bytes(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    rows = np.ascontiguousarray(rows, dtype=">u2")
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * width), n, [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def _codes(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u2").astype(np.uint16).reshape(len(column), width)


def compare_sides(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Of the shingles of ``one`` on a side, how many of the first 0, 1, 2, ... stand in ``other`` within two places."""
    hit, width = np.zeros(one.shape, dtype=bool), one.shape[1]
    for shift in SHIFTS:
        low, high = max(0, -shift), width - max(0, shift)
        hit[:, low:high] |= (one[:, low:high] == other[:, low + shift : high + shift]) & (one[:, low:high] > 0)
    sums = np.zeros((len(one), width + 1), dtype=np.int32)
    np.cumsum(hit, axis=1, out=sums[:, 1:])
    return sums


def verify(far: np.ndarray, near: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, ...]:
    """Which of the pairs are near, and for these the most shingles of a near run of ``i`` to the left and to the right, and the equal ones."""
    before, beyond = compare_sides(far[i], far[j]), compare_sides(near[i], near[j])
    # The shingles just after the anchor are the same in all rows of a bucket.
    after = np.concatenate([np.broadcast_to(np.arange(AHEAD), (len(i), AHEAD)), AHEAD + beyond], axis=1)
    # A run with x shingles on the left has REACH - x on the right.
    equal = 1 + before + after[:, ::-1]
    room = np.arange(REACH + 1)
    inside = (room[None, :] <= (far[i] > 0).sum(axis=1)[:, None]) & (REACH - room[None, :] <= AHEAD + (near[i] > 0).sum(axis=1)[:, None])
    good = (equal >= LEAST_EQUAL) & inside
    found = good.any(axis=1)
    good, equal = good[found], np.where(good, equal, 0)[found]
    return found, REACH - good[:, ::-1].argmax(axis=1), REACH - good.argmax(axis=1), equal.max(axis=1, initial=0)


def has_stretch(far: np.ndarray, near: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the equal shingles around the anchor are :data:`STRETCH` or more."""

    def agree(codes: np.ndarray) -> np.ndarray:
        one, other = codes[i, :AHEAD], codes[j, :AHEAD]
        same = (one == other) & (one > 0)
        return np.where(same.all(axis=1), AHEAD, same.argmin(axis=1))

    return 1 + agree(far) + AHEAD + agree(near) >= STRETCH


def compare_classes(sorted_classes: DataFrame) -> DataFrame:
    """``REACHED`` of the classes with ``as_x``, which have room for a passage, by those with ``as_y`` of its bucket and tile.

    Classes of several texts are sought for links alone; how far they reach is known.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows < HELD_ROWS:
                continue
            now = pa.Table.from_batches(held).combine_chunks()
            last = int(_groups(now)[-1])
            if last:
                yield from _compared(now.slice(0, last))
            held, rows = now.slice(last).to_batches(), len(now) - last
        if held:
            yield from _compared(pa.Table.from_batches(held).combine_chunks())

    return sorted_classes.mapInArrow(run, REACHED)


def _groups(rows: pa.Table) -> np.ndarray:
    bucket, tile = rows.column("bucket").to_numpy(), rows.column("tile").to_numpy()
    return np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (tile[1:] != tile[:-1])))


def _compared(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Whole groups: in small ones each ``x`` meets each ``y``, in others those that can add to what it has found."""
    far, near = _codes(rows.column("far"), REACH), _codes(rows.column("near"), REACH - AHEAD)
    columns = ("bucket", "context", "one_id", "one_place", "two_id", "two_place", "before", "after")
    bucket, context, one_id, one_place, two_id, two_place, before, after = (rows.column(c).to_numpy() for c in columns)
    group = np.zeros(len(rows), np.int64)
    group[_groups(rows)[1:]] = 1
    group = np.cumsum(group)
    x = np.flatnonzero(rows.column("as_x").to_numpy())
    y = np.flatnonzero(rows.column("as_y").to_numpy())
    begin, end = np.searchsorted(group[y], group[x]), np.searchsorted(group[y], group[x], "right")
    left, right, best, match, match_low = (np.full(len(rows), v, np.int64) for v in (-1, -1, 0, -1, 0))
    alone, root = one_id == two_id, np.arange(len(rows))
    left[~alone], right[~alone] = before[~alone], after[~alone]

    def meet(i: np.ndarray, j: np.ndarray) -> None:
        use = (i != j) & ~(alone[i] & alone[j] & (one_id[i] == one_id[j]))
        i, j = i[use], j[use]
        use = has_stretch(far, near, i, j)
        i, j = i[use], j[use]
        for at in range(0, len(i), VERIFIED):
            p, q = i[at : at + VERIFIED], j[at : at + VERIFIED]
            found, to_left, to_right, equal = verify(far, near, p, q)
            p, q = p[found], q[found]
            _unite(root, p, q)
            np.maximum.at(left, p, to_left)
            np.maximum.at(right, p, to_right)
            other = one_id[q] != one_id[p]
            ids, lows = np.where(other, one_id[q], two_id[q]), np.where(other, one_place[q], two_place[q]) - to_left
            # The match of most equal shingles, of these the one with the smallest id: it comes last, and stays.
            order = np.lexsort((lows, -ids, equal, p))
            final = order[np.append(p[order][1:] != p[order][:-1], True)] if len(order) else order
            better = (equal[final] > best[p[final]]) | ((equal[final] == best[p[final]]) & (ids[final] < match[p[final]]))
            final = final[better]
            best[p[final]], match[p[final]], match_low[p[final]] = equal[final], ids[final], lows[final]

    few = end - begin <= FEW
    for wanted, first, stop in _chunks(x[few], begin[few], end[few]):
        of, place = _ranges(first, stop)
        meet(wanted[of], y[place])
    if not few.all():
        crowded = np.isin(group[y], group[x[~few]])
        _crowds(x[~few], y[crowded], group, far, near, before, after, left, right, root, meet)
    tied = np.bincount(root, minlength=len(rows))[root] > 1
    found = alone & (left >= 0)
    left[~found], right[~found], best[~found] = -1, -1, 0
    at = np.flatnonzero(found | tied)
    if len(at):
        values = (bucket, context, left, right, best, match, np.maximum(match_low, 0), match, np.maximum(match_low, 0), context[root])
        kinds = ("int64", "int64", "int32", "int32", "int32", "int64", "int32", "int64", "int32", "int64")
        names = [c.split()[0] for c in REACHED.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(v[at].astype(k)) for v, k in zip(values, kinds, strict=True)], names)


def _unite(root: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Give all that the pairs tie together the smallest of their roots, in place."""
    while True:
        one, other = root[p], root[q]
        apart = one != other
        if not apart.any():
            return
        p, q, one, other = p[apart], q[apart], one[apart], other[apart]
        least = np.minimum(one, other)
        np.minimum.at(root, one, least)
        np.minimum.at(root, other, least)
        while (root[root] != root).any():
            root[:] = root[root]


def _ranges(first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of each range ``first:stop``, with the place of the range."""
    lengths = stop - first
    of = np.repeat(np.arange(len(first)), lengths)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths - first, lengths)


def _chunks(x: np.ndarray, first: np.ndarray, stop: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Slices with about :data:`PAIRS` numbers in their ranges."""
    total = np.cumsum(stop - first)
    cuts = np.searchsorted(total, np.arange(0, int(total[-1]) + PAIRS, PAIRS), "right") if len(x) else []
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        if low < high:
            yield x[low:high], first[low:high], stop[low:high]


def _crowds(x, y, group, far, near, before, after, left, right, root, meet) -> None:
    """Large groups, all at once: each ``x`` meets its neighbours in both orders, then all ``y`` of its group that can add to what is covered or tied.

    No run may lose more than ``LOST`` shingles, so of any ``LOST + 1`` of its places one agrees with a text it is near. For every run that goes
    further than those found these are the places where fewest ``y`` agree: those that ``x`` was edited at, if most others are copies of one text.
    Only the ``y`` that agree there, found by sorted columns of places, can count. A few of them come first, so that few runs are left for all.

    Links come last. Those within the largest part of a group that is tied already say nothing new; so each ``x`` outside of it is held against all
    ``y`` that another root has, for all its runs, and each ``y`` outside of it against the ``x`` inside.
    """

    def codes(of: np.ndarray) -> np.ndarray:
        return np.concatenate([far[of][:, ::-1], np.ones((len(of), AHEAD + 1), np.uint16), near[of]], axis=1)

    everyone = np.union1d(x, y)
    is_x, is_y = np.isin(everyone, x), np.isin(everyone, y)
    for side in (far, near):
        keys = np.ascontiguousarray(side[everyone], dtype=">u2")
        order = np.argsort(keys.view(f"S{keys.shape[1] * 2}").ravel(), kind="stable")
        order = order[np.argsort(group[everyone[order]], kind="stable")]
        for step in (1, 2, 3):
            for one, other in ((order[:-step], order[step:]), (order[step:], order[:-step])):
                use = is_x[one] & is_y[other] & (group[everyone[one]] == group[everyone[other]])
                meet(everyone[one[use]], everyone[other[use]])
    begin, end = np.searchsorted(group[y], group[x]), np.searchsorted(group[y], group[x], "right")
    owner, place = _ranges(begin, np.minimum(begin + 4, end))
    meet(x[owner], y[place])

    def table_of(rows: np.ndarray) -> tuple:
        # Codes of different groups never agree.
        return rows, codes(rows), group[rows] << 16, {}

    xs, ys = table_of(x), table_of(y)

    def agreeing(one: tuple, other: tuple, of: np.ndarray, place: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each shift the rows of ``other`` in order of a column, and the range of those that agree with each of ``one[of]`` at ``place`` of the ``x``."""
        _, given, keys, columns = other
        for shift in SHIFTS:
            if not 0 <= place + shift <= 2 * REACH:
                continue
            here, column = (place, place + shift) if one is xs else (place + shift, place)
            mine = one[1][of, here]
            value, some = one[2][of] | mine, mine > 0
            if column not in columns:
                codes_of = keys | given[:, column]
                order = np.argsort(codes_of, kind="stable")
                values, starts, lengths = np.unique(codes_of[order], return_index=True, return_counts=True)
                columns[column] = order, values, starts, starts + lengths
            order, values, starts, stops = columns[column]
            at = np.minimum(np.searchsorted(values, value), len(values) - 1)
            yield order, starts[at], np.where(some & (values[at] == value), stops[at], starts[at])

    def runs(of: np.ndarray) -> np.ndarray:
        """For each of ``x[of]`` and each number of shingles on the left, whether that run exists."""
        run = np.arange(REACH + 1)[None, :]
        return (run <= before[x[of]][:, None]) & (REACH - run <= after[x[of]][:, None])

    def wanted(of: np.ndarray) -> np.ndarray:
        """Of these the runs that go further than those found."""
        run = np.arange(REACH + 1)[None, :]
        return ((run > left[x[of]][:, None]) | (REACH - run > right[x[of]][:, None])) & runs(of)

    def counted(one: tuple, other: tuple, of: np.ndarray) -> np.ndarray:
        """How many agree with ``one[of]`` at each place; of equal counts the first is the smallest, so that runs share their places."""
        counts = np.zeros((len(of), 2 * REACH + 1), np.int64)
        for place in range(2 * REACH + 1):
            for _, first, stop in agreeing(one, other, of, place):
                counts[:, place] += stop - first
        return counts * (2 * REACH + 1) + np.arange(2 * REACH + 1)

    def chosen(some: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The places, ``LOST + 1`` or more of each of the runs, where fewest agree."""
        row, run = np.nonzero(some)
        places = np.zeros(counts.shape, dtype=bool)
        for at in range(0, len(row), VERIFIED):
            r, start = row[at : at + VERIFIED, None], REACH - run[at : at + VERIFIED, None]
            rarest = np.argpartition(counts[r, start + np.arange(SHINGLES)], LOST, axis=1)[:, : LOST + 1]
            places[r, start + rarest] = True
        return places

    def meet_at(one: tuple, other: tuple, of: np.ndarray, places: np.ndarray, most: int | None = None, untied: bool = False) -> None:
        """``one[of]`` and all of ``other`` that agree at one of their ``places``, or at most so many for each place and shift; or the ``untied`` alone."""
        held, size = [], 0

        def flush() -> None:
            pairs = np.unique(np.concatenate(held)) if held else np.zeros(0, np.int64)
            for at in range(0, len(pairs), PAIRS):
                i, j = one[0][pairs[at : at + PAIRS] // len(other[0])], other[0][pairs[at : at + PAIRS] % len(other[0])]
                if untied:
                    use = root[i] != root[j]
                    i, j = i[use], j[use]
                meet(*((i, j) if one is xs else (j, i)))
            held.clear()

        for place in np.flatnonzero(places.any(axis=0)):
            some = of[places[:, place]]
            for order, first, stop in agreeing(one, other, some, place):
                stop = stop if most is None else np.minimum(stop, first + most)
                for part, begin, end in _chunks(some, first, stop):
                    owner, at = _ranges(begin, end)
                    owner, at = part[owner], order[at]
                    if untied:
                        use = root[one[0][owner]] != root[other[0][at]]
                        owner, at = owner[use], at[use]
                    held.append(owner * len(other[0]) + at)
                    size += len(at)
                    if size > 16 * PAIRS:
                        flush()
                        size = 0
        flush()

    short = np.flatnonzero((left[x] < before[x]) | (right[x] < after[x]))
    for at in range(0, len(short), VERIFIED):
        of = short[at : at + VERIFIED]
        counts = counted(xs, ys, of)
        places = chosen(wanted(of), counts)
        many = np.where(places, counts // (2 * REACH + 1), 0).sum(axis=1) > FEW
        meet_at(xs, ys, of[many], places[many], 1)
        places[many] = chosen(wanted(of[many]), counts[many])
        meet_at(xs, ys, of, places)

    # One root per group, that of most.
    size = np.bincount(root[everyone], minlength=len(root))
    order = np.lexsort((size[root[everyone]], group[everyone]))
    final = order[np.append(group[everyone[order]][1:] != group[everyone[order]][:-1], True)]
    largest = np.full(int(group.max()) + 1, -1)
    largest[group[everyone[final]]] = root[everyone[final]]
    inside = root == largest[group]
    # An ``x`` that has found nothing has met all it could.
    outside = np.flatnonzero(~inside[x] & (left[x] >= 0))
    for at in range(0, len(outside), VERIFIED):
        of = outside[at : at + VERIFIED]
        meet_at(xs, ys, of, chosen(runs(of), counted(xs, ys, of)), untied=True)
    within, outside = table_of(x[inside[x]]), np.flatnonzero(~inside[y])
    for at in range(0, len(outside) if len(within[0]) else 0, VERIFIED):
        of = outside[at : at + VERIFIED]
        every = np.ones((len(of), REACH + 1), dtype=bool)
        meet_at(ys, within, of, chosen(every, counted(ys, within, of)), untied=True)


def reached_classes(contexts: DataFrame) -> DataFrame:
    """``REACHED`` of each class of ``contexts``, a written table, that has a passage around it or links, with ``nodes``: what is tied has one in common."""
    parts = max(1, int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    named = F.struct("doc_id", "place")
    classes = contexts.groupBy("bucket", "context").agg(
        F.min(named).alias("one"), F.max(named).alias("two"), F.first("far").alias("far"), F.first("near").alias("near"),
        F.first("before").alias("before"), F.first("after").alias("after"),
    )
    classes = written(
        classes.select(
            "bucket", "context", "far", "near", "before", "after", F.col("one.doc_id").alias("one_id"), F.col("one.place").alias("one_place"),
            F.col("two.doc_id").alias("two_id"), F.col("two.place").alias("two_place"),
        ),
        "classes",
    )
    roomy = F.col("before") + F.col("after") >= REACH
    itself = classes.where((F.col("one_id") != F.col("two_id")) & roomy).select(
        "bucket", "context", F.col("before").alias("to_left"), F.col("after").alias("to_right"), F.lit(SHINGLES).alias("equal"),
        "one_id", (F.col("one_place") - F.col("before")).alias("one_low"), "two_id", (F.col("two_place") - F.col("before")).alias("two_low"),
        F.lit(None).cast("bigint").alias("root"),
    )
    sizes = classes.groupBy("bucket").agg(F.count(F.lit(1)).alias("_classes"), F.max(roomy).alias("searched"))
    sizes = written(sizes.where("_classes > 1 and searched").select("bucket", F.ceil(F.col("_classes") / PART_CLASSES).cast("int").alias("_parts")), "groups")
    met = attach(classes, sizes, ["bucket"], spread_by=["context"])
    # A part meets each part, itself included: as x in one tile, as y in another.
    own = F.pmod(F.xxhash64("context"), F.col("_parts")).cast("int")

    def tiles(other: Column) -> Column:
        as_x = F.struct((own * F.col("_parts") + other).alias("tile"), F.lit(True).alias("x"), (own == other).alias("y"))
        as_y = F.struct((other * F.col("_parts") + own).alias("tile"), F.lit(False).alias("x"), F.lit(True).alias("y"))
        return F.when(own == other, F.array(as_x)).otherwise(F.array(as_x, as_y))

    tiled = met.withColumn("_tile", F.explode(F.flatten(F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), tiles))))
    tiled = tiled.select(
        *classes.columns, F.col("_tile.tile").alias("tile"), (F.col("_tile.x") & roomy).alias("as_x"), F.col("_tile.y").alias("as_y"),
        (F.col("one_id") == F.col("two_id")).alias("alone"),
    ).where("as_x or as_y")
    in_tiles = tiled.repartition(parts, "bucket", "tile").sortWithinPartitions("bucket", "tile", "alone", "context")
    compared = compare_classes(in_tiles)
    match = F.when(F.col("to_left") >= 0, F.struct("equal", F.negative("one_id").alias("other"), "one_low", "two_id", "two_low"))
    best = itself.unionByName(compared).groupBy("bucket", "context").agg(
        F.max("to_left").alias("to_left"), F.max("to_right").alias("to_right"), F.max(match).alias("m"), F.collect_set("root").alias("roots")
    )
    # A class that no link ties to another one is its own node. It has one root for each tile it is tied in.
    roots = F.when(F.size("roots") > 0, F.col("roots")).otherwise(F.array("context"))
    best = best.select(
        "bucket", "context", "to_left", "to_right", "m.equal", F.negative("m.other").alias("one_id"), "m.one_low", "m.two_id", "m.two_low",
        F.transform(roots, lambda r: F.xxhash64("bucket", r)).alias("nodes"),
    )
    return written(best, "reached")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, first_word, n_words, match_doc_id, match_first_word, similarity, n_hashes, whole_copy, class_doc_id, class_first_word``.

    One row per passage of a document that is near one of another text; for a text with copies, a row
    for each of its documents which names the representative (for that one, another copy). The last two
    columns name the first passage of the class, and the representative of copies, whose passages are theirs too.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).where("doc_id is not null")
    names = written(text_names(docs), "text-names")
    classes = names.where(F.col("n_words") >= LEAST_WORDS).groupBy("name").agg(
        F.min("doc_id").alias("leader"), F.max("doc_id").alias("other"), F.max("n_words").alias("n_words")
    )
    classes = written(classes.where("leader != other"), "copied-texts")
    copies = attach(names.select("doc_id", "name"), classes, ["name"], spread_by=["doc_id"])
    copies = written(copies.select("doc_id", "leader", "other", "n_words").distinct(), "copies")
    whole = copies.select(
        "doc_id", F.lit(0).alias("first_word"), "n_words",
        F.when(F.col("doc_id") == F.col("leader"), F.col("other")).otherwise(F.col("leader")).alias("match_doc_id"),
        F.lit(0).alias("match_first_word"), F.lit(1.0).alias("similarity"), F.lit(FUNCTIONS).alias("n_hashes"), F.lit(True).alias("whole_copy"),
        F.col("leader").alias("class_doc_id"), F.lit(0).alias("class_first_word"),
    )
    again = written(copies.where("doc_id != leader").select("doc_id").distinct(), "copy-ids")
    texts = attach(docs, again, ["doc_id"], "left_anti", spread_by=["doc_id"])

    anchors = written(anchor_rows(texts), "anchors")
    shared = anchors.groupBy("anchor").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("_rows")
    )
    shared = written(shared.where("low != high").select("anchor", "_rows"), "shared-anchors")
    hot = shared.where(F.col("_rows") > HOT_ROWS)
    # By key at every size: there are about as many of these as documents. Their counts tell the hot ones.
    met = attach(anchors, shared.select("anchor"), ["anchor"], "left_semi", spread_by=["doc_id", "place"], broadcast_bytes=0, hot=hot)
    # The anchors of one document: no more than it has shingles.
    placed = met.groupBy("doc_id").agg(F.collect_set(F.shiftleft(F.col("place").cast("bigint"), FUNCTIONS) + F.col("mask")).alias("places"))
    placed = written(placed, "anchor-places")
    joined = attach(texts, placed, ["doc_id"], spread_by=["doc_id"], broadcast_bytes=PLACES_BYTES)
    contexts = written(context_rows(joined.select("doc_id", "text", "places")), "contexts")
    reached = reached_classes(contexts)
    passing = reached.where("to_left >= 0")
    members = attach(contexts.select("bucket", "context", "doc_id", "place", "mask"), passing, ["bucket", "context"], spread_by=["doc_id", "place"])
    own = F.col("doc_id") == F.col("one_id")
    found = members.select(
        "doc_id", (F.col("place") - F.col("to_left")).alias("low"), (F.col("place") + F.col("to_right")).alias("high"), "mask", "equal",
        F.when(own, F.col("two_id")).otherwise(F.col("one_id")).alias("other_id"), F.when(own, F.col("two_low")).otherwise(F.col("one_low")).alias("other_low"),
        "nodes",
    )
    bridges = reached.where(F.size("nodes") > 1).select(F.col("nodes")[0].alias("a"), F.explode("nodes").alias("b"))
    return whole.unionByName(merged(found, bridges))


def merged(found: DataFrame, bridges: DataFrame) -> DataFrame:
    """Passages from the verified runs of each document, each with its class: all passages that links lead to, from one to the next.

    ``nodes`` of a run are those of its links, and ``bridges (a, b)`` ties nodes. A passage may lie between others that
    have nothing in common; whatever text it names, its class holds them all.
    """
    rows = found.groupBy("doc_id", "low", "high").agg(
        F.bit_or("mask").alias("mask"), F.max(F.struct("equal", F.negative("other_id").alias("other"), "other_low")).alias("best"),
        F.array_distinct(F.flatten(F.collect_set("nodes"))).alias("nodes"),
    )
    in_order = Window.partitionBy("doc_id").orderBy("low", "high")
    reached = F.max("high").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("begins", F.coalesce(F.col("low") > reached, F.lit(True)).cast("int"))
    rows = written(rows.withColumn("passage", F.sum("begins").over(in_order)).drop("begins"), "runs")
    passages = rows.groupBy("doc_id", "passage").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.bit_or("mask").alias("mask"), F.max("best").alias("best")
    )
    vertex = F.xxhash64(F.lit("passage"), "doc_id", "passage")
    passages = written(passages.where(F.bit_count("mask") >= ENOUGH).withColumn("vertex", vertex), "passages")
    tied = components(rows.select(vertex.alias("a"), F.explode("nodes").alias("b")).unionByName(bridges))
    passages = attach(passages, tied, ["vertex"], spread_by=["doc_id"])
    passages = written(passages, "tied-passages")
    first = written(passages.groupBy("root").agg(F.min(F.struct("doc_id", "low")).alias("first")), "classes-of-passages")
    passages = attach(passages, first, ["root"], spread_by=["vertex"])
    return passages.select(
        "doc_id", F.col("low").alias("first_word"), (F.col("high") - F.col("low") + WORDS).cast("bigint").alias("n_words"),
        F.negative("best.other").alias("match_doc_id"), F.col("best.other_low").alias("match_first_word"),
        (F.col("best.equal") / (2 * SHINGLES - F.col("best.equal"))).alias("similarity"),
        F.bit_count("mask").alias("n_hashes"), F.lit(False).alias("whole_copy"),
        F.col("first.doc_id").alias("class_doc_id"), F.col("first.low").alias("class_first_word"),
    )


def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
