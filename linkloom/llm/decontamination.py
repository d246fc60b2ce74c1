"""Benchmark decontamination: rare words as seeds, then Smith-Waterman alignment.

1. The benchmark is taken in blocks of bounded size, each against all documents, and the number of documents
   with each word of the block is counted.
2. An item is found if its best local alignment with a document (match 2, other word -1, gap -1) reaches half of
   what the whole item would score. Such an alignment matches at least half of the item's words and spans at most
   twice as many words of the document as the item has. So of the rarest half of an item's words and ``t`` more, at
   least ``t`` are matched in such a span, however the copy is edited: these words are its seeds. A word that is in no
   document only makes fewer places qualify.
3. Around such seeds, a stretch of the document is left that holds every alignment through them. Of this only the places stay
   that lie in some span which would reach the score if each word that the item has were matched. What
   stays is aligned word by word.

No step can lose an alignment that reaches the score. Only counts per word of a block leave the tasks; a document
is aligned in the task that reads it.

Defined results: null or blank texts contain nothing; items of fewer than eight words say too
little to be found, null ones too. Equal items are found each under its own id. Documents that repeat an
id are one in the result, with their best alignment; rows without id are not searched. An
empty table on either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import drop_documents, passing, ship_package, table, written
from linkloom.llm.words import batches_by_bytes, words_of

LEAST_WORDS = 8
LEAST_SCORE = 0.5
BLOCK_BYTES = 16 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
# Of an item's words, the share that has to be met among its seeds before a place is looked at.
SEED_SHARE = 1 / 8
# Items searched at once, and places or cells of scores held at once.
GROUP_ITEMS = 512
_PLACES = 1 << 20
# Alignments done at once.
_BATCH = 256
_FILTER_BITS = 21


class Vocabulary(NamedTuple):
    """The different words of all items in order."""

    words: np.ndarray
    maybe: np.ndarray


class Seeds(NamedTuple):
    """Seeds of the items from ``begin`` on.

    Words ``names[i]``, by number in the vocabulary, are seeds of ``items[first[i]:first[i + 1]]``, in which they stand
    from word ``low`` to word ``high``. ``least`` of an item's seeds must be met. ``own`` has all words of the items as
    item times the size of the vocabulary plus word.
    """

    begin: int
    names: np.ndarray
    first: np.ndarray
    items: np.ndarray
    low: np.ndarray
    high: np.ndarray
    lengths: np.ndarray
    least: np.ndarray
    own: np.ndarray


class Items(NamedTuple):
    ids: list
    words: list[np.ndarray]


def read_items(block: pa.Table) -> Items:
    found = words_of(block.column("text").combine_chunks() if block.num_rows else pa.array([], pa.string()))
    ids, words = [], []
    for i, item in enumerate(block.column("item_id").to_pylist()):
        own = found.hashes[found.bounds[i] : found.bounds[i + 1]]
        if len(own) >= LEAST_WORDS:
            ids.append(item)
            words.append(own)
    return Items(ids, words)


def index_words(items: Items) -> Vocabulary:
    words = np.unique(np.concatenate([np.zeros(0, np.uint64), *items.words]))
    maybe = np.zeros(1 << _FILTER_BITS, dtype=bool)
    maybe[words >> np.uint64(64 - _FILTER_BITS)] = True
    return Vocabulary(words, maybe)


def find_words(vocabulary: Vocabulary, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``words`` at which a word of the vocabulary stands, and which word it is."""
    if len(vocabulary.words) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(vocabulary.maybe[words >> np.uint64(64 - _FILTER_BITS)])
    which = np.searchsorted(vocabulary.words, words[at])
    which[which == len(vocabulary.words)] = 0
    hit = vocabulary.words[which] == words[at]
    return at[hit], which[hit]


def seeds_of(items: Items, vocabulary: Vocabulary, counts: np.ndarray) -> Iterator[Seeds]:
    """Seeds of groups of items; ``counts`` has the number of documents of each word of the vocabulary."""
    for begin in range(0, len(items.words), GROUP_ITEMS):
        group = items.words[begin : begin + GROUP_ITEMS]
        lengths = np.array([len(w) for w in group])
        matched = np.ceil(LEAST_SCORE * lengths).astype(np.int64)
        least = np.maximum(1, np.minimum(matched, (SEED_SHARE * lengths).astype(np.int64)))
        names, of, at, every = [], [], [], []
        for i, own in enumerate(group):
            which = np.searchsorted(vocabulary.words, own)
            every.append(i * len(vocabulary.words) + which)
            places = np.argsort(counts[which], kind="stable")[: lengths[i] - matched[i] + least[i]]
            # A word that stands among the seeds at one place can be matched at any place it has in the item.
            places = np.flatnonzero(np.isin(which, which[places]))
            names.append(which[places])
            of.append(np.full(len(places), i))
            at.append(places)
        name, item, place = np.concatenate(names), np.concatenate(of), np.concatenate(at)
        order = np.lexsort((place, item, name))
        name, item, place = name[order], item[order], place[order]
        fresh = np.flatnonzero(np.append(True, (name[1:] != name[:-1]) | (item[1:] != item[:-1])))
        low, high = place[fresh], place[np.append(fresh[1:], len(place)) - 1]
        different, first = np.unique(name[fresh], return_index=True)
        yield Seeds(begin, different, np.append(first, len(fresh)), item[fresh], low, high, lengths, least, np.unique(np.concatenate(every)))


def align(item: np.ndarray, stretches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of ``item`` in each row of ``stretches`` and the place where that alignment ends.

    Zero stands for no word. A row of the score matrix needs its left neighbours only for gaps, and
    these are a running maximum.
    """
    rows, width = stretches.shape
    slope = np.arange(width, dtype=np.int32) * GAP
    last = np.zeros((rows, width), dtype=np.int32)
    best, end = np.zeros(rows, dtype=np.int32), np.zeros(rows, dtype=np.int64)
    for word in item:
        step = np.where(stretches == word, MATCH, MISMATCH).astype(np.int32)
        step[:, 1:] += last[:, :-1]
        now = np.maximum(np.maximum(step, last + GAP), 0)
        now = np.maximum.accumulate(now - slope, axis=1) + slope
        top = now.argmax(axis=1)
        value = now[np.arange(rows), top]
        better = value > best
        best[better], end[better] = value[better], top[better]
        last = now
    return best, end


def seeded_stretches(seeds: Seeds, bounds: np.ndarray, at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Item, low and high of stretches that hold every alignment which can reach the score.

    ``which`` are the words of the vocabulary at the places ``at``; a stretch stays in its text ``bounds[i]:bounds[i + 1]``.
    """
    none = np.zeros(0, np.int64)
    spot = np.searchsorted(seeds.names, which)
    spot[spot == len(seeds.names)] = 0
    hit = seeds.names[spot] == which
    at, spot = at[hit], spot[hit]
    if not len(at):
        return none, none, none
    count = seeds.first[spot + 1] - seeds.first[spot]
    entry = np.repeat(seeds.first[spot] - np.cumsum(count) + count, count) + np.arange(count.sum())
    place, item = np.repeat(at, count), seeds.items[entry]
    order = np.argsort(item * bounds[-1] + place, kind="stable")
    place, item, entry = place[order], item[order], entry[order]
    row, length = np.searchsorted(bounds, place, "right") - 1, seeds.lengths[item]
    # Enough seeds of the item in the span that an alignment has at most.
    begin = np.arange(len(item))
    end = begin + seeds.least[item] - 1
    begin, end = begin[end < len(item)], end[end < len(item)]
    enough = (item[end] == item[begin]) & (row[end] == row[begin]) & (place[end] - place[begin] < 2 * length[begin])
    change = np.zeros(len(item) + 1, dtype=np.int64)
    np.add.at(change, begin[enough], 1)
    np.add.at(change, end[enough] + 1, -1)
    kept = np.cumsum(change)[:-1] > 0
    place, item, entry, row, length = place[kept], item[kept], entry[kept], row[kept], length[kept]
    if not len(place):
        return none, none, none
    # As many words as the item has may have been put in on either side.
    low = np.maximum(bounds[row], place - seeds.high[entry] - length)
    high = np.minimum(bounds[row + 1], place - seeds.low[entry] + 2 * length)
    reached = np.maximum.accumulate(high + item * (bounds[-1] + 1))
    fresh = np.flatnonzero(np.append(True, low[1:] + item[1:] * (bounds[-1] + 1) >= reached[:-1]))
    return item[fresh], np.minimum.reduceat(low, fresh), np.maximum.reduceat(high, fresh)


def possible_stretches(
    seeds: Seeds, size: int, numbers: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts of the stretches whose places lie in a span that reaches the score if all words it shares with the item match.

    ``numbers`` are the words of the vocabulary, which has ``size``, at all places, or -1.
    """
    width = high - low
    begins = np.cumsum(width) - width
    of = np.repeat(np.arange(len(item)), width)
    place = np.repeat(low - begins, width) + np.arange(width.sum())
    number = numbers[place]
    known = np.flatnonzero(number >= 0)
    key = item[of[known]] * size + number[known]
    spot = np.searchsorted(seeds.own, key)
    spot[spot == len(seeds.own)] = 0
    step = np.full(len(place), max(MISMATCH, GAP), dtype=np.int64)
    step[known[seeds.own[spot] == key]] = MATCH
    # Each stretch lies so far below the one before that running minima and maxima begin anew.
    apart = of * (4 * len(place) + 4)
    total = np.cumsum(step)
    lowest = np.minimum.accumulate(total - step - apart) + apart
    highest = np.maximum.accumulate((total - apart)[::-1])[::-1] + apart
    covered = highest - lowest >= LEAST_SCORE * MATCH * seeds.lengths[item[of]]
    edge = np.flatnonzero(covered & np.append(True, ~covered[:-1] | (of[1:] != of[:-1])))
    last = np.flatnonzero(covered & np.append(~covered[1:] | (of[1:] != of[:-1]), True))
    return item[of[edge]], place[edge], place[last] + 1


def stretches_of(groups: list[Seeds], vocabulary: Vocabulary, words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``(item, low, high)``: the stretches of ``words``, of the texts ``bounds[i]:bounds[i + 1]``, to align with an item."""
    at, which = find_words(vocabulary, words)
    numbers = np.full(len(words), -1, dtype=np.int64)
    numbers[at] = which
    for seeds in groups:
        item, low, high = seeded_stretches(seeds, bounds, at, which)
        sums = np.cumsum(high - low)
        first = 0
        while first < len(item):
            end = max(first + 1, int(np.searchsorted(sums, sums[first] + _PLACES)))
            some = possible_stretches(seeds, len(vocabulary.words), numbers, item[first:end], low[first:end], high[first:end])
            yield from zip((some[0] + seeds.begin).tolist(), some[1].tolist(), some[2].tolist(), strict=True)
            first = end


def scored(items: Items, tasks: list[tuple[int, int, np.ndarray]]) -> Iterator[tuple[int, int, float, int, int]]:
    """``(row, item, share, first, last)`` of the tasks ``(row, item, words)`` in which the item is found."""
    tasks = sorted(tasks, key=lambda t: (t[1], len(t[2])))
    low = 0
    while low < len(tasks):
        item = tasks[low][1]
        high = low + 1
        while high < len(tasks) and high - low < _BATCH and tasks[high][1] == item and len(tasks[high][2]) <= 2 * len(tasks[low][2]):
            if (high + 1 - low) * len(tasks[high][2]) > _PLACES:
                break
            high += 1
        own = items.words[item]
        grid = np.zeros((high - low, len(tasks[high - 1][2])), dtype=np.uint64)
        for i, task in enumerate(tasks[low:high]):
            grid[i, : len(task[2])] = task[2]
        best, end = align(own, grid)
        for i in np.flatnonzero(best >= LEAST_SCORE * MATCH * len(own)):
            back, first = align(own[::-1], grid[i : i + 1, : end[i] + 1][:, ::-1])
            yield tasks[low + i][0], item, float(best[i]) / (MATCH * len(own)), int(end[i] - first[0]), int(end[i])
        low = high


def count_words(docs: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """The number of documents with each word of the vocabulary."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # at most a block of the benchmark

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        size = len(vocabulary.words)
        counts = np.zeros(size, dtype=np.int64)
        for whole in batches:
            for batch in batches_by_bytes(whole, "text"):
                found = words_of(batch.column("text"))
                at, which = find_words(vocabulary, found.hashes)
                row = np.searchsorted(found.bounds, at, "right") - 1
                np.add.at(counts, np.unique(row * size + which) % size, 1)
        word = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(counts[word])], ["word", "docs"])

    # As many rows as the block has different words.
    rows = docs.select("text").mapInArrow(run, "word bigint, docs bigint").groupBy("word").agg(F.sum("docs").alias("docs")).toArrow()
    counts = np.zeros(len(vocabulary.words), dtype=np.int64)
    counts[rows.column("word").to_numpy()] = rows.column("docs").to_numpy()
    return counts


def alignments(docs: DataFrame, items: Items, vocabulary: Vocabulary, groups: list[Seeds]) -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word`` of the items found in each row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast((items, vocabulary, groups))  # at most a block of the benchmark

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, vocabulary, groups = sent.value
        for whole in batches:
            for batch in batches_by_bytes(whole, "text", 1 << 20):
                found = words_of(batch.column("text"))
                tasks, begin = [], []
                for item, low, high in stretches_of(groups, vocabulary, found.hashes, found.bounds):
                    row = int(np.searchsorted(found.bounds, low, "right")) - 1
                    tasks.append((len(begin), item, found.hashes[low:high]))
                    begin.append((row, low - int(found.bounds[row])))
                hits = list(scored(items, tasks))
                ids = batch.column("doc_id").take(pa.array([begin[h[0]][0] for h in hits], pa.int64()))
                arrays = [
                    ids, pa.array([items.ids[h[1]] for h in hits], pa.int64()), pa.array([h[2] for h in hits], pa.float64()),
                    pa.array([begin[h[0]][1] + h[3] for h in hits], pa.int64()), pa.array([begin[h[0]][1] + h[4] for h in hits], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "item_id", "score", "first_word", "last_word"])

    return docs.mapInArrow(run, "doc_id bigint, item_id bigint, score double, first_word bigint, last_word bigint")


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word``: the items found in documents, best alignment of each pair."""
    ship_package(docs.sparkSession)
    docs = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    items = benchmark.where("text is not null").select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 32), F.lit(0))).first()[0]
    blocks = -(-size // block_bytes)
    found = None
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text")
        part = _search(docs, read_items(mine.toArrow()))
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = alignments(docs.limit(0), Items([], []), index_words(Items([], [])), [])
    best = F.max(F.struct("score", F.negative("first_word").alias("first"), "last_word")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.score", F.negative("best.first").alias("first_word"), "best.last_word"
    )


def _search(docs: DataFrame, items: Items) -> DataFrame:
    vocabulary = index_words(items)
    return alignments(docs, items, vocabulary, list(seeds_of(items, vocabulary, count_words(docs, vocabulary))))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without the documents in which an item of the benchmark is found; rows without id are left alone."""
    with passing(spark) as kept:
        found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
        kept.append(written(found.select("doc_id").distinct(), "contaminated-ids"))
    return drop_documents(docs, kept[0], "doc_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
