"""Token counts that follow edits.

The tokenizer cuts a text into pre-tokens, and a pre-token's tokens depend on nothing else. At some
places a pre-token begins whatever the rest of the text is: before a white space between
two other characters, and between a letter and a punctuation mark. A document is cut at such places into
leaves of about ``LEAF_CHARS`` characters, each a run of whole pre-tokens, and keeps their lengths
and, in a segment tree of sums over them, their tokens. An edit encodes again from the last cut before it to the first cut
after it, leaving a few characters on both sides which the cuts depend on: these cuts hold as before, so nothing outside
changes. Only the sums above changed leaves are written again; a region that has grown or
shrunk much is cut into new leaves.

:func:`segment_trees` makes the trees of documents as a table that can be written; :func:`edit_trees` takes such a table with edits and
gives one of the same form, for which only the edited regions are encoded. So a second round of edits costs what it touches.

Defined results: a null or empty text has no tokens and can be edited at 0. Edits are in the characters
of the text before any of them, do not overlap, and are applied from the last to the first; null replacement counts as
empty; an edit outside the text is an error, and so is a tree stored for a text of another length. Repeated rows are counted each by itself. A text without
such places is one leaf. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import ship_package, table
from linkloom.llm.pii import BASE_KINDS, personal_spans
from linkloom.llm.words import batches_by_bytes

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters of a leaf, at least; and what lies between an edit and the nearest cuts that it leaves alone.
LEAF_CHARS = 160
CONTEXT = 2
# A pre-token of the pattern above begins at each match, as no pre-token holds the characters on both sides.
CUT = re.compile(r"(?<=\S)\s(?=\S)|(?<=[^\W\d_])(?=[,.;:!?\u3001\u3002\uff01\uff0c\uff1f])")


class Counter:
    """Counts the tokens of texts under a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def tokens(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))


def read_ranks(path: str = TOKENIZER) -> dict[bytes, int]:
    lines = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in lines}


class TokenTree:
    """A text, the length of each leaf, and a segment tree of tokens over the leaves."""

    def __init__(self, text: str, counter: Counter):
        self.text, self.counter = text, counter
        self.encoded = 0  # characters encoded for edits
        lengths = self._cut(0, len(text))
        self._plant(lengths, self._count(0, lengths))

    @classmethod
    def stored(cls, text: str, lengths: list[int], sums: np.ndarray, counter: Counter) -> TokenTree:
        """The tree of ``text`` from its leaf lengths and sums; nothing is encoded."""
        if sum(lengths) != len(text):
            raise ValueError(f"tree of {sum(lengths)} characters for a text of {len(text)}")
        tree = cls.__new__(cls)
        tree.text, tree.counter, tree.encoded = text, counter, 0
        tree.lengths, tree.sums, tree.width = lengths, sums, len(sums) // 2
        return tree

    def _cut(self, begin: int, end: int, size: int = LEAF_CHARS) -> list[int]:
        """Lengths of the leaves of the characters ``begin`` to ``end``."""
        lengths, at = [], begin
        while end - at > size and (found := CUT.search(self.text, at + size, end)):
            lengths.append(found.start() - at)
            at = found.start()
        return [*lengths, end - at] if end > at else lengths

    def _count(self, begin: int, lengths: list[int]) -> list[int]:
        tokens = []
        for length in lengths:
            tokens.append(self.counter.tokens(self.text[begin : begin + length]))
            begin += length
        return tokens

    def _plant(self, lengths: list[int], tokens: list[int]) -> None:
        self.lengths = lengths
        self.width = 1 << max(0, len(tokens) - 1).bit_length()
        level = np.zeros(self.width, dtype=np.int64)
        level[: len(tokens)] = tokens
        levels = [level]
        while len(level) > 1:
            level = level.reshape(-1, 2).sum(axis=1)
            levels.append(level)
        # The root at 1, the children of i at 2i and 2i + 1.
        self.sums = np.concatenate([np.zeros(1, np.int64), *levels[::-1]])

    @property
    def tokens(self) -> int:
        return int(self.sums[1])

    def tokens_of(self, low: int, high: int) -> int:
        """Tokens of the leaves ``low`` to ``high``, from the sums of O(log n) subtrees."""
        total, low, high = 0, low + self.width, high + self.width
        while low < high:
            if low & 1:
                total, low = total + int(self.sums[low]), low + 1
            if high & 1:
                high -= 1
                total += int(self.sums[high])
            low, high = low >> 1, high >> 1
        return total

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replace the characters ``start`` to ``end``."""
        if not 0 <= start <= end <= len(self.text):
            raise ValueError(f"edit {start}:{end} outside a text of {len(self.text)} characters")
        bounds = [0, *np.cumsum(self.lengths).tolist()]
        first = max(0, bisect_right(bounds, start - CONTEXT) - 1)
        last = min(max(bisect_left(bounds, end + CONTEXT), first + 1), len(self.lengths))
        begin, old = bounds[first], last - first
        self.text = self.text[:start] + replacement + self.text[end:]
        stop = bounds[last] + len(replacement) - (end - start)
        lengths = self._cut(begin, stop)
        leaves = self._count(begin, lengths)
        self.encoded += stop - begin
        if len(lengths) == old:
            self.lengths[first:last] = lengths
            self._update(first, leaves)
        else:
            kept = self.sums[self.width : self.width + len(self.lengths)].tolist()
            self._plant(self.lengths[:first] + lengths + self.lengths[last:], kept[:first] + leaves + kept[last:])

    def _update(self, first: int, tokens: list[int]) -> None:
        low, high = self.width + first, self.width + first + len(tokens) - 1
        self.sums[low : high + 1] = tokens
        while low > 1:
            low, high = low >> 1, high >> 1
            for i in range(low, high + 1):
                self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]


_counters: list[tuple[dict, Counter]] = []


def _counter(ranks: dict[bytes, int]) -> Counter:
    """The counter of this process, kept from one task to the next."""
    if not _counters or _counters[0][0] is not ranks:
        _counters[:] = [(ranks, Counter(ranks))]
    return _counters[0][1]


def mask_edits(text: str) -> list[tuple[int, int, str]]:
    """Edits which mask personal data and cut runs of exclamation marks to one, in order and without overlap."""
    spans = [(low, high, f"[{kind}]") for kind, low, high in personal_spans(text) if kind in BASE_KINDS]
    spans += [(m.start() + 1, m.end(), "") for m in re.finditer(r"!{2,}", text)]
    out: list[tuple[int, int, str]] = []
    for low, high, new in sorted(spans, key=lambda s: (s[0], -s[1])):
        if not out or low >= out[-1][1]:
            out.append((low, high, new))
    return out


EDITS = "array<struct<start: bigint, end: bigint, replacement: string>>"
_TREE = "doc_id bigint, text string, lengths array<int>, sums array<bigint>"


def _lists(arrays: list, kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *(len(a) for a in arrays)], dtype=np.int32)
    values = np.concatenate([np.zeros(0, np.int64), *arrays]).astype(kind.to_pandas_dtype())
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def _tree_columns(ids: pa.Array, trees: list[TokenTree]) -> list[pa.Array]:
    return [ids, pa.array([t.text for t in trees], pa.string()), _lists([t.lengths for t in trees], pa.int32()), _lists([t.sums for t in trees], pa.int64())]


def segment_trees(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, text, lengths, sums``, and ``edits`` where ``docs(doc_id, text)`` has it: the segment tree of each document.

    ``lengths`` are the characters of the leaves; ``sums`` has the tokens of the text at 1, those of the halves of the subtree ``i`` at
    ``2i`` and ``2i + 1``, and those of the leaves in its second half. The vocabulary is read by the driver and sent to the tasks once.
    """
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(read_ranks(tokenizer))  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(sent.value)
        for whole in batches:
            for batch in batches_by_bytes(whole, "text"):
                trees = [TokenTree(text or "", counter) for text in batch.column("text").to_pylist()]
                more = [batch.column(i) for i in range(2, len(batch.schema))]
                yield pa.RecordBatch.from_arrays([*_tree_columns(batch.column("doc_id"), trees), *more], [*_NAMES, *batch.schema.names[2:]])

    more = ["edits"] if "edits" in docs.columns else []
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *(F.col(c).cast(EDITS).alias(c) for c in more))
    return rows.mapInArrow(run, ", ".join([_TREE, *(f"{c} {EDITS}" for c in more)]))


_NAMES = ["doc_id", "text", "lengths", "sums"]
_FIGURES = ["n_tokens", "n_edits", "n_tokens_edited", "n_chars_edited", "n_chars_reencoded"]


def edit_trees(trees: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """The trees of the edited texts, from ``trees(doc_id, text, lengths, sums, edits)``, and what changed.

    Columns: ``doc_id, text, lengths, sums, n_tokens, n_edits, n_tokens_edited, n_chars_edited, n_chars_reencoded``. ``edits`` is an array of
    (start, end, replacement), or null where :func:`mask_edits` is to give them. Only the regions that edits touch are encoded.
    """
    spark = trees.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(read_ranks(tokenizer))  # as large as the vocabulary

    def edited(row: int, text: str, edits: list[dict] | None, lengths: pa.ListArray, sums: pa.ListArray, counter: Counter) -> tuple:
        own = sums[row].values.to_numpy(zero_copy_only=False).astype(np.int64)
        tree = TokenTree.stored(text, lengths[row].values.to_pylist(), own, counter)
        before = tree.tokens
        wanted = mask_edits(text) if edits is None else [(e["start"], e["end"], e["replacement"] or "") for e in edits]
        for start, end, new in sorted(wanted, reverse=True):
            tree.edit(start, end, new)
        return tree, (before, len(wanted), tree.tokens, len(tree.text), tree.encoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(sent.value)
        for whole in batches:
            for batch in batches_by_bytes(whole, "text"):
                texts, edits = batch.column("text").to_pylist(), batch.column("edits").to_pylist()
                kept = batch.column("lengths"), batch.column("sums")
                done = [edited(i, text, wanted, *kept, counter) for i, (text, wanted) in enumerate(zip(texts, edits, strict=True))]
                figures = [pa.array([figure[i] for _, figure in done], pa.int64()) for i in range(len(_FIGURES))]
                columns = [*_tree_columns(batch.column("doc_id"), [tree for tree, _ in done]), *figures]
                yield pa.RecordBatch.from_arrays(columns, [*_NAMES, *_FIGURES])

    rows = trees.select(*_NAMES, F.col("edits").cast(EDITS).alias("edits"))
    return rows.mapInArrow(run, ", ".join([_TREE, *(f"{c} bigint" for c in _FIGURES)]))


def edited_counts(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, n_tokens, n_edits, n_tokens_edited, n_chars_edited, n_chars_reencoded`` of ``docs(doc_id, text, edits)``.

    The trees of the documents, edited; neither is written.
    """
    return edit_trees(segment_trees(docs, tokenizer), tokenizer).select("doc_id", *_FIGURES)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return edited_counts(docs.withColumn("edits", F.lit(None).cast(EDITS)))
