"""Main text of web pages by markup and by a suffix array per host.

Markup first: blocks in menus, headers, footers, sidebars, notices, adverts, forms and reader
comments go; articles and the main element are taken whole. A class name of several words or a form makes boilerplate only of
what holds no article, unless the page has another. What the markup does not
decide is left to the host: the token streams of its pages are put one after the other, their
suffixes ranked by prefix doubling to eight tokens, and every run of equal suffixes that
occurs on enough different pages is boilerplate. Undecided blocks lose the tokens that
such runs cover and keep the rest.

A run counts if at least two pages and three tenths of the host's different pages have it; pages with
equal streams are one. A page that is covered by nine tenths is a copy of
other pages and not boilerplate; it stays as it is. Text in an article is never removed for being
repeated: mirrored pages and quoted passages are content.

Runs are always counted over the whole host. A host of a few hundred pages is one task's; of a larger one each page gives
the hashes of its runs, Spark counts on how many different pages each occurs, and the frequent ones, which
are few, go back to the pages. Both ways give the same text, and no task holds a large host.

Defined results: a null or empty page has no text; a page whose text is all boilerplate has none
either. Pages without url are one host. Rows that repeat give equal results. An empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import attach, ship_package, table, written
from linkloom.llm.html import blocks_of
from linkloom.llm.words import batches_by_bytes, shingles, words_of

# Pages and bytes of a host that one task takes whole.
SHARD_PAGES = 256
SHARD_BYTES = 8 << 20
# Tokens that a repeated run has at least: two to this power.
DOUBLINGS = 3
RUN = 1 << DOUBLINGS
LEAST_SHARE = 0.3
COPY_SHARE = 0.9


def decided_blocks(html: str) -> tuple[bool, list[str]]:
    """Whether the markup names the article, and its blocks or else all that it leaves undecided."""
    blocks = list(blocks_of(html))
    kinds = {b.kind for b in blocks}
    # Title and lead may stand in the main element beside the article.
    for chosen in (("article", "main"), ("inner",)):
        if not kinds.isdisjoint(chosen):
            return True, [b.text for b in blocks if b.kind in chosen]
    return False, [b.text for b in blocks if b.kind == "plain"]


def repeated_tokens(streams: list[np.ndarray], least_share: float = LEAST_SHARE) -> list[np.ndarray]:
    """For each stream of token numbers, which of its tokens lie in a run that enough different streams have."""
    if not streams:
        return []
    # Streams with the same tokens are one page; a number of its own ends each stream.
    names = {}
    page = np.array([names.setdefault(s.tobytes(), len(names)) for s in streams])
    lengths = np.array([len(s) for s in streams])
    numbers = 1 + max((int(s.max()) for s in streams if len(s)), default=0)
    text = np.concatenate([np.append(s, numbers + i) for i, s in enumerate(streams)]).astype(np.int64)
    of = np.repeat(page, lengths + 1)
    # Rank of each suffix by its first 1, 2, 4 and 8 tokens.
    rank = np.unique(text, return_inverse=True)[1]
    for k in range(DOUBLINGS):
        step = 1 << k
        after = np.zeros(len(text), dtype=np.int64)
        after[:-step] = rank[step:] + 1
        rank = np.unique(rank * (len(text) + 1) + after, return_inverse=True)[1]
    pairs = np.unique(rank * np.int64(len(names)) + of)
    pages = np.bincount(pairs // len(names), minlength=rank.max() + 1)
    need = max(2, int(np.ceil(least_share * len(names))))
    starts = np.flatnonzero(pages[rank] >= need)
    change = np.zeros(len(text) + (1 << DOUBLINGS) + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + (1 << DOUBLINGS), -1)
    covered = np.cumsum(change)[: len(text)] > 0
    ends = np.cumsum(lengths + 1)
    return [covered[e - n - 1 : e - 1] for e, n in zip(ends, lengths, strict=True)]


def unique_text(blocks: list[str], covered: np.ndarray) -> str:
    """The blocks without covered tokens."""
    out, at = [], 0
    for block in blocks:
        words = block.split(" ")
        kept = [w for w, c in zip(words, covered[at : at + len(words)], strict=True) if not c]
        at += len(words)
        if kept:
            out.append(" ".join(kept))
    return "\n".join(out)


def _shard(pages: pa.Table) -> pa.Table:
    numbers: dict[str, int] = {}
    named, blocks = pages.column("named").to_pylist(), pages.column("blocks").to_pylist()
    streams = [np.array([numbers.setdefault(w, len(numbers)) for b in own for w in b.split(" ")], dtype=np.int64) for own in blocks]
    texts = []
    for whole, own, covered in zip(named, blocks, repeated_tokens(streams), strict=True):
        if whole or not own or covered.mean() >= COPY_SHARE:
            texts.append("\n".join(own))
        else:
            texts.append(unique_text(own, covered))
    result = pages.select(["page_id", "url"]).append_column("text", pa.array(texts, pa.string()))
    return result.append_column("n_chars", pa.array([len(t) for t in texts], pa.int64()))


def page_blocks(pages: DataFrame) -> DataFrame:
    """``page_id, url, named, blocks`` of every row of ``pages(page_id, url, html)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_by_bytes(whole, "html"):
                found = [decided_blocks(h or "") for h in batch.column("html").to_pylist()]
                named, blocks = pa.array([f[0] for f in found], pa.bool_()), pa.array([f[1] for f in found], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), named, blocks], ["page_id", "url", "named", "blocks"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id bigint, url string, named boolean, blocks array<string>")


def run_hashes(blocks: list[str]) -> np.ndarray:
    """A hash for each run of :data:`RUN` tokens of a page, in order."""
    tokens = words_of(pa.array([" ".join(blocks)], pa.string()), lower=False).hashes
    return shingles(tokens, RUN).view(np.int64) if len(tokens) >= RUN else np.zeros(0, dtype=np.int64)


def run_rows(pages: DataFrame) -> DataFrame:
    """``host, page, run`` of each different run of each row of ``pages(host, page, blocks)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, blocks in enumerate(batch.column("blocks").to_pylist()):
                runs = np.unique(run_hashes(blocks))
                for low in range(0, len(runs), 1 << 16):
                    part = pa.array(runs[low : low + (1 << 16)])
                    same = pa.array(np.full(len(part), i))
                    yield pa.RecordBatch.from_arrays([batch.column("host").take(same), batch.column("page").take(same), part], ["host", "page", "run"])

    return pages.select("host", "page", "blocks").mapInArrow(run, "host string, page bigint, run bigint")


def frequent_runs(pages: DataFrame) -> DataFrame:
    """``host, runs``, written: the runs on enough different pages of each host of ``pages(host, named, blocks)`` that has undecided ones.

    A run is on three tenths of the different pages, so a host has no more of them than a few pages have tokens.
    """
    undecided = written(pages.where(~F.col("named") & (F.size("blocks") > 0)).select("host").distinct(), "undecided-hosts")
    page = F.xxhash64(F.array_join("blocks", " "))
    streams = attach(pages.withColumn("page", page), undecided, ["host"], "left_semi", spread_by=["page"])
    sizes = written(streams.groupBy("host").agg(F.count_distinct("page").alias("pages")), "host-pages")
    counts = run_rows(streams).groupBy("host", "run").agg(F.count_distinct("page").alias("on"))
    counts = attach(counts.where("on > 1"), sizes, ["host"], spread_by=["run"])
    often = counts.where(F.col("on") >= F.ceil(F.lit(LEAST_SHARE) * F.col("pages")))
    return written(often.groupBy("host").agg(F.collect_list("run").alias("runs")), "frequent-runs")


def covered_by(runs: np.ndarray, frequent: np.ndarray, tokens: int) -> np.ndarray:
    """Which of a page's tokens lie in one of the ``frequent`` runs."""
    change = np.zeros(tokens + 1, dtype=np.int64)
    starts = np.flatnonzero(np.isin(runs, frequent))
    change[starts] += 1
    change[starts + RUN] -= 1
    return np.cumsum(change)[:tokens] > 0


def page_texts(rows: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of ``rows(page_id, url, blocks, runs)``; without ``runs`` a page stays as it is."""

    def text_of(blocks: list[str], frequent: np.ndarray | None) -> str:
        if frequent is not None and blocks:
            covered = covered_by(run_hashes(blocks), frequent, sum(b.count(" ") + 1 for b in blocks))
            if covered.mean() < COPY_SHARE:
                return unique_text(blocks, covered)
        return "\n".join(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = (r.values.to_numpy() if r.is_valid else None for r in batch.column("runs"))
            texts = [text_of(b, r) for b, r in zip(batch.column("blocks").to_pylist(), runs, strict=True)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes], TEXTS_NAMES)

    return rows.select("page_id", "url", "blocks", "runs").mapInArrow(run, TEXTS)


TEXTS = "page_id bigint, url string, text string, n_chars bigint"
TEXTS_NAMES = ["page_id", "url", "text", "n_chars"]


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``."""
    ship_package(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    hosts = pages.select(host.alias("host"), size.alias("size")).groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.sum("size").alias("size"))
    large = written(hosts.where((F.col("pages") > SHARD_PAGES) | (F.col("size") > SHARD_BYTES)).select("host"), "large-hosts")
    hosted = pages.select("page_id", "url", "html", host.alias("host"))
    # Each page is parsed once: those of large hosts are stored, the others go to the task of their host.
    small = page_blocks(attach(hosted, large, ["host"], "left_anti", spread_by=["page_id"])).withColumn("host", host)
    texts = small.groupBy("host").applyInArrow(_shard, TEXTS)
    if large.isEmpty():
        return texts
    stored = written(page_blocks(attach(hosted, large, ["host"], "left_semi", spread_by=["page_id"])).withColumn("host", host), "host-blocks")
    runs = frequent_runs(stored).withColumnRenamed("host", "of")
    # Pages that the markup decides take no runs.
    rows = stored.withColumn("of", F.when(~F.col("named"), F.col("host")))
    return texts.unionByName(page_texts(attach(rows, runs, ["of"], "left", spread_by=["page_id"])))


def op6_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
