"""Near-duplicate documents by min-max hashing.

Each permutation of a document's shingle set gives two signature values, the smallest and the
largest hash, so that 144 permutations make 288 values. Bands of six values bring similar
documents together; a link is confirmed on the full sets. With 48 bands two documents of
similarity 0.8 share none with probability 5e-7.

Nothing is done for all pairs of a group:

1. Documents with equal shingle sets are one node, which counts once.
2. In each band value the node that shares most bands with others is the centre and is compared
   with each other node there. This links nearly all of a group, with one comparison per row.
3. Band values that still hold several components are searched for the rest in blocks of nodes. Nodes of the largest
   component there are compared with the others only. Inside a task a pair of different components is compared in the first band
   value that it shares: by longer signatures, one byte per value, and if these can reach the similarity
   (five standard errors below 0.8 at least) by the full sets. A link joins its components there and then, so that a block
   gives fewer links than it has components, not all of its pairs.

Defined results: null or blank texts have no shingles and are linked with nothing. A text with
fewer words than a shingle is one shingle. Rows without id are linked with nothing and get
their own null id. Rows that repeat an id are nodes of their own; their ids fall together in
the result. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import HOT_ROWS, attach, drop_documents, ids_not_kept, passing, ship_package, table, written
from linkloom.llm.components import components
from linkloom.llm.words import batches_by_bytes, mix, shingles, words_of

PERCENT = 80
PERMUTATIONS = 144
ROWS_PER_BAND = 6
BANDS = 2 * PERMUTATIONS // ROWS_PER_BAND
# Permutations of the signatures for the rest, and the share of equal values which a link cannot well stay
# below: the expected one at similarity 0.8, less five standard errors. One in 256 other bytes is equal by chance.
FINE_PERMUTATIONS = 576
LEAST_EQUAL = 0.8 + 0.2 / 256 - 5 * (0.16 / (2 * FINE_PERMUTATIONS)) ** 0.5
# Nodes of one band value are compared in blocks of about this many, and of about as many bytes of shingles.
BLOCK_NODES = 512
BLOCK_BYTES = 16 << 20
# Shingles hashed at once under all permutations.
_CHUNK = 1024

_draw = np.random.default_rng(20_260_101)
_FACTORS = (_draw.integers(0, 1 << 32, FINE_PERMUTATIONS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_SHIFTS = _draw.integers(0, 1 << 32, FINE_PERMUTATIONS, dtype=np.uint64).astype(np.uint32)


def min_max_signature(members: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """Smallest and largest hash of the set under each permutation, in turn."""
    out = np.empty(2 * permutations, dtype=np.uint32)
    short = (members >> np.uint64(32)).astype(np.uint32)
    for low in range(0, len(short), _CHUNK):
        hashed = np.multiply.outer(_FACTORS[:permutations], short[low : low + _CHUNK])
        hashed += _SHIFTS[:permutations, None]
        least, most = hashed.min(axis=1), hashed.max(axis=1)
        if low:
            least, most = np.minimum(least, out[0::2]), np.maximum(most, out[1::2])
        out[0::2], out[1::2] = least, most
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per row of ``signatures`` and band."""
    values = signatures.reshape(len(signatures), BANDS, ROWS_PER_BAND).astype(np.uint64)
    keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(signatures), 1))
    for i in range(ROWS_PER_BAND):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, :, i])
    return keys.view(np.int64)


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    found = words_of(texts)
    for low, high in zip(found.bounds[:-1], found.bounds[1:], strict=True):
        yield np.unique(shingles(found.hashes[low:high], words))


def node_of(members: np.ndarray) -> bytes:
    """A 128-bit name of a shingle set."""
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def set_signatures(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, node, n_shingles, bands`` of every row of ``docs(doc_id, text)``; no node for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_by_bytes(whole, "text"):
                nodes, sizes, rows = [], [], []
                for members in shingle_sets(batch.column("text"), words):
                    nodes.append(node_of(members) if len(members) else None)
                    sizes.append(len(members))
                    if len(members):
                        rows.append(min_max_signature(members))
                keys = band_keys(np.array(rows, dtype=np.uint32).reshape(len(rows), 2 * PERMUTATIONS))
                lengths = np.where(np.array(sizes) > 0, BANDS, 0)
                bands = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32), keys.ravel())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), bands],
                    ["doc_id", "node", "n_shingles", "bands"],
                )

    return docs.mapInArrow(run, "doc_id bigint, node binary, n_shingles bigint, bands array<bigint>")


def node_texts(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``node, text``, written: the text of each row of ``nodes(node, first_id)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_by_bytes(whole, "text"):
                names = [node_of(s) if len(s) else None for s in shingle_sets(batch.column("text"), words)]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), batch.column("text")], ["node", "text"])

    ids = written(nodes.select(F.col("first_id").alias("doc_id")).distinct(), "text-ids")
    texts = attach(docs, ids, ["doc_id"], "left_semi", spread_by=["doc_id"]).select("text")
    texts = texts.mapInArrow(run, "node binary, text string")
    # An id may stand on several rows, with other texts or the same one.
    return written(attach(texts, nodes.select("node"), ["node"], "left_semi").dropDuplicates(["node"]), "node-texts")


def confirmed(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """The rows of ``pairs(a, b)`` whose shingle sets reach the similarity, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_by_bytes(whole, "text_a"):
                sets = zip(shingle_sets(batch.column("text_a"), words), shingle_sets(batch.column("text_b"), words), strict=True)
                links = []
                for one, other in sets:
                    both = len(np.intersect1d(one, other, assume_unique=True))
                    links.append(100 * both >= PERCENT * (len(one) + len(other) - both))
                yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))

    of_a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    of_b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = attach(pairs, of_b, ["b"], spread_by=["a"], broadcast_bytes=0)
    hot = written(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > HOT_ROWS), "hot-texts")
    rows = attach(rows, of_a, ["a"], spread_by=["b"], broadcast_bytes=0, hot=hot)
    return written(rows.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary"), "links")


def shared_bands(nodes: DataFrame) -> DataFrame:
    """``band, node, n_shingles, first_id, size``, written: band values of two nodes or more, and how many."""
    rows = nodes.select("node", "n_shingles", "first_id", F.explode("bands").alias("band"))
    sizes = written(rows.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared-bands")
    hot = sizes.where(F.col("size") > HOT_ROWS).select("band", F.col("size").alias("_rows"))
    # By key at every size, like the other joins with one row per band value or text: they grow with the documents.
    return written(attach(rows, sizes, ["band"], spread_by=["node"], broadcast_bytes=0, hot=hot), "band-members")


def _alike(one: str, other: str):
    """Whether sets of these sizes can reach the similarity at all."""
    return F.least(one, other) * 100 >= F.greatest(one, other) * PERCENT


def centre_pairs(members: DataFrame) -> DataFrame:
    """``a, b``, written: in each band value, the node with most companions and each other node."""
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    weight = written(weight, "weights")
    ranked = attach(members, weight, ["node"], spread_by=["band"])
    best = F.max(F.struct("weight", "node", "n_shingles")).alias("best")
    centres = ranked.groupBy("band").agg(best).select("band", F.col("best.node").alias("a"), F.col("best.n_shingles").alias("n_a"))
    pairs = attach(members, written(centres, "centres"), ["band"], spread_by=["node"], broadcast_bytes=0)
    pairs = pairs.where((F.col("a") != F.col("node")) & _alike("n_a", "n_shingles"))
    return written(pairs.select("a", F.col("node").alias("b")).distinct(), "centre-pairs")


def open_bands(labelled: DataFrame) -> DataFrame:
    """``band, main, a, b``, written: band values with several components, the largest of these, and numbers of blocks.

    The nodes of the main component make ``a`` blocks, the others ``b``; a small band value is one block, without a main one.
    """
    size = (F.sum(F.col("n_shingles") * 8) / BLOCK_BYTES).alias("weight")
    parts = labelled.groupBy("band", "root").agg(F.count(F.lit(1)).alias("nodes"), size)
    bands = parts.groupBy("band").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("nodes").alias("nodes"), F.sum("weight").alias("weight"),
        F.max(F.struct("nodes", "root", "weight")).alias("top"),
    )

    def blocks(nodes, weight):
        return F.greatest(F.ceil(nodes / BLOCK_NODES), F.ceil(weight), F.lit(1)).cast("int")

    single = (F.col("nodes") <= BLOCK_NODES) & (F.col("weight") <= 1)
    a = F.when(single, 0).otherwise(blocks(F.col("top.nodes"), F.col("top.weight")))
    b = F.when(single, 1).otherwise(blocks(F.col("nodes") - F.col("top.nodes"), F.col("weight") - F.col("top.weight")))
    return written(bands.where("parts > 1").select("band", F.col("top.root").alias("main"), a.alias("a"), b.alias("b")), "open-bands")


def remaining_links(members: DataFrame, roots: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """``a, b``, written: links between different components whose nodes share a band, enough to join all that have one."""
    labelled = attach(members, roots.withColumnRenamed("vertex", "node"), ["node"], "left", spread_by=["band"])
    labelled = written(labelled.select("band", "node", "n_shingles", F.coalesce("root", "node").alias("root")), "labelled-members")
    rows = written(attach(labelled, open_bands(labelled), ["band"], spread_by=["node"]), "open-members")
    wanted = written(rows.select("node").distinct(), "open-nodes")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_by_bytes(whole, "text"):
                signed, keys, sets = [], [], []
                for members in shingle_sets(batch.column("text"), words):
                    fine = min_max_signature(members, FINE_PERMUTATIONS)
                    signed.append(fine.astype(np.uint8).tobytes())
                    # The first permutations are those of the bands.
                    keys.append(band_keys(fine[None, : 2 * PERMUTATIONS]).tobytes())
                    sets.append(members.tobytes())
                columns = [batch.column("node"), *(pa.array(x, pa.binary()) for x in (signed, keys, sets))]
                yield pa.RecordBatch.from_arrays(columns, ["node", "signature", "bands", "members"])

    signatures = attach(texts, wanted, ["node"], "left_semi").mapInArrow(sign, "node binary, signature binary, bands binary, members binary")
    signatures = written(signatures, "open-signatures")
    # The task of the blocks (x, y) holds these two; no task holds two blocks of the main component.
    is_main = (F.col("a") > 0) & (F.col("root") == F.col("main"))
    spot = F.hash("node")
    mine = F.when(is_main, F.pmod(spot, F.greatest("a", F.lit(1)))).otherwise(F.col("a") + F.pmod(spot, F.col("b")))
    first = F.when(is_main, F.col("a")).otherwise(F.lit(0))
    rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(first, F.col("a") + F.col("b") - 1)))
    rows = rows.select("band", "node", "root", "mine", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"))
    rows = attach(rows, signatures, ["node"], spread_by=["band", "x", "y"], broadcast_bytes=0)
    return written(rows.groupBy("band", "x", "y").applyInPandas(block_links, "a binary, b binary").distinct(), "remaining-links")


def block_links(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
    """Links between the nodes of two blocks of a band value that join different components, fewer than there are components."""
    band, x, y = key
    block = block.sort_values("node", ignore_index=True)
    signed = np.frombuffer(b"".join(block["signature"]), dtype=np.uint8).reshape(len(block), -1)
    bands = np.frombuffer(b"".join(block["bands"]), dtype=np.int64).reshape(len(block), -1)
    sets = [np.frombuffer(s, dtype=np.uint64) for s in block["members"]]
    sizes = np.array([len(s) for s in sets])
    names, of = block["node"].to_numpy(), block["mine"].to_numpy()
    label = pd.factorize(block["root"])[0]
    right, found = np.flatnonzero(of == y), []
    for i in np.flatnonzero(of == x):
        others = right[right > i] if x == y else right
        others = others[label[others] != label[i]]
        others = others[100 * np.minimum(sizes[others], sizes[i]) >= PERCENT * np.maximum(sizes[others], sizes[i])]
        same = bands[others] == bands[i]
        others = others[bands[i][same.argmax(axis=1)] == band] if len(others) else others
        others = others[(signed[others] == signed[i]).mean(axis=1) >= LEAST_EQUAL] if len(others) else others
        for j in others:
            if label[i] == label[j]:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= PERCENT * (sizes[i] + sizes[j] - both):
                found.append((min(names[i], names[j]), max(names[i], names[j])))
                label[label == label[j]] = label[i]
    return pd.DataFrame(found, columns=["a", "b"])


def near_dedup(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``."""
    ship_package(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = written(set_signatures(docs, words), "set-signatures")
    named = rows.where("node is not null and doc_id is not null")
    nodes = named.groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"),
        F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
    )
    nodes = written(nodes, "nodes")
    members = shared_bands(nodes)
    texts = node_texts(docs, written(members.select("node", "first_id").distinct(), "shared-nodes"), words)
    links = confirmed(centre_pairs(members), texts, words)
    roots = components(links)
    more = remaining_links(members, roots, texts, words)
    if not more.isEmpty():
        roots = components(roots.where("root != vertex").select(F.col("root").alias("a"), F.col("vertex").alias("b")).unionByName(more))
    # The smallest id of each component, for nodes that are not a single document.
    placed = attach(nodes.select("node", "first_id", "last_id"), roots.withColumnRenamed("vertex", "node"), ["node"], "left")
    placed = written(placed.where("root is not null or first_id != last_id"), "placed-nodes")
    least = placed.where("root is not null").groupBy("root").agg(F.min("first_id").alias("least_id"))
    placed = attach(placed, written(least, "least-ids"), ["root"], "left", spread_by=["node"])
    placed = written(placed.select("node", F.coalesce("least_id", "first_id").alias("component")), "node-components")
    rows = attach(rows.select("doc_id", "node", "n_shingles"), placed, ["node"], "left", spread_by=["doc_id"])
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with the document of smallest id of each group of near duplicates: five words, similarity 0.8."""
    with passing(spark) as kept:
        dropped = ids_not_kept(near_dedup(docs), "doc_id", F.col("kept"))
        kept.append(dropped)
    return drop_documents(docs, dropped, "doc_id")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), words=2)
