import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

DATA = "/root/testdata/sf0.001"
KINDS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use inside or for their results.
CLASHING = (
    "kept", "keep", "row", "component_id", "node", "bands", "band", "size", "slot", "place", "block", "release", "deadline",
    "mix_slot", "group", "_letters", "_row_value", "_again", "text_sha256", "found", "edits", "score", "_slot", "_part", "_slice", "_kept", "meta.origin", "a`b",
)


def prose(seed: int, n: int) -> str:
    """``n`` words which texts of other seeds do not share."""
    return " ".join(f"w{(seed * 7919 + i * 104729) % 999983}" for i in range(n))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    return [r.asDict() for r in documents.collect()]


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    long = prose(1, 60_000)
    return [
        (1, None, None, None, None),
        (2, "", "en", "src0", 0),
        (3, " \t\n", "en", "src0", 3),
        (4, "one", "en", "src1", 3),
        (5, "One", "en", None, 3),
        (5, "One", "en", None, 3),
        (6, long, "en", "src0", len(long)),
        (7, long + " end", None, "src0", len(long) + 4),
        (8, prose(2, 80), "en", "src2", 1),
        (8, prose(3, 80), "fr", "src2", 1),
        (None, prose(2, 80), "en", "src2", 1),
        (None, None, None, None, None),
        (9, "x" * 300_000, "en", "src9", 1),
        (10, "1234 !!! ???", "en", "src9", 1),
    ]


@pytest.fixture(scope="session")
def awkward(spark, tmp_path_factory):
    """Written as a stage would find them, with columns whose names clash."""
    docs = spark.createDataFrame(awkward_rows(), KINDS).withColumns({c: F.lit(f"own {c}") for c in CLASHING})
    path = str(tmp_path_factory.mktemp("awkward") / "documents.parquet")
    docs.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark, awkward, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("nothing") / "documents.parquet")
    awkward.limit(0).write.parquet(path)
    return spark.read.parquet(path)
