"""From raw documents to a mixed training corpus: five stages, each an operator of ``linkloom.llm``.

Each stage reads all that the stage before it kept and is written as Parquet, so that a later
stage never runs an earlier one again. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm.common import new_path, table
from linkloom.llm.decontamination import decontamination_stage
from linkloom.llm.exact_dedup import exact_dedup_stage
from linkloom.llm.language_id import language_id_stage
from linkloom.llm.mixing import mixing_stage
from linkloom.llm.near_dedup import near_dedup_stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

# Near-duplicate groups and a trained classifier have no SQL; tests hold the rows against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
