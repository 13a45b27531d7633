"""From raw documents to packed sequences: five stages, each over all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the shared
folder and gives what it reads back to the next stage. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ambar.llm import decontaminate, near_dup, packing, site_quality, toxicity
from ambar.llm.common import setup, table
from ambar.llm.tokens import public_path
from ambar.session import checkpoint_dir, remove, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't predict to be toxic."""
    setup(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.clean_rows(docs, model)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    setup(spark)
    return site_quality.good_rows(docs, site_quality.fit_evidence(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every group of near-duplicates."""
    setup(spark)
    return near_dup.first_rows(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    setup(spark)
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4,096 tokens."""
    setup(spark)
    return packing.pack(docs, public_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_dup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("packing", pack),
]

# The classifiers are learned, so SQL can't give the rows; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All stages over the documents of ``sf_dir``.

    With a ``folder`` (that executors can reach) the stages' results stay there, and a run that was broken off goes on
    behind the last stage that it finished. Without one a new folder is used, and a stage's result is removed when the
    next one is written.
    """
    own = folder or f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for number, (name, stage) in enumerate(STAGES, 1):
        path = f"{own}/{number}-{name}"
        if not written(spark, path):
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        if before and not folder:
            remove(spark, before)
        before = path
    return docs
