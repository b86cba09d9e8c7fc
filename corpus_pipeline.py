"""The corpus pipeline: five stages over ``documents``, each by one of the operators in ``changeflow.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the
last return the columns of ``docs``. ``run`` writes each stage's rows as Parquet in the cluster's shared
checkpoint folder and reads them again for the next one, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from changeflow.llm.common import ensure_checkpoint_dir, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches 0.7 go."""
    from changeflow.llm.toxicity import fit, reject

    return reject(docs, fit(docs, table(spark, sf_dir, "labels")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity lies over their language's threshold go."""
    from changeflow.llm.quality import fit, reject

    return reject(docs, fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8) stays: the one with the smallest id."""
    from changeflow.llm.shingles import keep_one

    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source gets the same share; the expected number of rows stays."""
    from changeflow.llm.mixing import mix

    return mix(docs, copy_col=None)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token count and digests of ids and decoded text of each row."""
    from changeflow.llm.bpe import bpe_encode

    return bpe_encode(docs, public_tokenizers.path("word_bpe_49k.json"), digest=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("bpe", encoding),
]

#: SQL can express neither the language model nor the exact encoder; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ensure_checkpoint_dir(spark)
    shared = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{shared}/{k}-{name}")
        docs = spark.read.parquet(f"{shared}/{k}-{name}")
    return docs
