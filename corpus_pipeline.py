"""From raw documents to packed training sequences, one operator of `millrace.llm` a stage.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one before it
kept; its result is written to the shared folder and read again.  All but the last return
the columns of ``documents``.  A lost executor repeats tasks of the stage at work only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import exact_dedup, minhash, packing, pseudonyms, toxicity
from millrace.sources.workspace import new_path, scratch

#: Documents are rejected from this probability on.
TOXIC = 0.5
#: A deployment passes its own secret.
KEY = "a key for tests only"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the network learns from ``labels``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(docs, toxicity.train(docs, labels), TOXIC)
    return scored.where("toxic_predicted = 0").select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, whatever the case of its A-Z."""
    return exact_dedup.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 on five-word shingles."""
    return minhash.drop_near(docs, 0.8)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced within its format; ``n_chars`` counts the new text."""
    out = pseudonyms.pseudonymise(docs, KEY)
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 ids, with the ids."""
    return packing.pack(docs, capacity=1024, end_id=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("pii", pseudonymise),
    ("packing", pack),
]

#: Scores of a network and tokens cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the ``documents`` table.

    Results of stages are kept; what a stage stores on its way is deleted with it.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, name)
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
