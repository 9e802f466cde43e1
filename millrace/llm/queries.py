"""Registered queries of the operators in this subpackage, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    exact_dedup,
    fim,
    hamming,
    lexical,
    minhash,
    packing,
    pieces,
    pseudonyms,
    sharding,
    substrings,
    token_files,
    toxicity,
    warc,
)
from millrace.sources.workspace import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(oracle: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if oracle:
            ORACLES[function.__name__] = oracle
        return function

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query()
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of 1024 ids."""
    return packing.pack_digests(_table(spark, sf_dir, "documents"), capacity=1024, end_id=0)


EXACT = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_query(
    f"""
    WITH t AS (SELECT doc_id, sha256({EXACT}) AS text_sha256 FROM documents),
    g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY ALL)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
    """
)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group and survivor of every document under equality without ASCII case."""
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents")).drop("row")


@_query()
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all ids as flat files in the shared folder and read them back."""
    path = new_path(spark, "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path, end_id=2)
    return token_files.file_digests(spark, path)


@_query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    network = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, network).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxic_score").alias("score"),
        F.col("toxic_predicted").alias("predicted"),
    )


#: A fixed key makes runs comparable; a deployment passes its own secret.
DEMO_KEY = "a key for tests only"


@_query()
def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with personal data replaced, and how much of each kind."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pseudonyms.pseudonymise(docs, DEMO_KEY, counts="kinds")
    return out.select("doc_id", "text", F.size("kinds").alias("n_replaced"), F.array_join("kinds", ",").alias("kinds"))


@_query()
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of near copies of every document, at a similarity of 0.8 on five-word shingles."""
    return minhash.near_groups(_table(spark, sf_dir, "documents"), threshold=0.8).drop("row")


@_query()
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a repeated window of 20 words covers, and the digest of the others."""
    return substrings.repeat_digests(_table(spark, sf_dir, "documents"), window=20)


#: Bytes of text in a shard.
SHARD_BYTES = 16 << 20


@_query(sharding.shard_sql(SHARD_BYTES))
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document, at most 16 MiB of text each."""
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), SHARD_BYTES)


@_query()
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document, and the text decoded from them."""
    return pieces.piece_digests(_table(spark, sf_dir, "documents"))


@_query(hamming.nearest_sql(10))
def op4_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors, by sign code, of every hundredth vector."""
    return hamming.nearest_vectors(_table(spark, sf_dir, "embeddings"), k=10)


@_query(lexical.search_sql(20))
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    return lexical.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)


@_query(warc.warc_sql())
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as web archives in the shared folder and read them back."""
    path = new_path(spark, "warc")
    warc.write_warc(_table(spark, sf_dir, "pages"), path, min_bytes=0)
    return warc.page_records(spark, path)


@_query(fim.fim_sql())
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut for filling in its middle, with checksums of output and restored text."""
    return fim.middle_digests(_table(spark, sf_dir, "documents"), seed=1, percent=90, spm_percent=20)
