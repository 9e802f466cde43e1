"""Substring search through lists of the rows that hold a sequence of three characters.

A pattern's literal runs name the sequences that a match must hold.  The lists of the
rarest few are intersected; only the rows left are read and compared with the pattern.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.clean import col

#: Lists that are intersected; more rarely pay for reading them.
LISTS = 4


def build_trigrams(df: DataFrame, path: str, id_col: str = "id", text_col: str = "name") -> None:
    """Write the lists of a column under ``path``; ids must not be null.

    Pairs of sequence and id are sorted into ranges of both, so a list of very many rows is
    spread over files, and a search reads the row groups of its sequences alone.
    """
    text = F.lower(col(text_col))
    grams = F.transform(F.sequence(F.lit(1), F.length(text) - 2), lambda i: F.substring(text, i, F.lit(3)))
    some = F.when(F.length(text) >= 3, F.array_distinct(grams))
    pairs = df.select(F.explode(some).alias("gram"), col(id_col).alias("id"))
    pairs.repartitionByRange("gram", "id").sortWithinPartitions("gram", "id").write.parquet(f"{path}/lists")
    lists = df.sparkSession.read.parquet(f"{path}/lists")
    counts = lists.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    counts.repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{path}/counts")


def literal_runs(pattern: str) -> list[str]:
    """The literal parts of a LIKE pattern, with ``\\`` as its escape."""
    runs, run, at = [], "", 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\" and at + 1 < len(pattern):
            run += pattern[at + 1]
            at += 1
        elif c in "%_":
            runs.append(run)
            run = ""
        else:
            run += c
        at += 1
    return [r for r in [*runs, run] if r]


def pattern_grams(spark: SparkSession, pattern: str) -> set[str]:
    # Lowered by the same function as the rows.
    lowered = spark.range(1).select(F.lower(F.lit(pattern))).first()[0]
    return {run[i : i + 3] for run in literal_runs(lowered) for i in range(len(run) - 2)}


def search_like(df: DataFrame, path: str, pattern: str, id_col: str = "id", text_col: str = "name") -> DataFrame:
    """The rows whose text is ILIKE the pattern, by the lists under ``path``.

    A pattern without three literal characters in a row has no list and reads all rows.
    """
    match = col(text_col).ilike(pattern)
    grams = pattern_grams(df.sparkSession, pattern)
    if not grams:
        return df.where(match)
    read = df.sparkSession.read.parquet
    # One row for each sequence of the pattern.
    counts = read(f"{path}/counts").where(F.col("gram").isin(sorted(grams))).collect()
    if len(counts) < len(grams):
        return df.where(F.lit(False))
    rarest = [r["gram"] for r in sorted(counts, key=lambda r: (r["n"], r["gram"]))[:LISTS]]
    held = read(f"{path}/lists").where(F.col("gram").isin(rarest)).groupBy("id").agg(F.count_distinct("gram").alias("n"))
    ids = held.where(F.col("n") == len(rarest)).select(F.col("id").alias("_id"))
    return df.join(ids, col(id_col) == F.col("_id"), "left_semi").where(match)


def search_text(df: DataFrame, path: str, text: str, id_col: str = "id", text_col: str = "name") -> DataFrame:
    """Case-insensitive substring; ``%``, ``_`` and backslash in the text stay live."""
    return search_like(df, path, f"%{text}%", id_col, text_col)
