"""Search for whole words, whatever their inflection, through lists of the rows that hold a stem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.clean import col
from millrace.functions.predicates import tokens
from millrace.functions.stems import stems


def build_words(df: DataFrame, path: str, id_col: str = "id", text_col: str = "name") -> None:
    """Write the lists of a column under ``path``; ids must be unique and not null.

    Pairs of stem and id are sorted into ranges of both, once each, so a list of very many
    rows is spread over files and a search reads the row groups of its stems alone.  The
    number of rows of each stem is stored beside them.
    """
    pairs = df.select(F.explode(stems(tokens(col(text_col)))).alias("stem"), col(id_col).alias("id"))
    pairs.repartitionByRange("stem", "id").sortWithinPartitions("stem", "id").write.parquet(f"{path}/lists")
    counts = df.sparkSession.read.parquet(f"{path}/lists").groupBy("stem").agg(F.count(F.lit(1)).alias("n"))
    counts.repartitionByRange("stem").sortWithinPartitions("stem").write.parquet(f"{path}/counts")


def query_stems(spark: SparkSession, text: str) -> list[str]:
    """The distinct stems of a search text, made like those of the rows."""
    return sorted(spark.range(1).select(stems(tokens(F.lit(text)))).first()[0])


def search_words(df: DataFrame, path: str, text: str, id_col: str = "id") -> DataFrame:
    """The rows that hold every word of the text, in whatever inflection, by the lists under ``path``.

    The lists are met by growing length, so what goes on is never longer than the rarest.
    A text of stop words alone finds nothing; one without a word is an error.
    """
    if not any(character.isalnum() for character in text):
        raise ValueError("word search needs at least one word")
    wanted = query_stems(df.sparkSession, text)
    read = df.sparkSession.read.parquet
    # One row for each stem of the text.
    counts = read(f"{path}/counts").where(F.col("stem").isin(wanted)).collect() if wanted else []
    if not counts or len(counts) < len(wanted):
        return df.where(F.lit(False))
    lists = read(f"{path}/lists")
    ids = None
    for row in sorted(counts, key=lambda r: (r["n"], r["stem"])):
        held = lists.where(F.col("stem") == row["stem"]).select(F.col("id").alias("_id"))
        ids = held if ids is None else ids.join(held, "_id")
    return df.join(ids, col(id_col) == F.col("_id"), "left_semi")
