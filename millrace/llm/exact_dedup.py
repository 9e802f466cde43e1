"""Exact duplicates by merging sorted runs of digests up and down a tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.clean import col
from millrace.llm.rows import numbered_rows, without
from millrace.sources.workspace import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KEY = ["digest", "proof", "size"]


def normalised(text):
    """Lower case for A-Z only; a null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def _merged(runs: DataFrame, fan_in: int, best) -> DataFrame:
    """One level up: groups of ``fan_in`` neighbouring runs become one sorted run each."""
    parent = runs.withColumn("run", F.floor(F.col("run") / fan_in))
    merged = parent.groupBy("run", *KEY).agg(best("best").alias("best"), F.sum("n").alias("n"))
    return merged.sortWithinPartitions("run", *KEY)


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "largest",
    fan_in: int = 8,
    row_col: str | None = None,
) -> DataFrame:
    """Group the rows whose normalised text is identical.

    One row per input row: ``doc_id``, ``keep_id`` (the id that stays), ``group_size``,
    ``kept``, ``text_sha256``, and ``row`` (its place in the input, or ``row_col``; unique).  ``keep`` is
    "largest" or "smallest" id; a null id loses to any other; among rows of equal id the
    first in the input stays, so exactly one row per group is kept.  A null text is empty.
    Other columns are ignored; an empty table gives no rows.

    Every input split is a run of digests.  Going up, ``fan_in`` neighbouring runs at a
    time meet and keep one row per digest: the best id and the number of rows.  Equal
    means equal SHA-256, byte length and an independent 64-bit hash, checked at every
    level.  Tasks are dealt by (run, digest), so a level uses all tasks, and a text that a
    third of all rows share arrives at any task as at most ``fan_in`` rows.  Going down,
    the result meets the runs level by level, again at most ``fan_in`` rows a key, until
    it reaches the rows of one split.  Texts are read once and never shuffled; each level
    is a table in the shared folder, so a lost executor repeats one level only.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is 'largest' or 'smallest', not {keep!r}")
    best, sign = (F.max, -1) if keep == "largest" else (F.min, 1)
    text = normalised(col(text_col))
    # Hashing happens once, below the split into columns.
    leaves = materialize(
        docs.select(
            col(id_col).alias("doc_id"),
            text.alias("text"),
            (col(row_col).cast("bigint") if row_col else F.monotonically_increasing_id()).alias("row"),
        ).select(
            "doc_id",
            F.unhex(F.sha2("text", 256)).alias("digest"),
            F.xxhash64("text").alias("proof"),
            F.octet_length("text").alias("size"),
            F.spark_partition_id().alias("run"),
            "row",
        ),
        "digests",
    )
    null_last = F.col("doc_id").isNotNull() if keep == "largest" else F.col("doc_id").isNull()
    place = F.struct(null_last.alias("a"), F.col("doc_id").alias("id"), (F.col("row") * sign).alias("b"))
    first = leaves.groupBy("run", *KEY).agg(best(place).alias("best"), F.count("*").alias("n"))
    levels = [materialize(first.sortWithinPartitions("run", *KEY), "runs")]
    runs = (leaves.agg(F.max("run")).first()[0] or 0) + 1
    while runs > 1:
        levels.append(materialize(_merged(levels[-1], fan_in, best), "runs"))
        runs = -(-runs // fan_in)
    found = levels.pop().select("run", *KEY, "best", "n")
    for level in reversed(levels):
        below = level.select(F.col("run").alias("child"), F.floor(F.col("run") / fan_in).alias("run"), *KEY)
        found = below.join(found, ["run", *KEY]).select(F.col("child").alias("run"), *KEY, "best", "n")
    rows = leaves.join(found, ["run", *KEY])
    return rows.select(
        "doc_id",
        F.col("best.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("best.b") * sign == F.col("row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "row",
    )


def drop_exact(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The documents without all but one of the rows of equal text, all columns as they are."""
    numbered, row = numbered_rows(docs)
    groups = exact_groups(numbered, keep=keep, row_col=row)
    return without(numbered, row, groups.where("NOT kept"), docs.columns)
