"""Rows stored in the order of a list, so that a page is read by its position."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.clean import col

# The range of the order that a row lies in, and its place there.
PART, PLACE = "_part", "_place"
_COUNTS = "part bigint, n bigint, before bigint"


def build(rows: DataFrame, path: str, ordering: Sequence) -> None:
    """Write the rows under ``path`` by ranges of the order, with the place of each, and the counts of the ranges.

    Ranges are drawn from a sample, so they hold about equally many rows; rows that tie in
    the whole order are told apart by a number, so they can lie in several.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*ordering, "_tie").sortWithinPartitions(*ordering, "_tie").drop("_tie")
    number = F.monotonically_increasing_id()
    placed = dealt.withColumn(PART, F.shiftright(number, 33)).withColumn(PLACE, number.bitwiseAND((1 << 33) - 1))
    placed.sortWithinPartitions(PART, PLACE).write.partitionBy(PART).parquet(f"{path}/rows")
    # The ranges' names and the files' footers tell the counts: one row per range.
    stored = rows.sparkSession.read.schema(f"{PLACE} bigint, {PART} bigint").parquet(f"{path}/rows")
    counts = stored.groupBy(F.col(PART).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    counts.withColumn("before", before).coalesce(1).write.parquet(f"{path}/counts")


def page(spark: SparkSession, path: str, schema: T.StructType, limit: int, offset: int = 0) -> DataFrame:
    """The rows at ``offset + 1 .. offset + limit`` of the list, in its order.

    Reads the counts of the ranges that hold them, and of those ranges the places wanted:
    no other range is opened, and the places reach the scan.
    """
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must not be negative")
    counts = spark.read.schema(_COUNTS).parquet(f"{path}/counts")
    # At most one row per row of the page.
    held = counts.where((F.col("before") < offset + limit) & (F.col("before") + F.col("n") > offset)).collect()
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(PLACE, T.LongType()), T.StructField(PART, T.LongType())]))
    rows = rows.parquet(f"{path}/rows")
    if not held:
        return rows.limit(0).select(*[col(c) for c in schema.names])
    wanted = [
        (F.col(PART) == r["part"]) & (F.col(PLACE) >= max(0, offset - r["before"])) & (F.col(PLACE) < min(r["n"], offset + limit - r["before"]))
        for r in held
    ]
    return rows.where(reduce(or_, wanted)).orderBy(PART, PLACE).select(*[col(c) for c in schema.names])


def total(spark: SparkSession, path: str) -> int:
    """The number of rows in the list, from the counts of its ranges."""
    return spark.read.schema(_COUNTS).parquet(f"{path}/counts").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
