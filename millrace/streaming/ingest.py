"""Batch-at-a-time ingest as a stream over a landing folder.

The stream only parses and stages (its checkpoint remembers which files were taken, so
a restart neither skips nor repeats one).  Every batch is a partition of the staging
folder, written whole, so a repeated batch replaces itself and later steps can read new
batches alone.  Removing repeated keys is a batch step over the staged rows, which keeps
the stream free of state that would grow with the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.clean import col, null_tokens
from millrace.sources.files import RAW_LINE
from millrace.sources.records import check_heads, parse_records, records, text_stream
from millrace.sources.workspace import scratch


def ingest_available(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    staging: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    encoding: str = "UTF-8",
    header: bool = True,
) -> list[int]:
    """Stage every file that arrived since the last call, in batches, then stop.

    Gives the numbers of the batches it staged.  Records are put together within a batch,
    which holds whole files; what is no row keeps its raw text and nothing else.
    """
    staged: list[int] = []

    def stage(batch: DataFrame, number: int) -> None:
        with scratch(spark):
            found, heads = records(batch, header)
            if header:
                check_heads(heads, schema)
            rows = null_tokens(parse_records(found, schema), schema.names)
            rows.write.mode("overwrite").parquet(f"{staging}/batch={number}")
        staged.append(number)

    query = (
        text_stream(spark, landing, files_per_batch, encoding).writeStream.foreachBatch(stage)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return staged


def _staged(spark: SparkSession, staging: str, schema: T.StructType) -> DataFrame:
    fields = [*schema.fields, T.StructField(RAW_LINE, T.StringType(), True), T.StructField("batch", T.LongType(), True)]
    return spark.read.schema(T.StructType(fields)).parquet(staging)


def staged_batches(spark: SparkSession, staging: str, schema: T.StructType, batches: Iterable[int]) -> DataFrame:
    """All rows of the given batches, with the raw line of those that did not fit.

    Other batches are pruned, so the cost does not grow with what was staged before.
    """
    wanted = list(batches)
    if not wanted:
        fields = [*schema.fields, T.StructField(RAW_LINE, T.StringType(), True)]
        return spark.createDataFrame([], T.StructType(fields))
    return _staged(spark, staging, schema).where(F.col("batch").isin(wanted)).drop("batch")


def staged_rows(spark: SparkSession, staging: str, schema: T.StructType, key: Sequence[str]) -> DataFrame:
    """Staged rows with one row per key: of the newest delivery, the smallest by the other columns.

    The rank filter is applied before the shuffle too, so a key that holds a third of the
    rows sends at most one row per task.
    """
    rest = [c for c in schema.names if c not in key]
    newest = [F.col("batch").desc(), *[col(c).asc_nulls_last() for c in rest]]
    rank = Window.partitionBy(*[col(k) for k in key]).orderBy(*newest)
    fitting = _staged(spark, staging, schema).where(f"{RAW_LINE} IS NULL")
    return fitting.withColumn("_rank", F.row_number().over(rank)).where("_rank = 1").select(*[col(c) for c in schema.names])


def staged_quarantine(spark: SparkSession, staging: str, schema: T.StructType) -> DataFrame:
    """The untouched text of staged records with too many fields or bad quotes."""
    ragged = _staged(spark, staging, schema).where(f"{RAW_LINE} IS NOT NULL")
    return ragged.select(col(RAW_LINE).alias("raw_line"))
