"""Reading and appending parquet tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.clean import col


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Make sure the table's folder exists; a table with rows is left as it is."""
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    spark.range(1).where(F.lit(False)).select(*nothing).write.mode("append").parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path`` with the contract's columns in order."""
    return spark.read.schema(schema).parquet(path).select(*[col(c) for c in schema.names])


def append(df: DataFrame, path: str, columns: Iterable[str], partition_by: Iterable[str] = ()) -> None:
    """Append the named columns; an empty frame is legal and adds no rows.

    Each task writes its own files, so a partition value that holds a third of the rows
    is still written by many tasks.
    """
    writer = df.select(*[col(c) for c in columns]).write.mode("append")
    parts = list(partition_by)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(path)


def not_yet_loaded(df: DataFrame, existing: DataFrame, key: Iterable[str]) -> DataFrame:
    """Rows whose key is not in the table, which makes a repeated load add nothing."""
    key = list(key)
    return df.join(existing.select(*[col(c) for c in key]), key, "left_anti")


def append_jdbc(df: DataFrame, url: str, table: str, columns: Iterable[str], **properties: str) -> None:
    """Append to a database table over JDBC with batched multi-row inserts."""
    settings = {"batchsize": "10000", "rewriteBatchedInserts": "true"} | properties
    df.select(*[col(c) for c in columns]).write.mode("append").jdbc(url, table, properties=settings)


def stamp_new(df: DataFrame) -> DataFrame:
    """Audit columns of an inserted row."""
    return df.withColumns({"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()})


def upsert(existing: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The table after replacing rows by key and adding new ones.

    ``changes`` carries the key and any of the other columns; a changed row keeps
    ``created_at`` and gets a fresh ``updated_at``.  Keys in ``changes`` must be unique.
    """
    own = [c for c in existing.columns if c not in (key, "created_at", "updated_at")]
    given = [c for c in own if c in changes.columns]
    patch = changes.select(
        col(key), F.lit(True).alias("_hit"), *[col(c).alias(f"_new_{c}") for c in given]
    )
    joined = existing.withColumn("_old", F.lit(True)).join(patch, key, "full")
    hit = F.col("_hit").isNotNull()
    now = F.current_timestamp()
    return joined.select(
        col(key),
        *[
            F.when(hit, F.col(f"`_new_{c}`")).otherwise(col(c)).alias(c) if c in given else col(c)
            for c in own
        ],
        F.coalesce(F.col("created_at"), now).alias("created_at"),
        F.when(hit, now).otherwise(F.col("updated_at")).alias("updated_at"),
    )
