"""Cells of the reports kept up to date from the rows that a load added and removed.

A cell per country, fuel and commissioning year holds sums, which later rows add to and
removed rows are taken from, and the largest capacity.  Only where a removed row was as
large as that is the maximum counted anew, over the rows of that cell.  Numbers of countries
and fuels, and the first and last year, are exact: they are those of the cells left.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.clean import col
from millrace.operators.stats import capacity_cells
from millrace.sources.workspace import materialize

KEYS = ("country_code", "country", "primary_fuel", "commissioning_year")
SUMS = ("n", "n_capacity", "capacity")


def cells_of(plants: DataFrame) -> DataFrame:
    """The cells of a whole table."""
    return capacity_cells(plants, *KEYS).select(*KEYS, *SUMS, "largest")


def updated_cells(cells: DataFrame, added: DataFrame, removed: DataFrame, current: DataFrame) -> DataFrame:
    """The cells after a change; ``current`` are the rows as they are now.

    Reads the change, the cells, and of the table only the cells whose largest row may have
    gone.  A corrected row is one removed and one added.
    """

    def signed(some: DataFrame, sign: int, kept: str, other: str) -> DataFrame:
        sums = [(F.col(c) * sign).cast(cells.schema[c].dataType).alias(c) for c in SUMS]
        none = F.lit(None).cast(cells.schema["largest"].dataType)
        return some.select(*KEYS, *sums, F.col("largest").alias(kept), none.alias(other))

    parts = [signed(cells, 1, "largest", "lost"), signed(cells_of(added), 1, "largest", "lost"), signed(cells_of(removed), -1, "lost", "largest")]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    sums = [F.sum(c).cast(cells.schema[c].dataType).alias(c) for c in SUMS]
    merged = every.groupBy(*KEYS).agg(*sums, F.max("largest").alias("largest"), F.max("lost").alias("lost"))
    # A sum over no capacity at all is null, as in a full count.
    merged = merged.where("n > 0").withColumn("capacity", F.when(F.col("n_capacity") > 0, F.col("capacity")))
    merged = materialize(merged, "cells")
    # No row is larger than the maximum, so only as large a loss can lower it.
    unsure = F.coalesce(F.col("lost") >= F.col("largest"), F.lit(False))
    sure = merged.where(~unsure).select(*KEYS, *SUMS, "largest")
    again = merged.where(unsure).select(*[F.col(k).alias(f"_{k}") for k in KEYS], *SUMS)
    same = reduce(and_, [col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS])
    counted = current.join(again.drop(*SUMS), same, "left_semi").groupBy(*KEYS).agg(F.max("capacity_mw").alias("largest"))
    recounted = again.join(counted, same).select(*KEYS, *SUMS, "largest")
    return materialize(sure.unionByName(recounted), "cells")


def regrouped(cells: DataFrame, *keys: str) -> DataFrame:
    """Cells as the reports take them, by fewer keys."""
    return cells.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in SUMS],
        F.max("largest").alias("largest"),
        F.min("commissioning_year").alias("oldest"),
        F.max("commissioning_year").alias("newest"),
    )
