"""Natural keys, surrogate keys and the links between parents and children."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.clean import col
from millrace.sources.workspace import materialize

# monotonically_increasing_id: partition number above, row number in the low 33 bits.
_ROW_BITS = 33


def surrogate_key(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str = "id",
    start_after: int = 0,
) -> DataFrame:
    """Dense numbers ``start_after + 1, ...`` in the order of ``order_by``.

    One range shuffle sorts the rows; their place inside a partition is written with
    them, and only one count per partition is needed to turn places into numbers.  No
    task sees more than its range.  ``order_by`` should identify a row: range bounds can
    only split rows that differ in it, and ties would make the numbering arbitrary.
    """
    order = [col(c) if isinstance(c, str) else c for c in order_by]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumn("_place", F.monotonically_increasing_id()), "ranged")
    numbered = dense_numbers(placed, name, start_after)
    return numbered.select(col(name), *[col(c) for c in df.columns])


def dense_numbers(placed: DataFrame, name: str, start_after: int = 0) -> DataFrame:
    """Numbers ``start_after + 1, ...`` for stored rows whose ``_place`` is their place when written."""
    part = F.shiftright("_place", _ROW_BITS)
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition that was written, whatever the number of rows.
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    number = (F.col("_offset") + row + F.lit(start_after + 1)).cast("bigint")
    joined = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return joined.withColumn(name, number).drop("_part", "_offset", "_place")


def unique_id(df: DataFrame, name: str = "id", start_after: int = 0) -> DataFrame:
    """Unique increasing numbers with gaps, without a shuffle.

    For ids nothing refers to, such as those of fact rows.
    """
    number = F.monotonically_increasing_id() + F.lit(start_after + 1)
    return df.select(number.alias(name), *[col(c) for c in df.columns])


def keep_first(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order_by``.

    The rank filter is applied before the shuffle too, so at most one row per key and
    task is sent, even for a key that holds a third of the table.
    """
    rank = Window.partitionBy(*[col(k) for k in key]).orderBy(*[col(c).asc_nulls_last() for c in order_by])
    return df.withColumn("_rank", F.row_number().over(rank)).where("_rank = 1").drop("_rank")


def merge_copies(df: DataFrame, key: Sequence[str], copies: str = "copies") -> DataFrame:
    """One row per key and how many rows it stands for; the row is the one that `settle_copies` lets win.

    An aggregate, so copies are merged inside each task before the shuffle.
    """
    keys = [col(k) for k in key]
    rest = [c for c in df.columns if c not in key]
    place = F.struct(*[col(c).isNull().alias(f"n{i}") for i, c in enumerate(rest)], *[col(c).alias(f"v{i}") for i, c in enumerate(rest)])
    merged = df.groupBy(*keys).agg(F.min(place).alias("_best"), F.count(F.lit(1)).alias(copies))
    return merged.select(*keys, *[F.col(f"_best.v{i}").alias(c) for i, c in enumerate(rest)], col(copies))


def settle_copies(
    df: DataFrame, key: Sequence[str], copies: str = "copies"
) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """``(winners, losers, repeated)``: one row per key, the rows that lost, and the repeated keys.

    There are no losers (None) where no key repeats.

    Of rows that share a key the most complete one wins: nulls are compared first, in the
    order of the columns, then values, smallest first.  ``winners`` carries the number of
    rows it stands for; ``losers`` holds every row that differs from its winner, with its
    number of occurrences; rows equal to their winner are merged.  Keys must not be null.

    ``df`` is read more than once, so store it first.  Rows are counted by key alone, which
    combines inside each task; only rows of repeated keys are compared, by an aggregate and
    a join on the key whose crowded side the adaptive skew join splits.
    """
    keys = [col(k) for k in key]
    rest = [c for c in df.columns if c not in key]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(copies)).where(col(copies) > 1)
    repeated = materialize(counted, "repeated")
    alone = F.lit(1).cast("bigint")
    if repeated.isEmpty():
        return df.withColumn(copies, alone), None, repeated
    among = df.join(repeated.select(*keys), list(key), "left_semi")
    order = [col(c).isNull().alias(f"n{i}") for i, c in enumerate(rest)]
    place = F.struct(*order, *[col(c).alias(f"v{i}") for i, c in enumerate(rest)])
    best = among.groupBy(*keys).agg(F.min(place).alias("_best"), F.count(F.lit(1)).alias(copies))
    best = materialize(best, "winners")
    won = best.select(*keys, *[F.col(f"_best.v{i}").alias(c) for i, c in enumerate(rest)], col(copies))
    lost = among.join(best.select(*keys, "_best"), list(key)).where(~place.eqNullSafe(F.col("_best")))
    losers = lost.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("n_rows"))
    singles = df.join(repeated.select(*keys), list(key), "left_anti").withColumn(copies, alone)
    return singles.select(*[col(c) for c in won.columns]).unionByName(won), losers, repeated


def resolve_keys(children: DataFrame, parents: DataFrame, natural: str, key: str, as_name: str) -> DataFrame:
    """Replace the natural key of the children by the parent's key.

    Children without a parent drop out.  The join side is left to Spark, which knows the
    sizes; a hot parent is split by the adaptive skew join.
    """
    lookup = parents.select(col(natural), col(key).alias(as_name))
    rest = [col(c) for c in children.columns if c != natural]
    return children.join(lookup, natural, "inner").select(col(as_name), *rest)


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their number of rows.

    Children are counted per key before the join, so the join sees each key once.
    """
    counted = (
        children.where(col(child_key).isNotNull())
        .groupBy(col(child_key))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parents.select(col(parent_key).alias("_parent"))
    return counted.join(known, col(child_key) == F.col("_parent"), "left_anti")


def unique_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; keys with a null are not compared, as in SQL."""
    complete = df
    for c in key:
        complete = complete.where(col(c).isNotNull())
    counted = complete.groupBy(*[col(c) for c in key]).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where("n_rows > 1")


def cascade_delete(children: DataFrame, deleted: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children that remain after their parents were deleted."""
    gone = deleted.select(col(parent_key).alias("_gone"))
    return children.join(gone, col(child_key) == F.col("_gone"), "left_anti")


def lookup(df: DataFrame, key: str, value: int) -> DataFrame:
    """The row with this key (none when it is missing)."""
    if isinstance(value, bool) or not isinstance(value, int):
        raise ValueError(f"{key} must be an integer, got {value!r}")
    return df.where(col(key) == F.lit(value))


def lookup_many(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key is listed, any number of times, in the first column of ``wanted``."""
    keys = wanted.select(col(wanted.columns[0]).alias("_wanted")).distinct()
    return df.join(keys, col(key) == F.col("_wanted"), "left_semi")


def nest(
    parents: DataFrame,
    children: DataFrame,
    key: str,
    child_key: str,
    columns: Iterable[str],
    order_by: str,
    name: str,
) -> DataFrame:
    """Parents with their children as an array sorted by ``order_by``; none gives ``[]``.

    For children whose (child_key, order_by) is unique under a bounded domain, such as
    one row per plant and year: that bounds the array.  A repeated one fails the job;
    repeats are counted inside each task before any array is made.
    """
    fields = [order_by, *[c for c in columns if c != order_by]]
    child = F.struct(*[col(c) for c in fields])
    single = children.groupBy(col(child_key).alias("_parent"), col(order_by).alias("_order")).agg(
        F.min(child).alias("_child"), F.count(F.lit(1)).alias("_copies")
    )
    place = F.to_json(F.struct(F.col("_order").alias(order_by), F.col("_parent").alias(child_key)))
    repeated = F.raise_error(F.concat(F.col("_copies").cast("string"), F.lit(" rows of "), place))
    # A child without a parent's key is nobody's.
    single = single.where("_parent IS NOT NULL").select(
        "_parent", F.when(F.col("_copies") > 1, repeated.cast(single.schema["_child"].dataType)).otherwise(F.col("_child")).alias("_child")
    )
    packed = single.groupBy("_parent").agg(F.sort_array(F.collect_list("_child")).alias(name))
    joined = parents.join(packed, col(key) == F.col("_parent"), "left").drop("_parent")
    empty = F.array().cast(packed.schema[name].dataType)
    return joined.withColumn(name, F.coalesce(F.col(name), empty))
