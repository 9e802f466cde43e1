"""An index of a table's keys in hash buckets with Bloom filters, for loads that are small beside the table.

The keys of a load lie in a folder of their own, one file per bucket of about
``BUCKET_KEYS`` keys, beside the buckets' Bloom filters.  A lookup reads the filters of the
buckets its keys fall into, and then the keys of those buckets alone that a filter admits,
so what it reads follows the number of keys asked for and not the table.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.clean import col
from millrace.sources.workspace import materialize

#: Keys of a bucket.
BUCKET_KEYS = 1 << 16
#: Bits of a Spark bitmap, and bitmaps of a bucket: eight bits a key.
BITMAP_BITS = 1 << 15
SLICES = 16
#: Parts of about one size that are merged.
MERGE = 4
#: Columns that do not make a row another one.
UNCOMPARED = ("id", "created_at", "updated_at")

#: Where a row lies: its file, and its number in it.
FILE, ROW = "_file", "_row"


@dataclass
class Index:
    """One part of an index: its folder, its keys, the number of its buckets and the keys' types."""

    folder: str
    n_keys: int
    buckets: int
    schema: str

    @property
    def tier(self) -> int:
        return int(math.log(max(1, self.n_keys), MERGE))


def digest(columns: Sequence[str]) -> Column:
    """64 bits over the values; which of them are null counts too."""
    nulls = F.concat(F.lit("."), *[F.when(col(c).isNull(), "0").otherwise("1") for c in columns])
    return F.xxhash64(nulls, *[col(c) for c in columns])


def stored(df: DataFrame, label: str) -> DataFrame:
    return materialize(df, label)


def _hash(key: Sequence[str]) -> Column:
    return F.xxhash64(*[col(k) for k in key])


def _bits(shift: int, size: int) -> Column:
    return F.shiftrightunsigned(F.col("_h"), shift).bitwiseAND(F.lit(size - 1)).cast("int")


def _slice() -> Column:
    return _bits(20, SLICES)


def _positions() -> list[Column]:
    return [_bits(shift, BITMAP_BITS) for shift in (24, 39, 49)]


def _bucket(buckets: int) -> Column:
    return _bits(0, buckets)


def build(spark: SparkSession, root: str, folder: str, entries: DataFrame, key: Sequence[str], n: int) -> Index:
    """Write a part: ``entries`` are the key columns, ``id``, ``digest``, and the row's file and number in it."""
    buckets = 1 << max(0, math.ceil(math.log2(max(1, n) / BUCKET_KEYS)))
    placed = entries.withColumn("_h", _hash(key)).withColumn("bucket", _bucket(buckets))
    path = f"{root}/{folder}"
    gathered = placed.drop("_h").hint("rebalance", F.col("bucket"))
    gathered.write.partitionBy("bucket").parquet(f"{path}/keys")
    schema = T.StructType(entries.schema.fields)
    # From the keys as written: a task meets the filters of its own buckets only, not those of all.
    written = _read(spark, f"{path}/keys", T.StructType([schema[k] for k in key]), None).withColumn("_h", _hash(key))
    at = [F.bitmap_construct_agg(p.cast("bigint")) for p in _positions()]
    maps = written.groupBy("bucket", _slice().alias("slice")).agg(F.array(*at).alias("all"))
    maps = maps.select("bucket", "slice", F.explode("all").alias("one")).groupBy("bucket", "slice").agg(F.bitmap_or_agg("one").alias("bits"))
    maps.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(f"{path}/bloom")
    return Index(folder, n, buckets, schema.json())


def _read(spark: SparkSession, path: str, schema: T.StructType, buckets: Sequence[int] | None) -> DataFrame:
    """The named buckets, or all."""
    schema = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    rows = spark.read.schema(schema).parquet(path)
    return rows if buckets is None else rows.where(F.col("bucket").isin(list(buckets)))


_BLOOM = T.StructType([T.StructField("slice", T.IntegerType()), T.StructField("bits", T.BinaryType())])


def entries(spark: SparkSession, root: str, parts: Sequence[Index]) -> DataFrame:
    """All entries of some parts."""
    out = None
    for part in parts:
        schema = T.StructType.fromJson(json.loads(part.schema))
        rows = _read(spark, f"{root}/{part.folder}/keys", schema, None).drop("bucket")
        out = rows if out is None else out.unionByName(rows)
    return out


def bit_is_set(position: Column) -> Column:
    """Whether the bitmap ``bits`` has the bit: bit p is bit p mod 8 of byte p div 8."""
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(position, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, position.bitwiseAND(F.lit(7))).bitwiseAND(F.lit(1)) == 1


def candidates(spark: SparkSession, root: str, part: Index, asked: DataFrame) -> DataFrame:
    """Keys (with hash ``_h``) that the filters of a part admit, with their ``bucket``."""
    placed = asked.withColumn("bucket", _bucket(part.buckets))
    hit = _distinct_buckets(placed, part.buckets)
    maps = _read(spark, f"{root}/{part.folder}/bloom", _BLOOM, hit)
    joined = placed.withColumn("slice", _slice()).join(maps, ["bucket", "slice"])
    test = _positions()
    return joined.where(bit_is_set(test[0]) & bit_is_set(test[1]) & bit_is_set(test[2])).drop("slice", "bits")


def _distinct_buckets(placed: DataFrame, buckets: int) -> list[int] | None:
    """Numbers of the buckets hit: at most one for ``BUCKET_KEYS`` keys of the table."""
    if buckets == 1:
        return None
    return [r["bucket"] for r in placed.select("bucket").distinct().collect()]


def hit_entries(spark: SparkSession, root: str, part: Index, admitted: DataFrame) -> DataFrame:
    """All entries of the buckets that hold an admitted key."""
    schema = T.StructType.fromJson(json.loads(part.schema))
    return _read(spark, f"{root}/{part.folder}/keys", schema, _distinct_buckets(admitted, part.buckets))


def lookup(spark: SparkSession, root: str, parts: Sequence[Index], keys: DataFrame, key: Sequence[str], dropped: Sequence[str] = ()) -> DataFrame:
    """Entries of the keys asked for, each once; keys may repeat.

    Entries of files that count no more are passed over.
    """
    names = list(key)
    if not parts:
        fields = [keys.schema[k] for k in names]
        more = [T.StructField("id", T.LongType())] * ("id" not in names) + [T.StructField("digest", T.LongType()), T.StructField(FILE, T.StringType()), T.StructField(ROW, T.LongType())]
        return spark.createDataFrame([], T.StructType([*fields, *more]))
    asked = keys.select(*[col(k) for k in names]).distinct().withColumn("_h", _hash(names))
    asked = materialize(asked, "asked")
    out = None
    for part in parts:
        admitted = materialize(candidates(spark, root, part, asked), "admitted")
        held = hit_entries(spark, root, part, admitted)
        if dropped:
            held = held.where(~col(FILE).isin(list(dropped)))
        found = held.join(admitted.drop("_h"), [*names, "bucket"], "left_semi").drop("bucket")
        out = found if out is None else out.unionByName(found)
    return out
