"""Byte-bounded shards by extendible hashing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.clean import col
from millrace.llm.rows import numbered_rows
from millrace.sources.workspace import materialize

#: Bits of the hash, and bits by which the directory grows at a time.
BITS, STEP = 60, 12


def bucket_hash(key):
    """The first 60 bits of MD5 over the key as text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, BITS // 4), 16, 10).cast("bigint")


def directory(sizes: DataFrame, limit: int) -> DataFrame:
    """The buckets over rows of (``hash``, ``bytes``): ``depth``, ``prefix``, ``shard_bytes``, ``shard_rows``.

    All rows start in one bucket of depth 0; a bucket above ``limit`` bytes is split on its
    next hash bit until its halves fit.  A bucket of one row, or of rows that share all
    bits, stays as it is.  Splitting is worked out ``STEP`` bits at a time on sums per
    prefix, which each task combines first; only rows of buckets that are still too large
    take part in the next round.
    """
    found, rest, top = None, sizes, 0
    while True:
        bottom = min(BITS, top + STEP)
        cells = rest.groupBy(F.expr(f"shiftright(hash, {BITS - bottom})").alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("rows")
        )
        levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(top), F.lit(bottom))))
        sums = levels.groupBy("depth", F.expr(f"shiftright(cell, {bottom} - depth)").alias("prefix")).agg(
            F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows")
        )
        fits = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1) | (F.col("depth") == BITS)
        sums = materialize(sums.withColumn("fits", fits), "buckets")
        split = sums.where("NOT fits").select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        halves = sums.withColumn("parent", F.shiftright("prefix", 1)).join(split, ["depth", "parent"], "left_semi")
        roots = sums.where(F.col("depth") == top) if top == 0 else sums.limit(0)
        leaves = halves.drop("parent").unionByName(roots).where("fits").drop("fits")
        found = leaves if found is None else found.unionByName(leaves)
        large = sums.where((F.col("depth") == bottom) & ~F.col("fits"))
        if large.isEmpty():
            return materialize(found, "directory")
        cell = F.expr(f"shiftright(hash, {BITS - bottom})")
        rest = rest.withColumn("prefix", cell).join(large.select("prefix"), "prefix", "left_semi").select("hash", "bytes")
        top = bottom


def assign_shards(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``shard`` (its bits), ``depth``, ``shard_bytes``, ``shard_rows``.

    The bytes of a shard are those of its texts in UTF-8 and at most ``limit``, unless a
    single document is larger.  An id that occurs once is hashed; rows of one id, or of no
    id, are told apart by their number in the table and hashed by it too, so that they split
    like others.  A null text has no bytes; other columns are ignored; an empty table gives
    no rows.  Texts are not moved; every row meets its bucket by (depth, prefix), tried for
    each of the few depths that occur.
    """
    _, placed = _assigned(docs, limit, id_col, text_col)
    return placed.drop("row")


def _assigned(docs: DataFrame, limit: int, id_col: str, text_col: str) -> tuple[tuple[DataFrame, str], DataFrame]:
    """The numbered rows with the name of their number, and the shard of each number."""
    numbered, row = numbered_rows(docs, id_col)
    sizes = numbered.select(
        col(row).alias("row"), col(id_col).alias("doc_id"), F.coalesce(F.octet_length(col(text_col)), F.lit(0)).cast("bigint").alias("bytes")
    )
    key = F.col("doc_id").cast("string")
    if row != id_col:
        known = sizes.where("doc_id IS NOT NULL")
        # Stored first, so that the adaptive skew join can split a hot id.
        repeated = known.groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(True).alias("repeated"))
        known = known.join(materialize(repeated, "repeated"), "doc_id", "left")
        sizes = known.select(*sizes.columns, "repeated").unionByName(sizes.where("doc_id IS NULL").withColumn("repeated", F.lit(True)))
        key = F.when(F.col("repeated"), F.concat_ws("|", F.lit("row"), key, F.col("row").cast("string"))).otherwise(key)
    return (numbered, row), _placed(sizes.select("row", "doc_id", bucket_hash(key).alias("hash"), "bytes"), limit)


def _placed(sizes: DataFrame, limit: int) -> DataFrame:
    """The shard of each row of (``row``, ``doc_id``, ``hash``, ``bytes``)."""
    sizes = materialize(sizes, "sizes")
    buckets = directory(sizes.select("hash", "bytes"), limit)
    # At most BITS + 1 numbers.
    depths = sorted(r.depth for r in buckets.select("depth").distinct().collect())
    tried = sizes.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in depths]) if depths else F.array().cast("array<int>")))
    placed = tried.withColumn("prefix", F.expr(f"shiftright(hash, {BITS} - depth)")).join(buckets, ["depth", "prefix"])
    bits = F.when(F.col("depth") == 0, "").otherwise(F.expr("lpad(conv(prefix, 10, 2), depth, '0')"))
    return placed.select("row", "doc_id", bits.alias("shard"), "depth", "shard_bytes", "shard_rows")


def write_shards(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the documents, one folder per shard and one file in it; shards are those of `assign_shards`.

    Every row is written once.
    """
    (numbered, row), shards = _assigned(docs, limit, id_col, text_col)
    shards = shards.select(F.col("row").alias("__shard_of"), F.concat(F.lit("s"), "shard").alias("shard"))
    placed = numbered.join(shards, col(row) == F.col("__shard_of"))
    kept = [col(c) for c in docs.columns]
    placed.select(*kept, "shard").repartition("shard").write.partitionBy("shard").parquet(path)


def shard_sql(limit: int) -> str:
    """The same buckets in SQL: every document at every depth, and the first that fits."""
    return f"""
    WITH s AS (
        SELECT doc_id, coalesce(strlen(text), 0) AS bytes,
               CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, {BITS // 4}) AS BIGINT) AS hash
        FROM documents
    ), l AS (SELECT doc_id, bytes, CAST(d AS INTEGER) AS depth, hash >> ({BITS} - d) AS prefix FROM s, range(0, {BITS + 1}) r(d)),
    b AS (SELECT depth, prefix, sum(bytes) AS shard_bytes, count(*) AS shard_rows FROM l GROUP BY ALL),
    f AS (
        SELECT doc_id, depth, prefix, shard_bytes, shard_rows FROM l JOIN b USING (depth, prefix)
        WHERE shard_bytes <= {limit} OR shard_rows = 1 OR depth = {BITS}
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
    )
    SELECT doc_id, CASE depth WHEN 0 THEN '' ELSE right(lpad(bin(prefix), 64, '0'), depth) END AS shard,
           depth, CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_rows FROM f
    """
