"""Exact nearest neighbours of binary codes by incremental multi-index hashing."""

from __future__ import annotations

import math
from itertools import groupby, pairwise

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.clean import col
from millrace.sources.workspace import materialize

#: Probes, and candidates, that a task works on at once.
PROBES = 1 << 19
#: Bits of a segment at most, which bounds the offsets of its values to 16 MB.
WIDEST = 20
#: Queries, and neighbours of queries, that a task holds, and entries that it indexes at once, at most; entries worth
#: a task of their own.
QUERIES, NEIGHBOURS, ENTRIES, LEAST = 1 << 16, 1 << 20, 1 << 19, 1 << 10
#: The distance of a neighbour not found yet.
FAR = 1 << 30


def sign_codes(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(``id``, ``code``): one bit per component, set where it is above zero; and the bits.

    A code is an array of 64-bit words.  Rows with a null id or vector, or of another length
    than the longest, have no code.
    """
    vector = col(vector_col)
    bits = rows.agg(F.max(F.size(vector))).first()[0] or 0
    bits = max(bits, 0)

    def word(start: int):
        part = F.slice(vector, start + 1, min(64, bits - start))
        # A null or NaN component counts as not above zero.
        bit = F.transform(part, lambda x, i: F.when((x > 0) & ~F.isnan(x), F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(0))
        return F.aggregate(bit, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))

    valid = col(id_col).isNotNull() & (F.size(vector) == bits) & (F.size(vector) > 0)
    words = F.array(*[word(at) for at in range(0, bits, 64)]) if bits else F.array().cast("array<bigint>")
    return rows.where(valid).select(col(id_col).alias("id"), words.alias("code")), bits


def _segments(bits: int, codes: int) -> list[tuple[int, int, int]]:
    """(word, shift, width) of the code's segments, each about log2(codes) bits wide, narrow ones first."""
    wide = min(WIDEST, max(4, round(math.log2(max(2, codes)))))
    out = []
    for at in range(0, bits, 64):
        size = min(64, bits - at)
        n = max(1, round(size / wide))
        edges = [size * i // n for i in range(n + 1)]
        out += [(at // 64, a, b - a) for a, b in zip(edges, edges[1:])]
    return sorted(out, key=lambda segment: segment[2])


def _value(code: np.ndarray, segment: tuple[int, int, int]) -> np.ndarray:
    word, shift, width = segment
    return (code[:, word] >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64)


def _index(entry: np.ndarray, segment: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The entries in the order of the segment's value, and where each value begins and the last ends."""
    value = _value(entry, segment)
    edges = np.zeros((1 << segment[2]) + 1, np.int32)
    np.cumsum(np.bincount(value, minlength=1 << segment[2]), out=edges[1:])
    return np.argsort(value, kind="stable").astype(np.int32), edges


def _merge(best: tuple[np.ndarray, np.ndarray], query: np.ndarray, distance: np.ndarray, c: np.ndarray) -> None:
    """Work found entries, which may be known or repeated, into the queries' nearest ones."""
    far, who = best
    some = np.unique(query)
    row, place = np.nonzero(far[some] < FAR)
    query = np.concatenate([query, some[row]])
    distance = np.concatenate([distance, far[some[row], place]])
    c = np.concatenate([c, who[some[row], place]])
    order = np.lexsort((c, distance, query))
    query, distance, c = query[order], distance[order], c[order]
    new = np.append(True, (query[1:] != query[:-1]) | (c[1:] != c[:-1]))
    query, distance, c = query[new], distance[new], c[new]
    first = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
    place = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
    kept = place < far.shape[1]
    far[query[kept], place[kept]], who[query[kept], place[kept]] = distance[kept], c[kept]


def _improve(code: np.ndarray, best: tuple[np.ndarray, np.ndarray], entry: np.ndarray, c: np.ndarray, bits: int) -> None:
    """Look for nearer entries of each query in a block of entries, by radii that grow until its kth distance is covered."""
    far, who = best
    segments = _segments(bits, len(c))
    index = [_index(entry, segment) for segment in segments]
    ones = {width: np.bitwise_count(np.arange(1 << width, dtype=np.uint32)) for _, _, width in segments}
    for radius in range(max(ones) + 1):
        flips = {width: np.flatnonzero(count == radius) for width, count in ones.items()}
        for s, segment in enumerate(segments):
            # Every code nearer than this has been found by the looks before.
            wanted = np.flatnonzero(far[:, -1] >= len(segments) * radius + s)
            if not len(wanted):
                return
            flip, (order, edges) = flips[segment[2]], index[s]
            step = max(1, PROBES // max(1, len(flip)))
            for at in range(0, len(wanted) if len(flip) else 0, step):
                some = wanted[at : at + step]
                probe = _value(code[some], segment)[:, None] ^ flip
                start, n = edges[probe], edges[probe + 1] - edges[probe]
                ends = np.cumsum(n.sum(axis=1))
                cuts = np.searchsorted(ends, np.arange(PROBES, ends[-1] + PROBES, PROBES))
                for a, b in pairwise(np.unique([0, *np.minimum(cuts + 1, len(some))])):
                    # All entries from each start, as many as the value has; those of a query are no more than the block.
                    starts, sizes = start[a:b].ravel(), n[a:b].ravel().astype(np.int64)
                    till = np.cumsum(sizes)
                    if not till[-1]:
                        continue
                    met = order[np.arange(till[-1]) + np.repeat(starts - (till - sizes), sizes)]
                    query = np.repeat(some[a:b], n[a:b].sum(axis=1))
                    distance = np.bitwise_count(code[query] ^ entry[met]).sum(axis=1, dtype=np.int64)
                    last = far[query, -1]
                    near = (distance < last) | (distance == last) & (c[met] < who[query, -1])
                    if near.any():
                        _merge(best, query[near], distance[near], c[met[near]])


def _search(bits: int, k: int, at_once: int):
    """The ``k`` nearest entries of each query of a cell: rows come by cell, queries (``entry`` 0) before entries."""
    words = -(-bits // 64)

    def runs(batches):
        for batch in batches:
            cell, entry, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            code = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, words).view(np.uint64)
            turns = np.flatnonzero((np.diff(cell) != 0) | (np.diff(entry) != 0)) + 1
            for a, b in pairwise([0, *turns, len(cell)]):
                if a < b:
                    yield cell[a], entry[a], key[a:b], code[a:b]

    def blocks(rows, most):
        held, size = [], 0
        for _, _, key, code in rows:
            while len(key):
                held.append((key[: most - size], code[: most - size]))
                key, code = key[most - size :], code[most - size :]
                size += len(held[-1][0])
                if size == most:
                    yield tuple(map(np.concatenate, zip(*held)))
                    held, size = [], 0
        if held:
            yield tuple(map(np.concatenate, zip(*held)))

    def run(batches):
        import pyarrow as pa

        for _, rows in groupby(runs(batches), lambda row: row[0]):
            best = None
            for entry, some in groupby(rows, lambda row: row[1]):
                if not entry:
                    asked, code = map(np.concatenate, zip(*((key, code) for _, _, key, code in some)))
                    best = np.full((len(asked), k), FAR), np.full((len(asked), k), -1)
                elif best:
                    for c, codes in blocks(some, at_once):
                        _improve(code, best, codes, c, bits)
            for at in range(0, len(asked) if best else 0, max(1, PROBES // k)):
                far, who = (x[at : at + max(1, PROBES // k)] for x in best)
                query = np.repeat(asked[at : at + len(far)], (far < FAR).sum(axis=1))
                columns = [query, who[far < FAR], far[far < FAR].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["q", "c", "distance"])

    return run


def nearest_codes(codes: DataFrame, queries: DataFrame, k: int, bits: int) -> DataFrame:
    """The ``k`` nearest rows of each query by Hamming distance, ties by id, itself included.

    ``codes`` and ``queries`` have ``id`` and ``code``; rows come out as ``query_id``,
    ``id``, ``distance`` and ``rank``.  If there are fewer than ``k`` rows all are returned.

    Rows of equal code are one entry of the index, in the order of their smallest ids, and
    (since ties go by id) only their ``k`` smallest ids count; queries of equal code are
    searched once.  Entries are dealt into streams and queries into groups; a cell is a stream
    and a group, and one task.  It takes its entries block by block and cuts their codes into
    m segments of about log2(entries) bits, each with an index of the block.  In round r every
    open query looks up all values at distance r from its segments and verifies what it
    finds on whole codes.  After j of the segments, every code within m * r + j - 1 has been
    found, so a query whose kth verified distance is d so far, over all blocks before, looks
    no further once that distance is covered; it stays exact however far that is.  Probes
    and candidates stay inside the task, a bounded number at once, and at most ``k`` entries a
    query leave it.  Streams follow the number of tasks and not that of rows, so the
    rows between tasks grow with the queries and, once there are several groups, the entries.
    """
    spark = codes.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    entries = codes.groupBy("code").agg(F.min("id").alias("first")).orderBy("first")
    entries = materialize(entries.select(F.monotonically_increasing_id().alias("c"), "code"), "entries")
    asked = queries.select("code").distinct().withColumn("q", F.monotonically_increasing_id())
    asked = materialize(asked, "asked")
    total, wanted = entries.count(), asked.count()
    if not total or not wanted or k < 1:
        return queries.limit(0).select(
            F.col("id").alias("query_id"), "id", F.lit(0).alias("distance"), F.lit(0).cast("int").alias("rank")
        )
    groups = -(-wanted // max(1, min(QUERIES, NEIGHBOURS // k)))
    streams = min(-(-tasks // groups), -(-total // LEAST))

    def dealt(rows: DataFrame, key: str, parts: int, others: int, is_entry: int) -> DataFrame:
        part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("part")
        rows = rows.select(part, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias("other"), F.col(key).alias("key"), "code")
        cell = F.expr(f"other * {streams} + part" if is_entry else f"part * {streams} + other")
        return rows.select(cell.alias("cell"), F.lit(is_entry).alias("entry"), "key", "code")

    cells = dealt(asked, "q", groups, streams, 0).unionByName(dealt(entries, "c", streams, groups, 1))
    cells = cells.repartitionByRange(streams * groups, "cell").sortWithinPartitions("cell", "entry")
    found = cells.mapInArrow(_search(bits, k, ENTRIES), "q bigint, c bigint, distance int")
    nearest = Window.partitionBy("q").orderBy("distance", "c")
    found = found.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k)
    answers = materialize(found.select("q", "c", "distance"), "answers")
    first = Window.partitionBy("code").orderBy("id")
    members = codes.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k)
    members = members.join(entries.select("code", "c"), "code").select("c", "id")
    best = Window.partitionBy("q").orderBy("distance", "id")
    ranked = answers.join(members, "c").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    ranked = ranked.select("q", "id", "distance", "rank")
    names = queries.select(F.col("id").alias("query_id"), "code").join(asked, "code").select("query_id", "q")
    return names.join(ranked, "q").select("query_id", "id", "distance", "rank")


def nearest_vectors(
    rows: DataFrame, k: int, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest rows, by the signs of their components, of every row whose id ``every`` divides.

    Rows without a code (null id or vector, other length) neither ask nor are found; of
    repeated ids each row counts; other columns are ignored; an empty table gives no rows.
    """
    codes, bits = sign_codes(rows, id_col, vector_col)
    codes = materialize(codes, "codes")
    return nearest_codes(codes, codes.where(F.col("id") % every == 0), k, bits)


def nearest_sql(k: int, every: int = 100) -> str:
    return f"""
    WITH e AS (SELECT vec_id, [x > 0 FOR x IN embedding] AS code FROM embeddings),
    d AS (
        SELECT q.vec_id AS query_id, e.vec_id AS id,
               CAST(len([1 FOR p IN list_zip(q.code, e.code) IF p[1] <> p[2]]) AS INTEGER) AS distance
        FROM e q, e WHERE q.vec_id % {every} = 0
    )
    SELECT query_id, id, distance,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS INTEGER) AS rank
    FROM d QUALIFY rank <= {k}
    """
