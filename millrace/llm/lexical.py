"""Ranked lexical search: term-at-a-time scoring with a limited set of accumulators."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.clean import col
from millrace.llm.rows import numbered_rows
from millrace.llm.sharding import assign_shards
from millrace.sources.workspace import materialize

#: Bytes of query texts answered by one pass over the documents.
QUERY_BYTES = 4 << 20
#: Bytes of text that make a block of the index; only a longer text makes more.
BLOCK_BYTES = 8 << 20
#: Bytes of a long text cut into terms at once.
SLICE = 4 << 20
#: Tasks whose best rows meet in one group of the first merge.
FAN_IN = 256

#: Byte by byte: A-Z lowered, everything that is neither a digit, a letter nor part of a
#: code point above U+007F a blank.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

INDEX = (
    "n_docs bigint, n_terms bigint, doc_ids binary, valid binary, lengths binary, "
    "terms binary, starts binary, docs binary, counts binary"
)
FOUND = "item bigint, task int, doc_id bigint, score bigint"


def terms(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a list a slice."""
    start = 0
    while start < len(data):
        stop = start + SLICE
        if stop < len(data):
            # A slice ends between two terms.
            while stop < len(data) and TERM_BYTES[data[stop]] != 0x20:
                stop += 1
        yield data[start:stop].translate(TERM_BYTES).split()
        start = stop


class _Block:
    """Documents gathered until they make a block of the index."""

    def __init__(self) -> None:
        self.ids, self.valid, self.lengths = [], [], []
        self.places, self.hits = [], []
        self.n_docs = self.n_terms = self.size = 0

    def add(self, doc: int | None, data: bytes, vocabulary: dict[bytes, int]) -> None:
        length, hits = 0, []
        for found in terms(data):
            length += len(found)
            hits.append(np.array([vocabulary[t] for t in found if t in vocabulary], np.int64))
        self.size += len(data) + 64
        self.n_terms += length
        self.n_docs += length > 0
        hits = np.concatenate(hits) if hits else np.empty(0, np.int64)
        if len(hits):
            self.places.append(np.full(len(hits), len(self.ids), np.int64))
            self.hits.append(hits)
            self.ids.append(doc or 0)
            self.valid.append(doc is not None)
            self.lengths.append(length)

    def row(self) -> tuple:
        """The block as one row: postings by term, a term's documents ascending."""
        none = np.empty(0, np.int64)
        key = np.concatenate(self.hits or [none]) << 32 | np.concatenate(self.places or [none])
        pairs, counts = np.unique(key, return_counts=True)
        term, starts = np.unique(pairs >> 32, return_index=True)
        columns = [
            np.array(self.ids, "<i8"),
            np.array(self.valid, "u1"),
            np.array(self.lengths, "<i8"),
            term.astype("<i4"),
            starts.astype("<i8"),
            (pairs & 0xFFFFFFFF).astype("<i4"),
            counts.astype("<i8"),
        ]
        return self.n_docs, self.n_terms, *[c.tobytes() for c in columns]


def build_index(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Blocks of postings of the vocabulary's terms, each over documents of one input split."""

    def build(batches):
        import pyarrow as pa

        names = [part.split()[0] for part in INDEX.split(", ")]

        def batch(block):
            values = [pa.array([v]) for v in block.row()]
            return pa.RecordBatch.from_arrays(values, names)

        block = _Block()
        for given in batches:
            for doc, text in zip(given.column(0).to_pylist(), given.column(1)):
                block.add(doc, bytes(text.as_buffer() or b""), vocabulary)
                if block.size >= BLOCK_BYTES:
                    yield batch(block)
                    block = _Block()
        if block.size:
            yield batch(block)

    source = docs.select(col(id_col).cast("bigint").alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    return source.mapInArrow(build, INDEX)


def document_frequencies(index: DataFrame, size: int) -> dict[int, int]:
    """Documents of each term that occurs: at most as many rows as the vocabulary has terms."""

    def count(batches):
        import pyarrow as pa

        total = np.zeros(size, np.int64)
        for given in batches:
            for held, first, n in zip(*(given.column(i).to_pylist() for i in range(3))):
                starts = np.frombuffer(first, "<i8")
                total[np.frombuffer(held, "<i4")] += np.diff(np.append(starts, n // 4))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["term", "n"])

    partial = index.select("terms", "starts", F.length("docs").cast("bigint").alias("n")).mapInArrow(count, "term bigint, n bigint")
    return {r["term"]: r["n"] for r in partial.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def weight(n_docs: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency + 1)))


class _Postings:
    """One block: the share of every posting, and the best share of every term."""

    def __init__(self, row: dict, weights: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.ids = np.frombuffer(row["doc_ids"], "<i8")
        self.valid = np.frombuffer(row["valid"], "u1")
        lengths = np.frombuffer(row["lengths"], "<i8")
        held = np.frombuffer(row["terms"], "<i4")
        starts = np.frombuffer(row["starts"], "<i8")
        self.docs = np.frombuffer(row["docs"], "<i4")
        counts = np.frombuffer(row["counts"], "<i8")
        # Whole numbers of any size: 25 n N may leave 64 bits in a very large corpus.
        norm = np.array([75 + 25 * n * n_docs // n_terms for n in lengths.tolist()], np.int64)
        ends = np.append(starts[1:], len(self.docs))
        by_term = np.repeat(weights[held], ends - starts)
        self.shares = by_term * ((1_000_000_000 * counts) // (1000 * counts + 12 * norm[self.docs]))
        best = np.maximum.reduceat(self.shares, starts) if len(starts) else starts
        self.place = {t: (s, e, b) for t, s, e, b in zip(held.tolist(), starts.tolist(), ends.tolist(), best.tolist())}

    def search(self, wanted: list[tuple[int, int]], k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the block that may be among the ``k`` best, and their scores.

        ``wanted`` are (term, occurrences in the query), rarest first; ``bar`` is the score
        that the ``k`` best so far reach.  Accumulators are made as long as a document seen
        for the first time could still reach the ``k``-th best partial score; from then on
        only existing ones are updated, to their exact scores.
        """
        lists = [(*self.place[t], times) for t, times in wanted if t in self.place]
        left = sum(best * times for _, _, best, times in lists)
        score = np.zeros(len(self.ids), np.int64)
        alive = np.zeros(len(self.ids), bool)
        for start, end, best, times in lists:
            docs, shares = self.docs[start:end], self.shares[start:end] * times
            if left >= bar:
                score[docs] += shares
                alive[docs] = True
                partial = score[alive]
                if len(partial) >= k:
                    bar = max(bar, int(np.partition(partial, len(partial) - k)[len(partial) - k]))
            else:
                known = alive[docs]
                score[docs[known]] += shares[known]
            left -= best * times
        at = np.flatnonzero(alive & (score >= max(bar, 1)))
        return at, score[at]


def _best(rows: list[tuple], k: int) -> list[tuple]:
    """The best of (score, has an id, id): highest score, then lowest id, no id last."""
    return sorted(rows, key=lambda r: (-r[0], not r[1], r[2]))[:k]


def _search(index: DataFrame, queries: dict[int, list[tuple[int, int]]], weights: np.ndarray, totals: tuple, k: int) -> DataFrame:
    """The ``k`` best documents of every query among the blocks of each task."""
    names = index.columns

    def search(batches):
        import pyarrow as pa

        held: dict[int, list[tuple]] = {item: [] for item in queries}
        for given in batches:
            columns = [given.column(i).to_pylist() for i in range(len(names))]
            for row in zip(*columns):
                block = _Postings(dict(zip(names, row)), weights, *totals)
                for item, wanted in queries.items():
                    mine = held[item]
                    at, scores = block.search(wanted, k, mine[-1][0] if len(mine) == k else 0)
                    if len(at):
                        found = zip(scores.tolist(), block.valid[at].astype(bool).tolist(), block.ids[at].tolist())
                        held[item] = _best([*mine, *found], k)
        task = TaskContext.get().partitionId()
        rows = [(item, task, doc if valid else None, score) for item, mine in held.items() for score, valid, doc in mine]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        columns = zip(*rows) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["item", "task", "doc_id", "score"])

    return index.mapInArrow(search, FOUND)


def _answers(docs: DataFrame, items: list[tuple[int, str | None]], k: int, id_col: str, text_col: str) -> DataFrame:
    """The best rows of each task for a block of queries."""
    vocabulary: dict[bytes, int] = {}
    asked = {}
    for item, text in items:
        counts: dict[int, int] = {}
        for found in terms((text or "").encode()):
            for t in found:
                number = vocabulary.setdefault(t, len(vocabulary))
                counts[number] = counts.get(number, 0) + 1
        asked[item] = counts
    index = materialize(build_index(docs, vocabulary, id_col, text_col), "lexical")
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    frequencies = document_frequencies(index, len(vocabulary))
    weights = np.zeros(len(vocabulary), np.int64)
    for t, n in frequencies.items():
        weights[t] = weight(n_docs, n)
    queries = {
        item: sorted(((t, times) for t, times in counts.items() if weights[t] > 0), key=lambda q: (frequencies[q[0]], q[0]))
        for item, counts in asked.items()
    }
    return _search(index.where("length(docs) > 0"), queries, weights, (n_docs or 0, n_terms or 1), k)


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 for every item, over all documents.

    One row per hit: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``; equal scores go by
    ascending id.  Terms are unbroken runs of digits, letters and code points above U+007F,
    A-Z lowered.  With N documents that have a term, L their terms and df the documents of a
    term, its weight is ``floor(1000 ln((2 N + 2) / (2 df + 1)))`` and a document of n terms that
    holds it tf times gets ``weight * (10**9 tf div (1000 tf + 12 m))``, ``m = 75 + 25 n N div L``.

    Queries are taken in blocks of at most ``query_bytes`` of text (or one longer item), so the
    vocabulary that goes to the tasks is bounded; every block is one pass over the documents.
    It writes their postings, by blocks of documents, to the shared folder; df, N and L are
    summed over all of them before any document is scored.  Each task then ranks its blocks
    with limited accumulators, and its best ``k`` rows per item meet those of other tasks in
    two rounds.  Postings are never shuffled, so frequent terms make no hot group.

    A null text has no terms; an item without terms, or whose terms occur nowhere, has no
    rows.  Rows of one item id are ranked each on its own, repeated documents each count and
    are ranked; a null document id comes last among equals, a null item id stays null.  Empty
    tables give no rows; other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    given = items.select(col(item_col).cast("bigint").alias("item_id"), col(item_text_col).alias("text"))
    numbered, row = numbered_rows(given, "item_id")
    numbered = materialize(numbered.select(F.col(row).alias("item"), "item_id", "text"), "items")
    size = numbered.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size <= query_bytes:
        blocks = [numbered.select("item", "text")]
    else:
        shards = materialize(assign_shards(numbered, query_bytes, "item", "text").select(F.col("doc_id").alias("item"), "shard"), "blocks")
        # One row per block of queries.
        names = [r["shard"] for r in shards.select("shard").distinct().collect()]
        blocks = [numbered.join(shards.where(F.col("shard") == name), "item", "left_semi").select("item", "text") for name in names]
    found = None
    for block in blocks:
        rows = [tuple(r) for r in block.collect()]
        if rows:
            part = _answers(docs, rows, k, id_col, text_col)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], FOUND)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    near = Window.partitionBy("item", "_near").orderBy(*order)
    whole = Window.partitionBy("item").orderBy(*order)
    some = found.withColumn("_near", F.expr(f"task div {FAN_IN}")).withColumn("_rank", F.row_number().over(near))
    best = some.where(F.col("_rank") <= k).withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
    # One row per item: Spark broadcasts either side by its size, or neither.
    return best.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def search_sql(k: int) -> str:
    """The same ranking by DuckDB."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"unnest(regexp_extract_all({lower.format('text')}, '{pattern}'))"
    return f"""
    WITH d AS (SELECT doc_id, {words} AS term FROM documents),
    c AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
    s AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM c GROUP BY ALL),
    a AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM s),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
          FROM c, a GROUP BY term),
    q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {words} AS term FROM benchmark) GROUP BY ALL),
    r AS (SELECT item_id, doc_id,
                 CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll)))) AS BIGINT) AS score
          FROM q JOIN w USING (term) JOIN c USING (term) JOIN s USING (doc_id), a GROUP BY item_id, doc_id),
    t AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
          FROM r WHERE score > 0)
    SELECT * FROM t WHERE rank <= {k}
    """
