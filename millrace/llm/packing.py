"""Packing documents into fixed windows, guided by the sum of squared level counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.clean import col
from millrace.llm import tokens

PIECES = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, ids binary"
)

#: Open windows a task holds before it empties them by cutting.
MOST_OPEN = 4096


class Levels:
    """Partly filled windows by fill level.

    ``counts[h]`` windows hold ``h`` ids.  A piece of ``s`` ids goes to the level ``h``
    (0: a new window) for which the sum of ``counts[h] ** 2`` over the partly filled levels
    becomes smallest; of equal ones the fullest.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(capacity)]
        self.n_open = 0

    def place(self, size: int) -> int:
        counts, end = self.counts, self.capacity
        reach = end - size
        change = 2 * (counts[size : end + 1] - counts[: reach + 1]) + 2
        change[0] = 2 * counts[size] + 1
        change[reach] -= 1
        change[1:][counts[1 : reach + 1] == 0] = np.iinfo(np.int64).max
        return reach - int(np.argmin(change[::-1]))

    def add(self, piece: tuple) -> list | None:
        """Put the piece (its ids last) in a window; the window if that filled it."""
        size = len(piece[-1]) // 4
        level = self.place(size)
        if level:
            window = self.open[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append(piece)
        if level + size == self.capacity:
            return window
        self.open[level + size].append(window)
        self.counts[level + size] += 1
        self.n_open += 1
        return None

    def drain(self) -> Iterator[list]:
        """Empty all levels: pieces of the emptiest windows are cut to fill the fullest.

        All windows but the last come out full.
        """
        rest = [(level, w) for level in range(self.capacity) for w in self.open[level]]
        self.__init__(self.capacity)
        low, high = 0, len(rest) - 1
        while low <= high:
            fill, window = rest[high]
            while fill < self.capacity and low < high:
                left, donor = rest[low]
                doc, start, total, ids = donor.pop()
                take = min(self.capacity - fill, len(ids) // 4)
                window.append((doc, start, total, ids[: 4 * take]))
                if 4 * take < len(ids):
                    donor.append((doc, start + take, total, ids[4 * take :]))
                fill, left = fill + take, left - take
                rest[low] = (left, donor)
                low += left == 0
            yield window
            high -= 1


def _documents(blocks: Iterator[tuple], end_id: int) -> Iterator[tuple]:
    """(document id, its ids and the end id as bytes) from blocks of encoded texts."""
    for docs, ids, starts in blocks:
        data = memoryview(np.insert(ids, starts[1:], end_id).astype("<u4", copy=False)).cast("B")
        ends = (4 * (starts + np.arange(len(starts)))).tolist()
        for i, doc in enumerate(docs):
            yield doc, bytes(data[ends[i] : ends[i + 1]])


def _windows(documents: Iterator[tuple], capacity: int) -> Iterator[list]:
    levels = Levels(capacity)
    for doc, ids in documents:
        total = len(ids) // 4
        whole = total // capacity * capacity
        for start in range(0, whole, capacity):
            yield [(doc, start, total, ids[4 * start : 4 * (start + capacity)])]
        if whole < total and (full := levels.add((doc, whole, total, ids[4 * whole :]))):
            yield full
        if levels.n_open >= MOST_OPEN:
            yield from levels.drain()
    yield from levels.drain()


def pack(
    docs: DataFrame,
    capacity: int = 1024,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` ids.

    One row per piece: ``doc_id``, ``start`` (ids of its document before it), ``length``,
    ``doc_tokens`` (with the end id), ``sequence_id``, ``offset`` in the sequence, and
    ``ids`` (little-endian unsigned 32-bit).  Every id lies in exactly one piece.

    Each task packs the rows of its own input split, so nothing is shuffled, and holds at
    most ``MOST_OPEN`` open windows.  Whole windows of long documents are cut off first;
    the rest is placed by `Levels`.  What stays open is emptied by cutting, so a task pads
    at most its last sequence.  A null text is empty (its piece is the end id), a null id
    stays null, repeated rows are packed each on its own, other columns are ignored, an
    empty table gives no rows.  The tokenizer's added tokens are read in the texts, as the
    library does.
    """
    if capacity < 2:
        raise ValueError("a window holds at least two ids")
    path = tokenizer or tokens.default_path()

    def packed(batches):
        import pyarrow as pa

        sequence = TaskContext.get().partitionId() << 40
        rows, size = [], 0

        def batch():
            names = ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")
            columns = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:6]]
            return pa.RecordBatch.from_arrays([*columns, pa.array([r[6] for r in rows], pa.binary())], [*names, "ids"])

        for window in _windows(_documents(tokens.encoded(batches, path), end_id), capacity):
            offset = 0
            for doc, start, total, ids in window:
                length = len(ids) // 4
                rows.append((doc, start, length, total, sequence, offset, ids))
                offset += length
            sequence, size = sequence + 1, size + 1
            if size == 4096:
                yield batch()
                rows, size = [], 0
        if rows:
            yield batch()

    source = docs.select(col(id_col).cast("bigint").alias("id"), col(text_col).alias("text"))
    return source.mapInArrow(packed, PIECES)


def pack_digests(docs: DataFrame, capacity: int = 1024, end_id: int = 0, **options) -> DataFrame:
    """The pieces with a checksum in place of the ids."""
    pieces = pack(docs, capacity, end_id, **options)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
