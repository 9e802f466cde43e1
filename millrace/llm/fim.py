"""Fill-in-the-middle: documents cut at code point boundaries and put in another order."""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.clean import col

#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Offsets a container of the boundary set covers.
SPAN = 1 << 16
#: Bytes of output sent at once; only a longer text makes more.
BATCH_BYTES = 16 << 20

FORMS = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


class _Array:
    """Offsets as they are: for few of them."""

    def __init__(self, starts: np.ndarray) -> None:
        self.values = np.flatnonzero(starts).astype(np.uint16)

    def select(self, rank: int) -> int:
        return int(self.values[rank])


class _Bitmap:
    """One bit an offset, with the set bits before every byte."""

    def __init__(self, starts: np.ndarray) -> None:
        self.bits = np.packbits(starts, bitorder="little")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)])

    def select(self, rank: int) -> int:
        byte = int(np.searchsorted(self.before, rank, "right")) - 1
        left, value = rank - int(self.before[byte]), int(self.bits[byte])
        for _ in range(left):
            value &= value - 1
        return 8 * byte + (value & -value).bit_length() - 1


class _Runs:
    """First offsets of unbroken runs, with the offsets in all runs before."""

    def __init__(self, first: np.ndarray, last: np.ndarray) -> None:
        self.first = first
        self.before = np.concatenate([[0], np.cumsum(last - first)])

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.before, rank, "right")) - 1
        return int(self.first[run]) + rank - int(self.before[run])


def _container(starts: np.ndarray):
    """The smallest of the three forms: 2 bytes an offset, 4 a run, or a bit for each place."""
    edges = np.flatnonzero(np.diff(starts.view(np.int8), prepend=0, append=0))
    first, last = edges[::2], edges[1::2]
    size = int((last - first).sum())
    cost = {4 * len(first): "runs", 2 * size: "array", -(-len(starts) // 8): "bitmap"}
    form = cost[min(cost)]
    made = _Runs(first, last) if form == "runs" else _Array(starts) if form == "array" else _Bitmap(starts)
    return made, size


class Boundaries:
    """The byte offsets at which the code points of a UTF-8 text begin, and its end.

    A set of offsets in containers of ``SPAN``; ``before`` holds the offsets in all
    containers before each one.  ``select(k)`` is the offset of code point ``k``: the
    container by binary search on ``before``, the rest inside it.
    """

    def __init__(self, raw: np.ndarray) -> None:
        self.end = len(raw)
        self.containers, self.before = [], [0]
        for base in range(0, len(raw), SPAN):
            made, size = _container((raw[base : base + SPAN] & 0xC0) != 0x80)
            self.containers.append(made)
            self.before.append(self.before[-1] + size)

    def __len__(self) -> int:
        """Code points of the text."""
        return self.before[-1]

    def select(self, rank: int) -> int:
        if rank == len(self):
            return self.end
        place = bisect_right(self.before, rank) - 1
        return place * SPAN + self.containers[place].select(rank - self.before[place])


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document: two cuts, whether it is cut, and the order."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def cut(doc_id: int | None, data, seed: int, percent: int, spm_percent: int, marks: tuple[bytes, bytes, bytes]) -> tuple:
    """(code points, form, prefix and middle code points, output) of one text in UTF-8."""
    bounds = Boundaries(np.frombuffer(data, np.uint8))
    n, data = len(bounds), bytes(data)
    one, two, keep, order = draws(doc_id, seed)
    if not n or keep % 100 >= percent or any(mark in data for mark in marks):
        return n, "plain", None, None, data
    low, high = sorted((one % (n + 1), two % (n + 1)))
    a, b = bounds.select(low), bounds.select(high)
    view = memoryview(data)
    before, after, middle = marks
    head, tail = (before, view[:a]), (after, view[b:])
    form, parts = ("spm", [*tail, *head]) if order % 100 < spm_percent else ("psm", [*head, *tail])
    return n, form, low, high - low, b"".join([*parts, middle, view[a:b]])


def fill_in_middle(
    docs: DataFrame,
    seed: int = 1,
    percent: int = 90,
    spm_percent: int = 20,
    marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Cut ``percent`` of the documents into prefix, middle and suffix, the middle moved to the end.

    One row per row of ``docs``: ``doc_id``, ``n`` (code points), ``form``, ``prefix_chars``,
    ``middle_chars`` (null for plain ones) and ``output``.  Both cuts are drawn evenly from the
    ``n + 1`` boundaries by a hash of the id, so runs agree whatever the partitions.  ``psm`` is
    prefix, suffix, middle, each behind its mark; ``spm`` (``spm_percent`` of the cut ones) has
    the suffix first.  A text that holds a mark stays plain, so `restored` is exact.

    Narrow: no shuffle, other columns are ignored.  A null text is empty and plain, a null id
    stays null and draws like an empty one, rows of one id draw alike, an empty table gives no
    rows.  A text is held whole by its task, in its batch and its output.
    """
    wanted = tuple(m.encode() for m in marks)
    names = [part.split()[0] for part in FORMS.split(", ")]

    def transformed(batches):
        import pyarrow as pa

        def batch(rows):
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        rows, size = [], 0
        for given in batches:
            for doc, text in zip(given.column(0).to_pylist(), given.column(1)):
                made = cut(doc, text.as_buffer() or b"", seed, percent, spm_percent, wanted)
                rows.append((doc, *made))
                size += len(made[-1])
                if size > BATCH_BYTES:
                    yield batch(rows)
                    rows, size = [], 0
        if rows:
            yield batch(rows)

    source = docs.select(col(id_col).cast("bigint").alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    return source.mapInArrow(transformed, FORMS)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that was cut, from an output and its form: each mark occurs in it once."""
    before, after, middle = marks
    end = F.substring_index(output, middle, -1)
    rest = F.substring_index(output, middle, 1)

    def parts(first: str, second: str) -> tuple[Column, Column]:
        head = F.substring_index(F.substring_index(rest, second, 1), first, -1)
        return head, F.substring_index(rest, second, -1)

    prefix, suffix = parts(before, after)
    late_suffix, late_prefix = parts(after, before)
    return (
        F.when(form == "psm", F.concat(prefix, end, suffix))
        .when(form == "spm", F.concat(late_prefix, end, late_suffix))
        .otherwise(output)
    )


def middle_digests(docs: DataFrame, **options) -> DataFrame:
    """Forms with checksums of the output and of the text restored from it."""
    made = fill_in_middle(docs, **options)
    marks = options.get("marks", (PREFIX, SUFFIX, MIDDLE))
    back = restored(F.col("output"), F.col("form"), marks)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


def fim_sql() -> str:
    """The same rows by DuckDB, at the default shares and seed."""
    return f"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
               sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    u AS (
        SELECT doc_id, t, n,
               CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
               CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4 FROM d),
    f AS (
        SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
               CASE WHEN n = 0 OR h3 >= 90 OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}')
                    THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
    p AS (SELECT *, substring(t, 1, a) AS head, substring(t, a + 1, b - a) AS mid, substring(t, b + 1, n) AS tail FROM f)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t
                  WHEN 'psm' THEN '{PREFIX}' || head || '{SUFFIX}' || tail || '{MIDDLE}' || mid
                  ELSE '{SUFFIX}' || tail || '{PREFIX}' || head || '{MIDDLE}' || mid END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p
    """
