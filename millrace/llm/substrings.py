"""Repeated passages: seeds on winnowed anchors, extended both ways to maximal repeats."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.clean import col
from millrace.llm.minhash import _arrays
from millrace.llm.words import Words, mix
from millrace.sources.workspace import materialize

#: Words of an anchor.  Every window of 20 words holds 13 of them and picks one.
ANCHOR = 8

SEEDS = "anchor bigint, context bigint, ord bigint, start int, span int, again boolean"
SPANS = "ord bigint, n_words bigint, kept string, spans array<struct<start:int,length:int>>"


def _windows(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows, the text of each, and two hashes of each."""
    left = np.repeat(words.ends, words.counts) - np.arange(len(words.first))
    start = np.flatnonzero(left >= window)
    of = np.repeat(np.arange(len(words.counts)), words.counts)[start]
    return start, of, words.grams(window, 0, 1)[start], words.grams(window, 1, 2)[start]


def _seeds(words: Words, window: int):
    """Anchors with the run of windows that picked each, and a hash of all words of the run.

    A window picks its anchor of smallest hash, the leftmost of equals, so equal windows
    pick the same one wherever they stand and each window belongs to one anchor.  The run's
    words are those of its first and last window, which overlap.
    """
    start, of, h0, h1 = _windows(words, window)
    if not len(start):
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty, empty, np.empty(0, bool)
    grams = words.grams(ANCHOR)
    best, place = grams[start], start.copy()
    for j in range(1, window - ANCHOR + 1):
        value = grams[start + j]
        better = value < best
        best = np.where(better, value, best)
        place[better] = start[better] + j
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    span = last - first
    shape = (place[first] - start[first]).astype(np.uint64) * np.uint64(64) + span.astype(np.uint64)
    context = mix(mix(h0[first] + shape) + mix(h1[first]) * np.uint64(3) + mix(h0[last]) * np.uint64(5) + mix(h1[last] + np.uint64(1)))
    anchor, of = best[first], of[first]
    order = np.lexsort((first, context, anchor, of))
    again = np.zeros(len(first), bool)
    a, b = order[1:], order[:-1]
    again[a] = (anchor[a] == anchor[b]) & (context[a] == context[b]) & (of[a] == of[b])
    return anchor.view(np.int64), context.view(np.int64), of, start[first] - words.starts[of], span, again


def _seed_rows(window: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in _arrays(batch):
                anchor, context, of, start, span, again = _seeds(Words(part.column(1), 2), window)
                ids = part.column(0).to_numpy(zero_copy_only=False)[of] if len(of) else np.empty(0, np.int64)
                columns = [anchor, context, ids, start.astype(np.int32), span.astype(np.int32), again]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], ["anchor", "context", "ord", "start", "span", "again"]
                )

    return run


def _flat(lists, field: str) -> np.ndarray:
    return lists.flatten().field(field).to_numpy(zero_copy_only=False).astype(np.int64)


def _marked(part, words: Words, window: int):
    """Windows of a slice that are known repeats, and those to be settled, with their hashes."""
    marks = part.column(2)
    of = np.repeat(np.arange(len(part)), np.diff(marks.offsets.to_numpy()))
    start, span = _flat(marks, "start"), _flat(marks, "span")
    settled = marks.flatten().field("settled").to_numpy(zero_copy_only=False).astype(bool)
    size = span + 1
    run = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    place = np.repeat(start, size) + run
    owner, known = np.repeat(of, size), np.repeat(settled, size)
    at = words.starts[owner[~known]] + place[~known]
    return owner, place, known, words.grams(window, 0, 1)[at], words.grams(window, 1, 2)[at]


def _first_of_each(owner: np.ndarray, place: np.ndarray, h0: np.ndarray, h1: np.ndarray) -> np.ndarray:
    """Index, for each window, of the first equal window of its text."""
    order = np.lexsort((place, h1, h0, owner))
    new = np.ones(len(order), bool)
    a, b = order[1:], order[:-1]
    new[1:] = (owner[a] != owner[b]) | (h0[a] != h0[b]) | (h1[a] != h1[b])
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else order
    out = np.empty(len(order), np.int64)
    out[order] = first
    return out


def _open_windows(window: int):
    """Rows (window hash, document, start) of the windows to be settled, once a document."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in _arrays(batch):
                owner, place, known, h0, h1 = _marked(part, Words(part.column(1), 2), window)
                owner, place = owner[~known], place[~known]
                own = _first_of_each(owner, place, h0, h1) == np.arange(len(owner))
                ids = part.column(0).to_numpy(zero_copy_only=False)
                columns = [h0[own].view(np.int64), h1[own].view(np.int64), ids[owner[own]], place[own].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h0", "h1", "ord", "start"])

    return run


def _spans(window: int):
    """The text without the words of repeated windows, and the maximal repeats."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in _arrays(batch):
                words = Words(part.column(1), 2)
                owner, place, known, h0, h1 = _marked(part, words, window)
                repeat = known.copy()
                open_at = np.flatnonzero(~known)
                first = _first_of_each(owner[open_at], place[open_at], h0, h1)
                later = first != np.arange(len(first))
                found = part.column(3)
                lengths = np.diff(found.offsets.to_numpy())
                told = np.repeat(np.arange(len(part)), lengths) << 32 | found.flatten().to_numpy(zero_copy_only=False)
                told = np.isin(owner[open_at] << 32 | place[open_at], told)
                repeat[open_at] = later | told[first]
                cover = np.zeros(len(words.first) + 1, np.int64)
                begin = words.starts[owner[repeat]] + place[repeat]
                np.add.at(cover, begin, 1)
                np.add.at(cover, begin + window, -1)
                gone = np.cumsum(cover)[:-1] > 0
                rows = []
                raw = words.raw.tobytes()
                for i, ident in enumerate(part.column(0).to_pylist()):
                    a, b = int(words.starts[i]), int(words.ends[i])
                    keep = a + np.flatnonzero(~gone[a:b])
                    kept = b" ".join([raw[x:y] for x, y in zip(words.first[keep].tolist(), words.last[keep].tolist())])
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].astype(np.int8), [0]])))
                    spans = [{"start": x, "length": y - x} for x, y in edge.reshape(-1, 2).tolist()]
                    rows.append((ident, b - a, kept.decode(), spans))
                kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0]), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()), pa.array(columns[3], kind)],
                    ["ord", "n_words", "kept", "spans"],
                )

    return run


def ordered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(ord, doc_id, text): a number per row that grows with the id.

    Unique ids are that number themselves.  Otherwise rows are sorted by id (nulls last) and
    text, dealt by ranges, and numbered by their place.
    """
    source = docs.select(col(id_col).cast("bigint").alias("doc_id"), col(text_col).alias("text"))
    rows, ids = source.agg(F.count("*"), F.count_distinct("doc_id")).first()
    if rows == ids:
        return source.select(F.col("doc_id").alias("ord"), "doc_id", "text")
    last = F.col("doc_id").isNull()
    placed = source.repartitionByRange(last, "doc_id", "text").sortWithinPartitions(last, "doc_id", "text")
    return materialize(placed.select(F.monotonically_increasing_id().alias("ord"), "doc_id", "text"), "ordered")


def repeats(source: DataFrame, window: int = 20) -> DataFrame:
    """Documents of `ordered` that hold a repeat: ``ord``, ``n_words``, ``kept``, ``spans``.

    A repeat is a window of ``window`` words that starts earlier too, in a document before
    or in the same one.  ``spans`` are the maximal runs of words that repeats cover, and
    ``kept`` the other words, joined by a blank.

    Seeds: every window picks an anchor of eight words, and rows meet by anchor.  Only one
    row per anchor goes on from the meeting: how many there are, the first document, and
    whether all have the same words around them (the whole run of windows that picked the
    anchor).  If they do, all but the first are repeats as they stand.  Else each is
    extended both ways, window by window, and windows meet by a 128-bit hash of all their
    words.  No pairs are formed: a passage that n documents share costs n rows, combined in
    each task before they meet, and its way back is a skewed join that the adaptive
    execution splits.  Anchors are worked out twice rather than stored.
    """
    if window <= ANCHOR:
        raise ValueError(f"a window has more than {ANCHOR} words")
    texts = source.where(F.col("text").isNotNull()).select("ord", "text")
    seeds = texts.mapInArrow(_seed_rows(window), SEEDS)
    shared = seeds.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("ord").alias("lead"), F.min("context").alias("c0"), F.max("context").alias("c1")
    )
    shared = materialize(shared.where("n > 1").select("anchor", "lead", (F.col("c0") == F.col("c1")).alias("settled")), "anchors")
    met = seeds.join(shared, "anchor").where("NOT settled OR again OR ord > lead")
    marks = materialize(met.groupBy("ord").agg(F.collect_list(F.struct("start", "span", "settled")).alias("marks")), "marks")
    touched = materialize(texts.join(marks, "ord"), "touched")

    open_windows = touched.mapInArrow(_open_windows(window), "h0 bigint, h1 bigint, ord bigint, start int")
    open_windows = materialize(open_windows, "windows")
    leads = open_windows.groupBy("h0", "h1").agg(F.min("ord").alias("lead"), F.count("*").alias("n")).where("n > 1")
    later = open_windows.join(leads, ["h0", "h1"]).where("ord > lead")
    told = later.groupBy("ord").agg(F.collect_list(F.col("start").cast("bigint")).alias("told"))
    both = touched.join(told, "ord", "left").select(
        "ord", "text", "marks", F.coalesce("told", F.array().cast("array<bigint>")).alias("told")
    )
    return materialize(both.mapInArrow(_spans(window), SPANS), "spans")


BLANKS = "[\\x20\\x09-\\x0D]+"


def remove_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document: ``doc_id``, ``n_words``, ``n_removed``, ``text`` (kept words) and ``spans``.

    A null text has no words.  Of equal ids the smaller text counts as earlier, a null id
    as last; other columns are ignored; an empty table gives no rows.
    """
    source = ordered(docs, id_col, text_col)
    whole = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), BLANKS, " "))
    base = source.select("ord", "doc_id", whole.alias("whole"))
    found = repeats(source, window)
    none = F.array().cast("array<struct<start:int,length:int>>")
    return base.join(found, "ord", "left").select(
        "doc_id",
        _count_words(F.col("whole")).alias("n_words"),
        _removed(F.col("spans")).alias("n_removed"),
        F.coalesce("kept", "whole").alias("text"),
        F.coalesce("spans", none).alias("spans"),
    )


def _count_words(text):
    blanks = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return F.when(text == "", 0).otherwise(blanks + 1).cast("bigint")


def _removed(spans):
    return F.coalesce(F.aggregate(spans, F.lit(0), lambda total, s: total + s["length"]), F.lit(0)).cast("bigint")


def repeat_digests(docs: DataFrame, window: int = 20) -> DataFrame:
    """Like `remove_repeats` with a digest of the kept words; texts without repeats stay where they are."""
    source = ordered(docs)
    whole = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), BLANKS, " "))
    base = source.select("ord", "doc_id", whole.alias("whole")).select(
        "ord", "doc_id", _count_words(F.col("whole")).alias("n_words"), F.sha2("whole", 256).alias("sha")
    )
    found = repeats(source, window).select("ord", _removed(F.col("spans")).alias("n_removed"), F.sha2("kept", 256).alias("kept"))
    return base.join(found, "ord", "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("kept", "sha").alias("kept_sha256"),
    )
