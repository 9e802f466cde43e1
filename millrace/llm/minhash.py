"""Near duplicates by DartMinHash signatures, banded joining and exact verification."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.clean import col
from millrace.llm.components import components
from millrace.llm.rows import numbered_rows, without
from millrace.llm.words import Words, mix
from millrace.sources.workspace import materialize

SHINGLE = 5
#: At a similarity of 0.8 a pair shares no band with a probability of (1 - 0.8 ** 4) ** 16,
#: two in ten thousand.
BANDS, BAND_ROWS = 16, 4

#: Documents that meet in one verification task.
BLOCK = 256


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts: text number, hash, and how often it occurs there.

    A text of fewer words than a shingle is one shingle; a text without words has none.
    """
    grams, counts = words.grams(size), words.counts
    owner = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(words.ends, counts) - np.arange(len(owner))
    whole = left >= size
    of, h = owner[whole], grams[whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        rng = np.random.default_rng(size)
        factors = rng.integers(1, 1 << 63, size, np.uint64) | np.uint64(1)
        own = []
        for i in short:
            lane = words.lanes[0][words.starts[i] : words.ends[i]]
            own.append(mix((lane * factors[: len(lane)]).sum(keepdims=True) + np.uint64(len(lane)))[0])
        of, h = np.concatenate([of, short]), np.concatenate([h, np.array(own, np.uint64)])
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (of[1:] != of[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return of[at], h[at], np.diff(np.append(at, len(h)))


def _uniform(h: np.ndarray) -> np.ndarray:
    """A number in (0, 1] from each hash."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def dart_signatures(
    of: np.ndarray, h: np.ndarray, weights: np.ndarray, n: int, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """DartMinHash: per text ``size`` hashes, equal in a place with the chance of weighted similarity.

    Element ``h`` of weight ``w`` owns the region [0, w) x [0, infinity): place times rank.
    Darts fall on it at rate one, the same for every text that has the element: the strip
    [0, 1) and each strip [2**k, 2**(k+1)) has its own arrivals in rank, drawn from hashes.
    Of the darts left of ``w``, each falls to one coordinate and the earliest of a
    coordinate is kept.  Only ranks below a bound that should fill all coordinates are
    thrown; texts with an empty coordinate get a doubled bound.  Returns signatures and
    which texts have one (those with any weight).
    """
    total = np.bincount(of, weights, n) if len(of) else np.zeros(n)
    bound = (size * np.log(size) + 2 * size) / np.maximum(total, 1e-12)
    out = np.zeros((n, size), np.uint64)
    todo = total > 0
    filled = todo.copy()
    while todo.any():
        best_of, best_rank, best_dart = [], [], []
        strips = [(0.0, 1.0)] + [(2.0**k, 2.0**k) for k in range(int(np.log2(max(1.0, weights.max()))) + 1)]
        for number, (low, width) in enumerate(strips):
            some = np.flatnonzero(todo[of] & (weights > low))
            key = mix(mix(h[some]) + np.uint64(number * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            owner, weight, rank = of[some], weights[some], np.zeros(len(some))
            arrival = 0
            while len(key):
                arrival += 1
                dart = mix(key ^ np.uint64(arrival * 0x632BE59BD9B4E019 & (1 << 64) - 1))
                rank = rank - np.log(_uniform(dart)) / width
                near = rank <= bound[owner]
                key, owner, weight, rank, dart = key[near], owner[near], weight[near], rank[near], dart[near]
                place = low + width * _uniform(mix(dart + np.uint64(1)))
                hit = place <= weight
                best_of.append(owner[hit])
                best_rank.append(rank[hit])
                best_dart.append(dart[hit])
        owner, rank, dart = (np.concatenate(x) for x in (best_of, best_rank, best_dart))
        value = mix(dart + np.uint64(2))
        slot = owner * size + (value % np.uint64(size)).astype(np.int64)
        order = np.lexsort((dart, rank, slot))
        slot, value = slot[order], value[order]
        first = np.ones(len(slot), bool)
        first[1:] = slot[1:] != slot[:-1]
        found = np.bincount(slot[first] // size, minlength=n)
        out.reshape(-1)[slot[first]] = value[first]
        todo &= found < size
        bound[todo] *= 2
    return out, filled


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band and text."""
    factors = np.random.default_rng([bands, rows]).integers(1, 1 << 63, rows, np.uint64) | np.uint64(1)
    folded = (signatures.reshape(len(signatures), bands, rows) * factors).sum(2)
    return mix(folded + np.arange(bands, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def _arrays(batch, most_bytes: int = 4_000_000):
    """Slices of an Arrow batch (id, text) of about so many bytes."""
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(batch):
        base = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, base + most_bytes)))
        yield batch.slice(start, stop - start)
        start = stop


SIGNED = "row bigint, same1 bigint, same2 bigint, n bigint, bands array<bigint>"


def _signed(weighted: bool, bands: int, rows: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in _arrays(batch):
                words = Words(part.column(1), 2)
                of, h, counts = shingles(words)
                weights = counts.astype(float) if weighted else np.ones(len(h))
                signatures, filled = dart_signatures(of, h, weights, len(part), bands * rows)
                keys = band_keys(signatures, bands, rows).view(np.int64)
                same = [_text_key(words, lane) for lane in range(2)]
                size = np.bincount(of, weights, len(part)).astype(np.int64)
                offsets = np.concatenate([[0], np.cumsum(np.where(filled, bands, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, pa.array(keys[filled].reshape(-1)))
                columns = [part.column(0), pa.array(same[0]), pa.array(same[1]), pa.array(size), lists]
                yield pa.RecordBatch.from_arrays(columns, ["row", "same1", "same2", "n", "bands"])

    return run


def _text_key(words: Words, lane: int) -> np.ndarray:
    """Hash of each text's words in their order."""
    order = np.arange(len(words.first)) - np.repeat(words.starts, words.counts)
    each = mix(words.lanes[lane] + mix(order.astype(np.uint64) + np.uint64(1)))
    sums = np.concatenate([[0], np.cumsum(each, dtype=np.uint64)]).astype(np.uint64)
    return mix(sums[words.ends] - sums[words.starts] + words.counts.astype(np.uint64)).view(np.int64)


SETS = "row bigint, n bigint, bands array<bigint>, shingles array<bigint>, counts array<int>"


def _sets(weighted: bool):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in _arrays(batch):
                of, h, counts = shingles(Words(part.column(1), 1))
                if not weighted:
                    counts = np.ones_like(counts)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(part)))]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (h.view(np.int64), counts.astype(np.int32))]
                names = ["row", "n", "bands", "shingles", "counts"]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), *lists], names)

    return run


class _Forest:
    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (up := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(up, up)
            x = up
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _similar(left: list[tuple], right: list[tuple], threshold: float) -> np.ndarray:
    """Which pairs of (shingles, counts) reach the threshold: sum of minima over sum of maxima."""
    sizes = [np.array([c.sum() for _, c in side], float) for side in (left, right)]
    shared = np.zeros((len(left), len(right)))
    own = [np.repeat(np.arange(len(side)), [len(s) for s, _ in side]) for side in (left, right)]
    flat = [np.concatenate([s for s, _ in side]) for side in (left, right)]
    weight = [np.concatenate([c for _, c in side]) for side in (left, right)]
    common = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    keep = [np.isin(f, common) for f in flat]
    columns = [np.searchsorted(common, f[k]) for f, k in zip(flat, keep)]
    highest = int(max((w[k].max() for w, k in zip(weight, keep) if k.any()), default=0))
    for at in range(0, len(common), 4096):
        for level in range(1, highest + 1):
            # The minimum of two counts is the number of levels that both reach.
            dense = []
            for side, rows in enumerate((len(left), len(right))):
                here = (columns[side] >= at) & (columns[side] < at + 4096) & (weight[side][keep[side]] >= level)
                m = np.zeros((rows, min(4096, len(common) - at)), np.float32)
                m[own[side][keep[side]][here], columns[side][here] - at] = 1
                dense.append(m)
            if not dense[0].any() or not dense[1].any():
                break
            shared += dense[0] @ dense[1].T
    union = sizes[0][:, None] + sizes[1][None] - shared
    return shared >= threshold * union - 1e-9


def _links(threshold: float):
    """Links found among the documents of one block, as a forest over their components."""

    def run(key, rows):
        import pandas as pd

        rows = rows.sort_values("row")
        sets = [(np.asarray(s), np.asarray(c)) for s, c in zip(rows["shingles"], rows["counts"])]
        ids, parts, sides = rows["row"].to_numpy(), rows["part"].to_numpy(), rows["side"].to_numpy()
        bands = np.array(rows["bands"].tolist(), np.int64)
        sizes = rows["n"].to_numpy(float)
        a, b = np.flatnonzero(sides <= 0), np.flatnonzero(sides >= 0)
        found, forest = [], _Forest()
        if len(a) and len(b):
            todo = parts[a][:, None] != parts[b][None]
            todo &= np.minimum(sizes[a][:, None], sizes[b][None]) >= threshold * np.maximum(sizes[a][:, None], sizes[b][None])
            if (band := int(rows["band"].iloc[0])) > 0:
                # Of the bands that two documents share, the first one compares them.
                for earlier in range(band):
                    todo &= bands[a, earlier][:, None] != bands[b, earlier][None]
            busy_a, busy_b = np.flatnonzero(todo.any(1)), np.flatnonzero(todo.any(0))
            if len(busy_a):
                a, b, todo = a[busy_a], b[busy_b], todo[np.ix_(busy_a, busy_b)]
                todo &= _similar([sets[i] for i in a], [sets[j] for j in b], threshold)
                for i, j in zip(*np.nonzero(todo)):
                    if forest.join(int(parts[a[i]]), int(parts[b[j]])):
                        found.append((ids[a[i]], ids[b[j]]))
        return pd.DataFrame(found, columns=["a", "b"])

    return run


def near_groups(
    docs: DataFrame,
    threshold: float = 0.8,
    weighted: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
    row_col: str | None = None,
) -> DataFrame:
    """Group documents that are linked by a similarity of ``threshold`` or more.

    One row per input row: ``doc_id``, ``row`` (its place in the input, or ``row_col``,
    which must then be unique and the same at every reading), ``class_id`` (the
    smallest id in its group, its own if it is alone), ``class_size`` and ``kept`` (true for
    one row of each group).  Similarity is Jaccard's over shingles of five words (lower
    case), each once, or as often as it occurs if ``weighted``; texts shorter than a shingle
    are one shingle; texts without words, and nulls, are alone.  A null id loses to any
    other; other columns are ignored; an empty table gives no rows.

    1. Texts of the same words are one document from here on.
    2. DartMinHash signatures are cut into bands; documents that share a band meet.
    3. In each bucket all meet its hub, the member that meets most documents over all bands,
       so a crowd of near copies becomes one component at linear cost.
    4. Members of a bucket that are still in different components are compared in blocks of
       ``BLOCK`` x ``BLOCK`` documents, each pair in the first band it shares; a block gives
       links between components only, never all its pairs.
    Every comparison is exact, on the whole sets.  Steps 3 and 4 deal a crowded bucket to
    many tasks.  All intermediate tables lie in the shared folder.
    """
    if row_col is None:
        docs, row_col = numbered_rows(docs.select(col(id_col), col(text_col)), id_col)
    source = docs.select(
        col(id_col).alias("doc_id"), F.lower(col(text_col)).alias("text"), col(row_col).cast("bigint").alias("row")
    )
    signed = materialize(
        source.select("row", "text").mapInArrow(_signed(weighted, bands, band_rows), SIGNED), "signatures"
    )
    same = signed.where("n > 0").groupBy("same1", "same2", "n")
    first = materialize(same.agg(F.min("row").alias("row"), F.min("bands").alias("bands")), "distinct")
    buckets = first.select("row", F.posexplode("bands").alias("band", "key"))
    crowded = buckets.groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    met = materialize(buckets.join(crowded, ["band", "key"]), "buckets")
    # Only documents that meet another need their sets.
    wanted = first.select("row", "n", "bands").join(met.select("row").distinct(), "row")
    texts = source.select("row", "text").join(wanted, "row").select("row", "text", "n", "bands")
    sets = materialize(texts.mapInArrow(_sets(weighted), SETS), "sets")
    fame = met.groupBy("row").agg(F.sum("size").alias("fame"))
    hub = met.join(fame, "row").groupBy("band", "key").agg(F.max(F.struct("fame", -F.col("row"))).alias("h"))
    star = met.join(hub, ["band", "key"]).select((-F.col("h.col2")).alias("hub"), "row").distinct()
    star = materialize(star.where("hub <> row"), "stars")
    crowd = star.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).alias("tasks"))
    spokes = star.join(crowd, "hub").select(
        "hub", F.pmod(F.xxhash64("row"), "tasks").alias("task"), "row", F.lit(1).alias("side")
    )
    hubs = crowd.select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), F.col("hub").alias("row"), F.lit(-1).alias("side")
    )
    meetings = spokes.union(hubs).join(sets, "row").withColumns({"part": F.col("row"), "band": F.lit(0)})
    linked = materialize(meetings.groupBy("hub", "task").applyInPandas(_links(threshold), "a bigint, b bigint"), "near")
    parts = materialize(components(linked, "a", "b"), "parts")

    split = met.join(parts, met["row"] == parts["node"], "left").select(
        met["*"], F.coalesce("root", "row").alias("part")
    )
    mixed = split.groupBy("band", "key").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q")
    left = split.join(mixed.select("band", "key"), ["band", "key"])
    left = left.withColumn("blocks", F.ceil(F.col("size") / BLOCK))
    left = left.withColumn("block", F.pmod(F.xxhash64("row"), "blocks"))
    # A member meets every block once: (i, j) with i <= j; on the diagonal it is on both sides.
    met_again = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "band", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.signum(F.col("block") - F.col("other")).cast("int").alias("side"), "row", "part",
    )
    compared = met_again.join(sets, "row").groupBy("band", "key", "i", "j")
    more = materialize(compared.applyInPandas(_links(threshold), "a bigint, b bigint"), "near")
    parts = materialize(components(linked.union(more), "a", "b"), "parts")

    classes = signed.select("row", "same1", "same2", "n").join(
        first.select("same1", "same2", "n", F.col("row").alias("node")), ["same1", "same2", "n"], "left"
    )
    classes = classes.join(parts, "node", "left").select("row", F.coalesce("root", "node", "row").alias("class"))
    members = materialize(source.select("row", "doc_id").join(classes, "row"), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    best = members.groupBy("class").agg(F.min(order).alias("best"), F.count("*").alias("class_size"))
    return members.join(best, "class").select(
        "doc_id", F.col("best.id").alias("class_id"), "class_size", (F.col("best.row") == F.col("row")).alias("kept"), "row"
    )


def drop_near(docs: DataFrame, threshold: float = 0.8, **options) -> DataFrame:
    """The documents without all but one row of each near-duplicate group, all columns as they are."""
    numbered, row = numbered_rows(docs)
    groups = near_groups(numbered, threshold, row_col=row, **options)
    return without(numbered, row, groups.where("NOT kept"), docs.columns)
