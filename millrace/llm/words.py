"""Words of whole texts as 64-bit hashes, worked out on the text's bytes by numpy."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np

#: The white space between words: blank, and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes worked on at once; only a longer word makes more.
SLICE = 1 << 20
#: Longer words are hashed by BLAKE2, since the sum below is weak for long periodic ones.
LONG_WORD = 64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits (a permutation)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@functools.cache
def _lane(seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    table = rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    return table, rng.integers(1, 1 << 63, LONG_WORD + 1, np.uint64) * np.uint64(2) + np.uint64(1)


def _slices(raw: np.ndarray, space: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``SLICE`` bytes that end between words."""
    start, end = 0, len(raw)
    while start < end:
        stop = min(end, start + SLICE)
        while stop < end and not space[stop] and stop not in cuts:
            after = np.flatnonzero(space[stop : stop + SLICE])
            stop = stop + int(after[0]) if len(after) else min(end, stop + SLICE)
        yield start, stop
        start = stop


class Words:
    """The words of an Arrow string array, in order.

    ``first`` and ``last`` are byte positions in ``raw``, ``lanes`` independent hashes (one
    array per lane), ``counts`` the words of each text.  A null has none.
    """

    def __init__(self, array, lanes: int = 1) -> None:
        import pyarrow as pa
        import pyarrow.compute as pc

        array = pc.fill_null(array.cast(pa.large_string()), "")
        offsets = np.zeros(1, np.int64)
        if len(array):
            offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
        data = array.buffers()[2]
        self.raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
        offsets = offsets - offsets[0]
        edges = np.unique(offsets) if len(array) else np.empty(0, np.int64)
        first, last, hashed = [], [], []
        space = SPACE[self.raw]
        cuts = set(edges.tolist())
        for start, stop in _slices(self.raw, space, cuts):
            a, b, h = self._slice(start, stop, space, edges, lanes)
            first.append(a)
            last.append(b)
            hashed.append(h)
        self.first = np.concatenate(first) if first else np.empty(0, np.int64)
        self.last = np.concatenate(last) if last else np.empty(0, np.int64)
        self.lanes = [np.concatenate([h[k] for h in hashed]) if hashed else np.empty(0, np.uint64) for k in range(lanes)]
        self.counts = np.diff(np.searchsorted(self.first, offsets)) if len(array) else np.empty(0, np.int64)
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts

    def _slice(self, start, stop, space, edges, lanes):
        raw, inside = self.raw[start:stop], ~space[start:stop]
        cut = np.zeros(len(raw) + 1, bool)
        cut[0] = cut[-1] = True
        here = edges[(edges >= start) & (edges < stop)] - start
        cut[here] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | cut[1:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | cut[1:-1]
        a, b = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        sizes = b - a
        long = np.flatnonzero(sizes > LONG_WORD)
        step = np.zeros(len(raw), np.int64)
        step[a] = np.diff(a, prepend=0)
        place = np.arange(len(raw)) - np.cumsum(step)
        np.minimum(place, LONG_WORD, out=place)
        np.maximum(place, 0, out=place)
        out = []
        for lane in range(lanes):
            table, power = _lane(lane)
            value = table[raw] * power[place]
            value[~inside] = 0
            total = np.add.reduceat(value, a) if len(a) else np.empty(0, np.uint64)
            hashed = mix(total ^ (sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            for i in long:
                digest = hashlib.blake2b(raw[a[i] : b[i]].tobytes(), digest_size=8, salt=bytes([lane])).digest()
                hashed[i] = int.from_bytes(digest, "little")
            out.append(hashed)
        return a + start, b + start, out

    def grams(self, size: int, lane: int = 0, seed: int = 0) -> np.ndarray:
        """Hash of the ``size`` words from every place; places near the end hold rubbish."""
        factors = np.random.default_rng([seed, size]).integers(1, 1 << 63, size, np.uint64) * np.uint64(2) + np.uint64(1)
        h = self.lanes[lane]
        total = np.zeros(max(0, len(h)), np.uint64)
        for j, factor in enumerate(factors):
            total[: len(h) - j] += h[j:] * factor
        return mix(total)
