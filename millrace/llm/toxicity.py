"""Toxicity scores from a bidirectional gated recurrent network with attention pooling."""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.clean import col
from millrace.llm.tokens import text_blocks

WIDTH, STRIDE = 32, 16  # words per window; each word lies in two windows
DIM, HIDDEN, ATTEND = 8, 8, 8
TRIGRAMS = 1 << 13
EDGE = "\x01"
PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + EDGE

#: Bounds of the training sample: labelled toxic rows, clean rows, characters of a row.
MOST_TOXIC, MOST_CLEAN, MOST_CHARS = 1200, 3600, 20_000
#: Steps of training at least.
LEAST_STEPS = 120
#: Most words and most beginnings of the sample that get a vector of their own; other words are read by character.
MOST_WORDS = 30_000
#: Letters that are the beginning of a word; beginnings that several texts hold get a vector too.
BEGIN = 3


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of all words in a row, and the number of each word."""
    joined = EDGE.join(words)
    if joined.count(EDGE) >= len(words):
        # Inside a word the edge is written as a blank, which no word holds.
        joined = EDGE.join([word.replace(EDGE, " ") for word in words])
    raw = np.frombuffer((EDGE + joined + EDGE).encode("utf-8", "replace"), np.uint8)
    inner = raw != ord(EDGE)
    edges = np.flatnonzero(~inner)
    x = raw.astype(np.uint32)
    mixed = (x[:-2] * 0x9E3779B1) ^ (x[1:-1] * 0x85EBCA77) ^ (x[2:] * 0xC2B2AE3D)
    mixed = (mixed ^ (mixed >> 15)) * np.uint32(0x2C1B3C6D)
    hashed = (mixed >> 19).astype(np.int64) % TRIGRAMS
    return hashed[inner[1:-1]], np.diff(edges) - 1


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


@dataclass
class Network:
    """Parameters, the words and beginnings that have a vector, and the passes through the network."""

    words: dict[str, int]
    begins: dict[str, int] = field(default_factory=dict)
    scale: tuple[float, float] = (1.0, 0.0)
    p: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self, rng: np.random.Generator) -> Network:
        def normal(*shape, scale=None):
            return rng.normal(0, scale or shape[0] ** -0.5, shape).astype(np.float32)

        self.p = {
            "word": np.zeros((len(self.words) + 1, DIM), np.float32),
            "begin": np.zeros((len(self.begins) + 1, DIM), np.float32),
            "char": normal(TRIGRAMS, DIM, scale=0.1),
        }
        for way in "fb":
            self.p |= {
                f"W{way}": normal(3 * DIM, 3 * HIDDEN),
                f"U{way}": normal(HIDDEN, 3 * HIDDEN),
                f"b{way}": np.zeros(3 * HIDDEN, np.float32),
            }
        self.p |= {
            "Wa": normal(2 * HIDDEN, ATTEND),
            "ba": np.zeros(ATTEND, np.float32),
            "va": normal(ATTEND),
            "wo": normal(2 * HIDDEN),
            "bo": np.full(1, -1.5, np.float32),
        }
        return self

    def inputs(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        """Vectors of the word and of its beginning beside the mean of those of its trigrams."""
        known = np.fromiter((self.words.get(w, len(self.words)) for w in words), np.int64, len(words))
        begun = np.fromiter((self.begins.get(w[:BEGIN], len(self.begins)) for w in words), np.int64, len(words))
        begin = np.where((begun < len(self.begins))[:, None], self.p["begin"][begun], 0)
        hashed, counts = trigrams(words)
        char = np.zeros((len(words), DIM), np.float32)
        full = counts > 0
        if full.any():
            starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
            char[full] = np.add.reduceat(self.p["char"][hashed], starts) / counts[full, None]
        return np.concatenate([self.p["word"][known], char, begin], 1), (known, begun, hashed, counts)

    def project(self, words: list[str]) -> np.ndarray:
        """What each word adds to the gates, forward and backward."""
        out = np.empty((len(words), 6 * HIDDEN), np.float32)
        for at in range(0, len(words), 20_000):
            x = self.inputs(words[at : at + 20_000])[0]
            out[at : at + 20_000] = np.concatenate([x @ self.p[f"W{way}"] + self.p[f"b{way}"] for way in "fb"], 1)
        return out

    def states(self, gates: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Both directions' states after every word of the windows: [n, WIDTH, 2 HIDDEN]."""
        n, width = mask.shape
        out = np.empty((n, width, 2 * HIDDEN), np.float32)
        for side, way in enumerate("fb"):
            u = self.p[f"U{way}"]
            h = np.zeros((n, HIDDEN), np.float32)
            for t in range(width) if way == "f" else range(width - 1, -1, -1):
                g = gates[:, t, 3 * HIDDEN * side : 3 * HIDDEN * (side + 1)]
                hu = h @ u
                zr = _sigmoid(g[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(g[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
                new = np.where(mask[:, t, None], c + z * (h - c), h)
                if keep is not None:
                    keep.append((way, t, h, hu, z, r, c))
                h = new
                out[:, t, HIDDEN * side : HIDDEN * (side + 1)] = h
        return out

    def pool(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, tuple]:
        u = np.tanh(states @ self.p["Wa"] + self.p["ba"])
        e = np.where(mask, u @ self.p["va"], -1e9)
        a = np.exp(e - e.max(1, keepdims=True)) * mask
        a /= np.maximum(a.sum(1, keepdims=True), 1e-9)
        pooled = np.einsum("nt,nth->nh", a, states)
        return pooled @ self.p["wo"] + self.p["bo"][0], (u, a, pooled)

    def logits(self, projected: np.ndarray, index: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """One number per window; rows of ``index`` point into ``projected``."""
        out = np.empty(len(index), np.float32)
        for at in range(0, len(index), 2048):
            part = slice(at, at + 2048)
            out[part] = self.pool(self.states(projected[index[part]], mask[part]), mask[part])[0]
        return out

    def gradients(self, words: list[str], index: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> dict:
        """Gradients of the mean cross entropy over windows."""
        p, n = self.p, len(index)
        used, place = np.unique(index, return_inverse=True)
        place = place.reshape(index.shape)
        x, (known, begun, hashed, counts) = self.inputs([words[i] for i in used])
        projected = np.concatenate([x @ p[f"W{way}"] + p[f"b{way}"] for way in "fb"], 1)
        gates, keep = projected[place], []
        states = self.states(gates, mask, keep)
        logit, (u, a, pooled) = self.pool(states, mask)
        d = ((_sigmoid(logit) - labels) / n).astype(np.float32)
        g = {"wo": pooled.T @ d, "bo": d.sum(keepdims=True)}
        d_pooled = d[:, None] * p["wo"]
        d_a = np.einsum("nth,nh->nt", states, d_pooled)
        d_e = a * (d_a - (a * d_a).sum(1, keepdims=True))
        d_u = d_e[..., None] * p["va"] * (1 - u * u)
        g |= {"va": np.einsum("nt,nta->a", d_e, u), "ba": d_u.sum((0, 1)), "Wa": np.einsum("nth,nta->ha", states, d_u)}
        d_states = a[..., None] * d_pooled[:, None] + d_u @ p["Wa"].T
        d_gates = np.zeros_like(gates)
        for side, way in enumerate("fb"):
            h2, width = HIDDEN * 2, 3 * HIDDEN
            g[f"U{way}"] = np.zeros_like(p[f"U{way}"])
            carry = np.zeros((n, HIDDEN), np.float32)
            for _, t, h, hu, z, r, c in reversed([k for k in keep if k[0] == way]):
                d_h = carry + d_states[:, t, HIDDEN * side : HIDDEN * (side + 1)]
                on = mask[:, t, None]
                d_new = np.where(on, d_h, 0)
                d_c = d_new * (1 - z) * (1 - c * c)
                d_z = d_new * (h - c) * z * (1 - z)
                d_r = d_c * hu[:, h2:] * r * (1 - r)
                d_hu = np.concatenate([d_z, d_r, d_c * r], 1)
                d_gates[:, t, width * side : width * (side + 1)] = np.concatenate([d_z, d_r, d_c], 1)
                g[f"U{way}"] += h.T @ d_hu
                carry = np.where(on, d_new * z, d_h) + d_hu @ p[f"U{way}"].T
        d_projected = np.zeros_like(projected)
        np.add.at(d_projected, place.ravel(), d_gates.reshape(-1, d_gates.shape[-1]))
        d_x = np.zeros_like(x)
        for side, way in enumerate("fb"):
            part = d_projected[:, 3 * HIDDEN * side : 3 * HIDDEN * (side + 1)]
            g[f"W{way}"], g[f"b{way}"] = x.T @ part, part.sum(0)
            d_x += part @ p[f"W{way}"].T
        g |= {k: np.zeros_like(p[k]) for k in ("word", "begin", "char")}
        np.add.at(g["word"], known, d_x[:, :DIM])
        g["word"][-1] = 0  # words without a vector of their own stay at the origin
        np.add.at(g["begin"], begun, d_x[:, 2 * DIM :])
        g["begin"][-1] = 0
        np.add.at(g["char"], hashed, np.repeat(d_x[:, DIM : 2 * DIM] / np.maximum(counts, 1)[:, None], counts, 0))
        return g


class _Adam:
    def __init__(self, p: dict, rate: float, decay: float = 1e-4) -> None:
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
        self.rate, self.decay, self.t = rate, decay, 0

    def step(self, p: dict, g: dict) -> None:
        self.t += 1
        size = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        scale = min(1.0, 1.0 / max(size, 1e-9))
        for k, x in g.items():
            x = x * scale
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.01 * (x * x - self.v[k])
            m, v = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.99**self.t)
            p[k] -= self.rate * (m / (np.sqrt(v) + 1e-8) + self.decay * p[k])


def _layout(flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word number, mask, and number of windows per text, for the texts' words in a row."""
    counts = np.maximum(1, -(-(lengths - WIDTH) // STRIDE) + 1)
    starts = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * STRIDE
    inside = starts[:, None] + np.arange(WIDTH)
    mask = inside < np.repeat(lengths, counts)[:, None]
    at = inside + np.repeat(np.cumsum(lengths) - lengths, counts)[:, None]
    index = flat[np.where(mask, at, 0)] if len(flat) else np.zeros_like(at)
    return np.where(mask, index, 0), mask, counts


def _common(owner: np.ndarray, codes: np.ndarray, names: list[str]) -> dict[str, int]:
    """Numbers of the names that more than one text holds, by falling number of texts."""
    pairs = np.unique(owner * len(names) + codes) % len(names)
    seen = np.bincount(pairs, minlength=len(names))
    listed = sorted((i for i in range(len(names)) if seen[i] > 1), key=lambda i: (-seen[i], names[i]))[:MOST_WORDS]
    return {names[i]: n for n, i in enumerate(listed)}


def fit(texts: list[str], labels: list[int], seed: int = 7, rounds: int = 3, refine: int = 3) -> Network:
    """Train on whole texts.

    First every window (eight of a text in each round) learns its text's label; then each
    text's highest window alone, since one toxic window makes a text toxic and none may
    in a clean one.  Every fourth text only serves to turn highest windows into
    probabilities.  A small sample is gone through more often.
    """
    place = np.zeros(len(labels), int)
    for y in (0, 1):
        of_class = np.flatnonzero(np.array(labels) == y)
        place[of_class] = np.arange(len(of_class))
    judged = [(t, y) for t, y, i in zip(texts, labels, place) if i % 4 == 3]
    learnt = [(t, y) for t, y, i in zip(texts, labels, place) if i % 4 != 3]
    texts, labels = [t for t, _ in learnt], [y for _, y in learnt]
    rng = np.random.default_rng(seed)
    flat, lengths, words = coded(texts)
    owner = np.repeat(np.arange(len(texts)), lengths)
    begins = sorted({w[:BEGIN] for w in words})
    number = {b: i for i, b in enumerate(begins)}
    begun = np.array([number[w[:BEGIN]] for w in words])
    network = Network(_common(owner, flat, words), _common(owner, begun[flat], begins)).start(rng)
    if not texts:
        return network
    index, mask, counts = _layout(flat, lengths)
    y = np.array(labels, np.float32)
    first = np.cumsum(counts) - counts
    adam = _Adam(network.p, 0.01)
    # A round is a step at least, so a tiny sample needs no more rounds than steps.
    rounds = max(rounds, min(LEAST_STEPS, -(-LEAST_STEPS * 256 // int(np.minimum(counts, 8).sum()))))
    refine = max(refine, min(LEAST_STEPS // 4, -(-LEAST_STEPS * 256 // len(counts) // 4)))
    for turn in range(rounds + refine):
        if turn < rounds:
            chosen = np.concatenate([f + rng.permutation(c)[:8] for f, c in zip(first, counts)])
        else:
            adam.rate = 0.004
            z = network.logits(network.project(words), index, mask)
            chosen = np.array([f + z[f : f + c].argmax() for f, c in zip(first, counts)])
        chosen = rng.permutation(chosen)
        text = np.searchsorted(first, chosen, "right") - 1
        for at in range(0, len(chosen), 256):
            part = chosen[at : at + 256]
            adam.step(network.p, network.gradients(words, index[part], mask[part], y[text[at : at + 256]]))
    if judged:
        network.scale = _scale(highest(network, [t for t, _ in judged]), np.array([y for _, y in judged]))
    return network


def _scale(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through scores, both classes of equal weight."""
    ones, zeros = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    weight = np.where(y == 1, 0.5 / ones, 0.5 / zeros)
    x, b = np.stack([z, np.ones_like(z)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        q = _sigmoid(x @ b)
        slope = x.T @ (weight * (q - target)) + 1e-3 * (b - [1, 0])
        curve = (x * (weight * q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        b = b - step / max(1.0, np.abs(step).max())
    return max(float(b[0]), 1e-3), float(b[1])


def coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Word numbers of all texts in a row, words of each text, and the distinct plain words.

    A plain word is in lower case and without punctuation at its ends.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pa.array(texts, pa.large_string())))
    words = lists.flatten().dictionary_encode()
    forms = pc.utf8_trim(pc.utf8_lower(words.dictionary), characters=PUNCTUATION).dictionary_encode()
    plain_of = forms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    codes = words.indices.to_numpy(zero_copy_only=False)
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    # Splitting an empty text gives one empty word.
    lengths = np.where([not t or t.isspace() for t in texts], 0, lengths) if len(texts) else lengths
    keep = np.repeat(lengths > 0, pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return plain_of[codes][keep] if len(codes) else codes, lengths, forms.dictionary.to_pylist() or [""]


def highest(network: Network, texts: list[str]) -> np.ndarray:
    """The number of each text's highest window; an empty text has one empty window."""
    if not texts:
        return np.empty(0)
    flat, lengths, words = coded(texts)
    index, mask, counts = _layout(flat, lengths)
    z = network.logits(network.project(words), index, mask)
    return np.maximum.reduceat(z, np.cumsum(counts) - counts).astype(np.float64)


def scores(network: Network, texts: list[str]) -> np.ndarray:
    """Probability of each text."""
    slope, offset = network.scale
    return _sigmoid(slope * highest(network, texts) + offset)


def training_rows(docs: DataFrame, labels: DataFrame, most: tuple[int, int], most_chars: int) -> list:
    """At most ``most`` labelled clean and toxic texts, the first by a hash of the id.

    Ids are chosen on narrow rows; the chosen few then go to the documents.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id")))
    fitting = docs.where(F.length("text") <= most_chars)
    usable = fitting.select("doc_id").join(known, "doc_id").distinct()
    order = ["toxic", F.xxhash64("doc_id"), "doc_id"]
    chosen = []
    for toxic, bound in enumerate(most):
        chosen += usable.where(F.col("toxic") == toxic).orderBy(*order).limit(bound).collect()
    if not chosen:
        return []
    # At most sum(most) rows of two numbers.
    listed = docs.sparkSession.createDataFrame(chosen, "doc_id bigint, toxic int")
    rows = fitting.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(listed), "doc_id")
    first = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return sorted(first.collect(), key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id))


def held_out(doc_id):
    """Rows kept for measuring: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    most_toxic: int = MOST_TOXIC,
    most_clean: int = MOST_CLEAN,
    most_chars: int = MOST_CHARS,
) -> Network:
    """Train on a bounded sample of labelled rows outside the held-out fold.

    The three bounds say how much reaches the driver; inputs are the texts alone.  A label
    given twice counts as toxic if either does, and a text that occurs under two ids is two
    rows.  Without labelled rows the network is untrained.
    """
    rows = training_rows(docs, labels, (most_clean, most_toxic), most_chars)
    return fit([r.text for r in rows], [r.toxic for r in rows])


def score(docs: DataFrame, network: Network, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """All columns of the documents, ``toxic_score`` (0 to 1) and ``toxic_predicted``.

    Every overlapping window of the whole text is scored; the highest counts.  A null or
    empty text has the score of one empty window.  Rows are scored where they are read,
    repeated ones alike; an empty table gives no rows.  Columns that have the output names,
    in any case, are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in ("toxic_score", "toxic_predicted")]
    # Plain names on the way through Arrow, whatever the columns are called.
    source = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(kept)])
    text_at = [c.lower() for c in kept].index(text_col.lower())
    schema = T.StructType([*source.schema.fields, T.StructField("toxic_score", T.DoubleType())])

    def scored(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [t or "" for t in batch.column(text_at).to_pylist()]
            found = [scores(network, block) for _, block in text_blocks(texts, 2_000_000)]
            values = pa.array(np.concatenate(found) if found else [], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, values], schema.names)

    out = source.mapInArrow(scored, schema)
    out = out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "toxic_score")
    return out.withColumn("toxic_predicted", (F.col("toxic_score") >= threshold).cast("int"))
