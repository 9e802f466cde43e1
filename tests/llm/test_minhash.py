import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from millrace.llm import minhash
from millrace.llm.components import components
from millrace.llm.queries import op6_near_dedup
from millrace.llm.words import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(text, weighted=False):
    words = WORD.findall((text or "").lower())
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
    found = Counter(grams)
    return found if weighted else Counter(set(grams))


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(texts, threshold, weighted=False):
    """Class of every text by comparing all pairs."""
    sets, up = [sets_of(t, weighted) for t in texts], list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= threshold:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))]


def cloud(rng, n, words, edits):
    base = [f"w{i}" for i in rng.integers(0, 5000, words)]
    out = [" ".join(base)]
    for _ in range(n - 1):
        copy = list(base)
        for _ in range(rng.integers(0, edits + 1)):
            copy[rng.integers(words)] = f"x{rng.integers(10**6)}"
        out.append(" ".join(copy))
    return out


def test_signatures_estimate_similarity():
    a = " ".join(["rep"] * 60 + [f"a{i}" for i in range(300)] + [f"b{i}" for i in range(60)])
    b = " ".join(["rep"] * 20 + [f"a{i}" for i in range(300)] + [f"c{i}" for i in range(60)])
    for weighted in (False, True):
        of, h, counts = minhash.shingles(Words(pa.array([a, b, "", None, "one"])))
        weights = counts.astype(float) if weighted else np.ones(len(h))
        got, filled = minhash.dart_signatures(of, h, weights, 5, 4096)
        assert filled.tolist() == [True, True, False, False, True]
        expected = jaccard(sets_of(a, weighted), sets_of(b, weighted))
        assert (got[0] == got[1]).mean() == pytest.approx(expected, abs=0.04)
        assert len(np.unique(got[0])) > 4000 or weighted


def test_fractional_weights():
    h = np.arange(1, 401, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rng = np.random.default_rng(0)
    x, y = rng.uniform(0.1, 5, 400), rng.uniform(0.1, 5, 400)
    of, both = np.repeat([0, 1], 400), np.concatenate([h, h])
    got, _ = minhash.dart_signatures(of, both, np.concatenate([x, y]), 2, 4096)
    assert (got[0] == got[1]).mean() == pytest.approx(np.minimum(x, y).sum() / np.maximum(x, y).sum(), abs=0.04)


@pytest.mark.parametrize("weighted", [False, True])
def test_against_all_pairs(spark, monkeypatch, weighted):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = np.random.default_rng(3)
    texts = cloud(rng, 120, 60, 4) + cloud(rng, 30, 200, 12) + cloud(rng, 5, 400, 3)
    texts += ["", None, "  ", "one two", "one two", "One  TWO", "one", "a b c d e", texts[0].upper(), "z " * 3000]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, bands string, part int").repartition(3)
    expected = brute(texts, 0.8, weighted)
    found = minhash.near_groups(df, weighted=weighted, bands=64).collect()
    got = {r.doc_id: r.class_id for r in found}
    assert [got[i] for i in range(len(texts))] == expected
    sizes = Counter(expected)
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in found)


def test_ties_nulls_and_nothing(spark):
    rows = [(None, "a b c d e f g"), (4, "a b c d e f g"), (4, "a b c d e f g"), (None, "q"), (7, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = minhash.near_groups(df).collect()
    assert sorted((r.doc_id or -1, r.class_id or -1, r.class_size) for r in found) == [
        (-1, -1, 1), (-1, 4, 3), (4, 4, 3), (4, 4, 3), (7, 7, 1),
    ]
    assert sum(r.kept for r in found) == 3
    assert minhash.near_groups(df.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    links = spark.range(60).selectExpr("(id * 37) % 61 AS a", "((id + 1) * 37) % 61 AS b")
    found = components(links, "a", "b").collect()
    assert sorted(r.node for r in found) == list(range(61)) and {r.root for r in found} == {0}


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    expected = brute([r.text for r in docs], 0.8)
    got = {r.doc_id: r.class_id for r in op6_near_dedup(spark, sf_dir).collect()}
    assert [got[r.doc_id] for r in docs] == [docs[i].doc_id for i in expected]
