"""Ranked search against a plain version and DuckDB."""

import math
import random
import re
from collections import Counter

import oracle
import pytest
from millrace.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k):
    counted = [(doc, Counter(words(text))) for doc, text in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counted:
            m = 75 + 25 * sum(c.values()) * n_docs // max(n_terms, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in words(text)
                if t in c
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, row[3], -row[0]) for i, row in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def random_docs(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünder", "ÀB", "x\u0085y", "7"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, rng.choice([" ", "\t", "-", "_\x7f"]).join(rng.choices(vocabulary, weights, k=rng.randrange(0, 80)))) for i in range(n)]
    docs += [(None, "w50 w51 w52"), (None, None), (5, None), (6, ""), (7, "w50 w51 w52"), (7, "w50 w51 w52"), (8, "same w3 words")]
    docs += [(1000 + i, "SAME w3 words") for i in range(30)]
    docs.append((2000, "w1 " * 50_000 + "w59"))
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 40)))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "absent terms"), (53, "w50 W51 w52"), (53, "w50 W51 w52"), (54, "same same w3"), (None, "w40 w41")]
    return docs, items


@pytest.mark.parametrize("seed,k,block", [(1, 20, 8 << 20), (2, 3, 400), (3, 1, 2000)])
def test_against_plain(spark, monkeypatch, seed, k, block):
    docs, items = random_docs(seed, 300)
    given = spark.createDataFrame([(*d, 0) for d in docs], "doc_id bigint, text string, `score` int").repartition(4)
    asked = spark.createDataFrame([(*i, "c") for i in items], "item_id bigint, text string, doc_id string")
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    monkeypatch.setattr(lexical, "FAN_IN", 2)
    found = lexical.ranked_search(given, asked, k, query_bytes=4 << 20 if seed == 1 else 300)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(docs, items, k)


def test_limit_does_stop():
    """With one rare term far above the rest no accumulators are made for the others."""
    import numpy as np

    block = lexical._Block()
    vocabulary = {b"rare": 0, b"often": 1}
    for i in range(200):
        block.add(i, b"often rare" if i % 10 == 0 else b"often", vocabulary)
    names = [part.split()[0] for part in lexical.INDEX.split(", ")]
    postings = lexical._Postings(dict(zip(names, block.row())), np.array([5000, 1]), 200, 220)
    at, scores = postings.search([(0, 1), (1, 1)], 5, 0)
    assert len(at) == 20 and set(at.tolist()) == set(range(0, 200, 10))
    assert len(set(scores.tolist())) == 1


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = ("Abc déf " * 1000 + "é" * 500).encode()
    whole = [t for part in lexical.terms(text) for t in part]
    monkeypatch.setattr(lexical, "SLICE", 7)
    assert [t for part in lexical.terms(text) for t in part] == whole


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a")], []), ([], []), ([(1, None)], [(1, "a")])])
def test_empty(spark, docs, items):
    given = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert lexical.ranked_search(given, spark.createDataFrame(items, "item_id bigint, text string")).collect() == []


def test_query(spark, sf_dir):
    df = queries.QUERIES["op11_lexical_search"](spark, sf_dir)
    assert oracle.differences(df, oracle.connect(sf_dir), queries.ORACLES["op11_lexical_search"]) is None
