"""Texts that hold the byte which marks the edges of words."""

import numpy as np
from millrace.llm import toxicity

TEXTS = ["a\x01b", "plain words", "\x01", "a \x01\x01 b\x01\x01c \x01d", "w " * 40 + "x\x01y", "\x01a\x01 \x01"]


def test_counts_belong_to_words():
    words = ["a\x01b", "", "cd", "é\x01\x01f", "g"]
    hashed, counts = toxicity.trigrams(words)
    assert counts.tolist() == [3, 0, 2, 5, 1] and len(hashed) == 11
    alone = [toxicity.trigrams([w])[0] for w in words]
    assert hashed.tolist() == np.concatenate(alone).tolist()


def test_scores_do_not_depend_on_the_block():
    net = toxicity.Network({"b": 0}).start(np.random.default_rng(1))
    assert np.allclose(toxicity.highest(net, TEXTS), [toxicity.highest(net, [t])[0] for t in TEXTS], atol=1e-6)


def test_all_rows_are_scored(spark):
    net = toxicity.fit(TEXTS * 4, [0, 1] * 12)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").coalesce(1)
    found = {r.doc_id: r.toxic_score for r in toxicity.score(df, net).collect()}
    assert set(found) == set(range(len(TEXTS))) and all(0 <= s <= 1 for s in found.values())


def test_clashing_names(spark):
    net = toxicity.Network({"b": 0}).start(np.random.default_rng(1))
    df = spark.createDataFrame([(1, "a b", 2.0, "x", 3)], "doc_id bigint, Text string, Toxic_Score double, `a``b.c` string, TOXIC_predicted int")
    out = toxicity.score(df, net)
    assert out.columns == ["doc_id", "Text", "a`b.c", "toxic_score", "toxic_predicted"]
    assert [r[2] for r in out.collect()] == ["x"]
    assert toxicity.score(df.limit(0), net).count() == 0
