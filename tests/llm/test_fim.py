"""Fill-in-the-middle against a plain version, DuckDB, and the container forms."""

import hashlib

import numpy as np
import oracle
import pytest
from millrace.llm import fim, queries

RNG = np.random.default_rng(5)
TEXTS = {
    "ascii": "plain words " * 9000,
    "dense": "aé" * 50_000,
    "sparse": "😀" * 40_000,
    "mixed": "".join(RNG.choice(list("ab é€😀"), 150_000)),
    "edges": "x" * 65_535 + "é" + "y" * 65_534 + "😀z",
    "one": "é",
}


@pytest.mark.parametrize("name", TEXTS)
def test_select(name):
    data = TEXTS[name].encode()
    bounds = fim.Boundaries(np.frombuffer(data, np.uint8))
    expected = [i for i, b in enumerate(data) if b & 0xC0 != 0x80] + [len(data)]
    assert len(bounds) == len(TEXTS[name])
    ranks = range(len(expected)) if len(expected) < 1000 else [*range(0, len(expected), 97), 65_535 % len(expected), 65_536 % len(expected), len(expected) - 1]
    assert [bounds.select(k) for k in ranks] == [expected[k] for k in ranks]


def test_container_forms():
    kinds = {name: {type(c).__name__ for c in fim.Boundaries(np.frombuffer(t.encode(), np.uint8)).containers} for name, t in TEXTS.items()}
    assert kinds["ascii"] == {"_Runs"} and "_Bitmap" in kinds["mixed"]
    assert fim._container(np.arange(fim.SPAN) % 100 == 0)[0].__class__.__name__ == "_Array"


def plain(doc, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc, n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


ROWS = [
    (None, "no id"),
    (1, None),
    (2, ""),
    (3, "holds <M> a mark"),
    (3, "holds <M> a mark"),
    *[(10 + i, "<é>S<S" + "P>M<" * (i % 5) + "😀" * i) for i in range(60)],
    (99, "long " * 400_000 + "é"),
]


def test_against_plain(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in ROWS], "doc_id bigint, text string, output string").repartition(3)
    made = fim.fill_in_middle(df)
    found = made.withColumn("back", fim.restored(made.output, made.form)).collect()
    assert sorted([tuple(r)[:6] for r in found], key=repr) == sorted((plain(*r) for r in ROWS), key=repr)
    assert sorted(r.back for r in found) == sorted(t or "" for _, t in ROWS)


def test_empty_table(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_query(spark, sf_dir):
    df = queries.QUERIES["op13_fill_in_middle"](spark, sf_dir)
    assert oracle.differences(df, oracle.connect(sf_dir), queries.ORACLES["op13_fill_in_middle"]) is None
    assert df.where("restored_sha256 = output_sha256 AND form <> 'plain'").count() == 0
