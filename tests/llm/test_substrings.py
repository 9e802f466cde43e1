import hashlib
import random
import re

import pytest
from millrace.llm import substrings
from millrace.llm.queries import op5_substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """Rows (id, text) in their order; per row the number of words and the kept words."""
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1] is not None, rows[i][1] or ""))
    for i in order:
        words = WORD.findall(rows[i][1] or "")
        gone = set()
        for s in range(len(words) - window + 1):
            w = tuple(words[s : s + window])
            if w in seen:
                gone.update(range(s, s + window))
            seen.add(w)
        out.append((rows[i][0], len(words), len(gone), " ".join(x for j, x in enumerate(words) if j not in gone)))
    return out


def _text(rng, n, alphabet=400):
    return [f"w{rng.randrange(alphabet)}" for _ in range(n)]


def _cases():
    rng = random.Random(5)
    passages = [_text(rng, n) for n in (19, 20, 21, 40, 90)]
    rows = []
    for i in range(60):
        words = _text(rng, rng.randrange(0, 120))
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            cut = rng.randrange(0, 5)
            at = rng.randrange(len(words) + 1)
            words[at:at] = p[cut:] if rng.random() < 0.5 else p
        rows.append((i, "\n".join([" ".join(words[:50]), "\t ".join(words[50:])])))
    rows += [(100 + i, rows[i][1]) for i in range(20)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "é " * 3000), (204, "é " * 25), (205, "a b " * 40), (206, "x" * 50000)]
    return rows


@pytest.mark.parametrize("window", [20, 12])
def test_against_brute_force(spark, window):
    rows = _cases()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, ord int, marks string").repartition(4)
    found = {r.doc_id: r for r in substrings.remove_repeats(df, window).collect()}
    assert len(found) == len(rows)
    for doc, n, gone, kept in brute(rows, window):
        r = found[doc]
        assert (r.n_words, r.n_removed, r.text) == (n, gone, kept)
        assert sum(s.length for s in r.spans) == gone and all(s.length >= window for s in r.spans)


def test_ties_and_nothing(spark):
    rows = [(1, "a b " * 20), (1, "a b " * 20), (None, "a b " * 20), (1, None), (0, "c " * 30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = substrings.repeat_digests(df).collect()
    expected = brute(rows, 20)
    assert sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in found) == sorted((d or -1, n, g) for d, n, g, _ in expected)
    assert substrings.repeat_digests(df.limit(0)).count() == 0


def test_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in op5_substring_dedup(spark, sf_dir).collect()}
    expected = {d: (n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in brute(docs, 20)}
    assert got == expected and any(g for _, g, _ in got.values())
