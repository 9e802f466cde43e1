import numpy as np
import oracle
import pytest
from millrace.llm import hamming
from millrace.llm.queries import ORACLES, op4_hamming_search

SCHEMA = "vec_id bigint, embedding array<float>, code string, q int"


def brute(rows, k, every):
    size = max((len(v) for _, v in rows if v), default=0)
    codes = [(i, np.array([x is not None and x > 0 for x in v])) for i, v in rows if i is not None and v and len(v) == size]
    out = []
    for i, a in codes:
        if i % every == 0:
            near = sorted((int((a != b).sum()), j) for j, b in codes)[:k]
            out += [(i, j, d, n + 1) for n, (d, j) in enumerate(near)]
    return sorted(out)


def _random(n, bits, spread, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, bits))
    return [(i, (centres[rng.integers(5)] + spread * rng.normal(size=bits)).tolist()) for i in range(n)]


CASES = {
    "clusters": _random(400, 64, 0.3, 1),
    "wide": _random(150, 100, 3.0, 2),
    "narrow": _random(300, 7, 1.0, 3),
    "hot": [(i, [1.0, -1.0, 0.5] * 8) for i in range(200)] + _random(100, 24, 1.0, 4),
    "few": _random(3, 16, 1.0, 5),
    "odd": [(None, [1.0]), (100, None), (200, [1.0, None]), (0, [1.0, float("nan")]), (0, [-1.0, 2.0]), (300, [])],
    "none": [],
}


@pytest.mark.parametrize("case", CASES)
def test_against_brute_force(spark, case):
    rows = CASES[case]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(3)
    found = hamming.nearest_vectors(df, k=6, every=50)
    assert found.columns == ["query_id", "id", "distance", "rank"]
    got = sorted(map(tuple, found.collect()))
    if case == "odd":  # a repeated id asks once for each of its rows
        assert sorted((q, d) for q, _, d, _ in got) == sorted((q, d) for q, _, d, _ in brute(rows, 6, 50))
        return
    assert got == brute(rows, 6, 50)


def test_whole_table(spark, sf_dir):
    assert oracle.differences(op4_hamming_search(spark, sf_dir), oracle.connect(sf_dir), ORACLES["op4_hamming_search"]) is None


def test_blocks_streams_and_groups(spark, monkeypatch):
    rows = _random(600, 40, 0.4, 6) + [(600 + i, v) for i, (_, v) in enumerate(_random(40, 40, 0.0, 7))]
    for name, value in {"PROBES": 64, "QUERIES": 5, "ENTRIES": 70, "LEAST": 100}.items():
        monkeypatch.setattr(hamming, name, value)
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(3)
    got = hamming.nearest_vectors(df, k=7, every=20)
    assert sorted(map(tuple, got.collect())) == brute(rows, 7, 20)


def test_in_a_task_against_brute_force():
    rng = np.random.default_rng(8)
    code = rng.integers(0, 1 << 63, (700, 2)).astype(np.uint64)
    code[200:400] = code[200] ^ (np.uint64(1) << rng.integers(0, 20, (200, 1)).astype(np.uint64))
    code[500:, 0] = 0
    asked, c = code[::10], rng.permutation(700)
    best = np.full((len(asked), 9), hamming.FAR), np.full((len(asked), 9), -1)
    for block in np.array_split(np.arange(700), 3):
        hamming._improve(asked, best, code[block], c[block], 128)
    distance = np.bitwise_count(asked[:, None] ^ code[None]).sum(axis=2)
    wanted = [sorted(zip(d.tolist(), c.tolist()))[:9] for d in distance]
    assert [list(zip(d, i)) for d, i in zip(best[0].tolist(), best[1].tolist())] == wanted


def test_stored_rows_follow_the_queries(spark, monkeypatch):
    stored, store = [], hamming.materialize
    monkeypatch.setattr(hamming, "materialize", lambda *a, **kw: stored.append(store(*a, **kw)) or stored[-1])
    n, every, k = 3000, 10, 5
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in _random(n, 64, 5.0, 9)], SCHEMA)
    assert hamming.nearest_vectors(df, k, every).count() == n // every * k
    assert max(frame.count() for frame in stored) <= max(n, n // every * k)
