import hashlib
from collections import defaultdict

import oracle
import pytest
from millrace.llm import sharding
from millrace.llm.queries import ORACLES, op7_sharding

CASES = [
    [(i, "x" * (i % 97)) for i in range(700)],
    [(1, "y" * 5000), (2, None), (None, "z"), (3, "é" * 40), (3, "é" * 40), (3, "é" * 40), (None, "")],
    [],
]


def brute(rows, limit):
    """Split bucket by bucket."""
    bits = lambda k: f"{int(hashlib.md5(str(k).encode()).hexdigest()[:15], 16):060b}"
    out, todo = {}, {"": [(i, bits(k), len((t or "").encode())) for i, (k, t) in enumerate(rows)]}
    while todo:
        prefix, members = todo.popitem()
        if sum(m[2] for m in members) <= limit or len(members) == 1 or len(prefix) == sharding.BITS:
            for i, _, _ in members:
                out[i] = (rows[i][0], prefix, len(prefix), sum(m[2] for m in members), len(members))
            continue
        halves = defaultdict(list)
        for m in members:
            halves[m[1][: len(prefix) + 1]].append(m)
        todo |= halves
    return sorted(out.values(), key=repr)


@pytest.mark.parametrize("rows", [CASES[0], CASES[2], [(1, "y" * 5000), (2, None), (3, "é" * 40)]])
@pytest.mark.parametrize("limit", [100, 3000])
def test_against_brute_force(spark, monkeypatch, rows, limit):
    monkeypatch.setattr(sharding, "STEP", 5 if limit == 3000 else 12)
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], "doc_id bigint, text string, shard string, depth int")
    found = sharding.assign_shards(df, limit).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows, limit)


@pytest.mark.parametrize("limit", [100, 500])
@pytest.mark.parametrize("rows", [[(7, "x" * 100)] * 50, CASES[1] * 9, [(None, "n" * 30)] * 40 + [(i, "u" * 30) for i in range(40)]])
def test_repeated_and_null_ids_keep_the_limit(spark, rows, limit):
    """Their hash is not known beforehand, but every bucket fits and none was split in vain."""
    found = sharding.assign_shards(spark.createDataFrame(rows, "doc_id bigint, text string"), limit).collect()
    assert sorted(repr(r.doc_id) for r in found) == sorted(repr(i) for i, _ in rows)
    shards = {r.shard: r for r in found}
    counts = defaultdict(int)
    for r in found:
        counts[r.shard] += 1
        assert (r.depth, r.shard_bytes, r.shard_rows) == (len(r.shard), shards[r.shard].shard_bytes, shards[r.shard].shard_rows)
    assert all(counts[s] == r.shard_rows and (r.shard_bytes <= limit or r.shard_rows == 1) for s, r in shards.items())
    assert sum(r.shard_bytes for r in shards.values()) == sum(len((t or "").encode()) for _, t in rows)
    for s in shards:
        assert not any(t != s and t.startswith(s) for t in shards)
        assert not s or sum(r.shard_bytes for t, r in shards.items() if t.startswith(s[:-1])) > limit


def test_written_shards(spark, tmp_path):
    df = spark.createDataFrame(CASES[0], "doc_id bigint, text string")
    sharding.write_shards(df, f"{tmp_path}/s", 2000)
    back = spark.read.parquet(f"{tmp_path}/s")
    assert back.count() == 700
    assert max(sum(len(r.text) for r in rows) for rows in _by_shard(back).values()) <= 2000


def _by_shard(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r.shard].append(r)
    return out


def test_whole_table(spark, sf_dir):
    duck = oracle.connect(sf_dir)
    assert oracle.differences(op7_sharding(spark, sf_dir), duck, ORACLES["op7_sharding"]) is None
    small = sharding.assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), 20_000)
    assert oracle.differences(small, duck, sharding.shard_sql(20_000)) is None
