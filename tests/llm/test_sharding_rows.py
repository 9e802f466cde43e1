"""Written shards of tables with null and repeated ids."""

from collections import Counter, defaultdict

import pytest
from millrace.llm import sharding

ROWS = {
    "null": [(None, f"{i:050d}", "a") for i in range(200)],
    "hot": [(7, f"{i:050d}", "a") for i in range(200)] + [(7, "same", "b")] * 3,
    "mixed": [(i, "x" * (i % 97), None) for i in range(300)] + [(None, "n" * 40, "n")] * 60 + [(5, "r" * 40, "r")] * 60 + [(6, None, "")],
    "large": [(1, "y" * 5000, "l"), (1, "y" * 5000, "l"), (None, None, None)],
    "nothing": [],
}


@pytest.mark.parametrize("name", ROWS)
@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_every_row_once(spark, tmp_path, name, kind):
    rows = [(i if i is None or kind == "bigint" else f"id {i}", t, c) for i, t, c in ROWS[name]]
    df = spark.createDataFrame(rows, f"doc_id {kind}, text string, `__row` string").repartition(3)
    sharding.write_shards(df, f"{tmp_path}/s", 2000)
    if not rows:
        return
    shards, found = defaultdict(list), Counter()
    for r in spark.read.parquet(f"{tmp_path}/s").collect():
        shards[r.shard].append(r.text or "")
        found[r.doc_id, r.text, r["__row"]] += 1
    assert found == Counter(rows)
    assert all(len(texts) == 1 or sum(map(len, texts)) <= 2000 for texts in shards.values())


def test_ids_that_occur_once_keep_their_hash(spark, tmp_path):
    rows = [(i, "x" * 60) for i in range(200)]
    df = spark.createDataFrame([*rows, (None, "")], "doc_id bigint, text string")
    sharding.write_shards(df, f"{tmp_path}/s", 2000)
    written = {r.doc_id: r.shard for r in spark.read.parquet(f"{tmp_path}/s").where("doc_id IS NOT NULL").collect()}
    assigned = sharding.assign_shards(df, 2000).where("doc_id IS NOT NULL").collect()
    assert written == {r.doc_id: f"s{r.shard}" for r in assigned}
