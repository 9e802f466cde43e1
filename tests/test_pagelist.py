"""Pages of a stored list against sorting all rows."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.sources.versions import Store, Table

ORDERING = [("v", True), ("k", False)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    return [(i, None if i % 11 == 0 else rng.randrange(40), None if i % 50 == 0 else f"k{i}") for i in range(2000)]


def sort_key(row):
    _, v, k = row
    return (v is not None, -(v or 0), k is None, k or "")


@pytest.fixture(scope="module")
def stored(spark, rows, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("store")))
    df = spark.createDataFrame(rows, "id bigint, v int, k string").repartition(6)
    table, _ = store.added("t", Table(), df, df.schema, ["id"])
    # As many ranges as there are shuffle partitions, however small.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        listed = store.listed("t", table, df.schema, "by_v", ORDERING)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return store, df, store.commit(store.version(), {"t": listed})


@pytest.mark.parametrize("offset,limit", [(0, 20), (37, 20), (990, 400), (1990, 50), (2000, 5), (5000, 5), (0, 0), (0, 3000)])
def test_pages(stored, rows, offset, limit):
    store, _, version = stored
    got = [(r.v, r.k) for r in store.page(version.table("t"), "by_v", limit, offset).collect()]
    assert got == [(v, k) for _, v, k in sorted(rows, key=sort_key)[offset : offset + limit]]
    assert store.list_total(store.version().table("t"), "by_v") == 2000


def test_a_page_opens_its_ranges_alone(stored, spark):
    store, _, version = stored
    folder = store.path(version.table("t").lists["by_v"][0])
    counts = spark.read.parquet(f"{folder}/counts").orderBy("part").collect()
    assert len(counts) > 3 and max(c.n for c in counts) < 1000
    page = store.page(version.table("t"), "by_v", 5, counts[2].before + 1)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert f"({counts[2].part} = _part" in plan or f"_part#" in plan.split("PartitionFilters: [")[1][:200]
    assert "GreaterThanOrEqual(_place,1)" in plan and page.count() == 5


def test_ties_lie_in_several_ranges(spark, tmp_path):
    store = Store(spark, str(tmp_path / "ties"))
    df = spark.range(0, 3000, 1, 4).select(F.lit(1).alias("v"), F.lit("x").alias("k"), F.col("id"))
    table, _ = store.added("t", Table(), df, df.schema, ["id"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = store.listed("t", table, df.schema, "tied", [("v", False)])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    counts = spark.read.parquet(f"{store.path(table.lists['tied'][0])}/counts").collect()
    assert sum(c.n for c in counts) == 3000 and max(c.n for c in counts) < 2000
    seen = [r.id for at in range(0, 3000, 1000) for r in store.page(table, "tied", 1000, at).collect()]
    assert sorted(seen) == list(range(3000))


def test_a_change_leaves_lists_out(stored):
    store, df, version = stored
    table, _ = store.added("t", version.table("t"), df.limit(1).withColumn("id", F.lit(9999).cast("bigint")), df.schema, ["id"])
    assert table.lists == {} and version.table("t").lists
    with pytest.raises(KeyError):
        store.page(table, "by_v", 5)


def test_vacuum_keeps_named_lists(stored):
    store, df, version = stored
    spare = store.listed("t", version.table("t"), df.schema, "other", [("id", False)])
    gone = store.vacuum()
    assert spare.lists["other"][0] in gone and version.table("t").lists["by_v"][0] not in gone
    assert store.page(version.table("t"), "by_v", 3).count() == 3


def test_empty_list(spark, tmp_path):
    store = Store(spark, str(tmp_path / "none"))
    df = spark.createDataFrame([], "id bigint, v int")
    table = store.listed("t", Table(), df.schema, "all", [("v", True)])
    assert store.page(table, "all", 10).count() == 0 and store.list_total(table, "all") == 0
