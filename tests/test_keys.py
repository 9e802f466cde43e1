import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import keys
from millrace.operators.paging import order


def test_surrogate_key_is_dense_and_ordered(spark):
    names = [f"k{i:05d}" for i in range(5000)]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(n,) for n in names], "k string").repartition(7)
    got = keys.surrogate_key(df, ["k"], start_after=10).orderBy("id").collect()
    assert [r.id for r in got] == list(range(11, 5011))
    assert [r.k for r in got] == sorted(names)


def test_surrogate_key_splits_a_hot_leading_key(spark):
    """A third of the rows share the first sort column; the second one still spreads them."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    got = keys.surrogate_key(df, ["k", "id"], name="n")
    assert got.agg(F.min("n"), F.max("n"), F.countDistinct("n")).collect()[0] == (1, 30_000, 30_000)
    largest = df.repartitionByRange(8, "k", "id").groupBy(F.spark_partition_id()).count().agg(F.max("count"))
    assert largest.collect()[0][0] < 10_000


def test_surrogate_key_of_nothing(spark):
    assert keys.surrogate_key(spark.range(0), ["id"], name="n").count() == 0


def test_surrogate_key_with_null_order(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 7)], "id int, y int")
    got = keys.surrogate_key(df, [order("y", descending=True)], name="p").collect()
    assert sorted((r.p, r.id) for r in got) == [(1, 1), (2, 3), (3, 2)]


def test_unique_id(spark):
    got = [r.n for r in keys.unique_id(spark.range(100).repartition(5), "n", start_after=7).collect()]
    assert len(set(got)) == 100 and min(got) == 8


def test_keep_first_and_merge_copies_with_a_hot_key(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), "id")).alias("k"),
        F.col("id").alias("v"),
    )
    first = {r.k: r.v for r in keys.keep_first(df, ["k"], ["v"]).collect()}
    assert first["hot"] == 0 and len(first) == 6001
    merged = {r.k: (r.v, r.copies) for r in keys.merge_copies(df, ["k"]).collect()}
    assert merged["hot"] == (0, 3000) and merged["k1"] == (1, 1) and len(merged) == 6001
    assert "WindowGroupLimit" in keys.keep_first(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def family(spark):
    parents = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, k string")
    children = spark.createDataFrame(
        [("a", 2013), ("a", 2014), ("x", 2013), ("x", 2015), (None, 2013)], "k string, year int"
    )
    return parents, children


def test_resolve_drops_children_without_parent(family):
    parents, children = family
    got = keys.resolve_keys(children, parents, "k", "id", "parent_id")
    assert got.columns == ["parent_id", "year"]
    assert sorted(got.collect()) == [(1, 2013), (1, 2014)]


def test_orphans(family):
    parents, children = family
    assert keys.orphans(children, parents, "k", "k").collect() == [("x", 2)]


def test_unique_violations_ignore_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert keys.unique_violations(df, ["k"]).collect() == [("a", 2)]


def test_cascade_delete(spark):
    children = spark.createDataFrame([(1, 10), (2, 11), (2, 12)], "parent int, id int")
    deleted = spark.createDataFrame([(2,)], "id int")
    assert keys.cascade_delete(children, deleted, "parent", "id").collect() == [(1, 10)]


def test_lookup(spark):
    df = spark.range(5)
    assert keys.lookup(df, "id", 3).collect() == [(3,)]
    assert keys.lookup(df, "id", 99).collect() == []
    for bad in ("3", 2.5, True):
        with pytest.raises(ValueError):
            keys.lookup(df, "id", bad)
    wanted = spark.createDataFrame([(1,), (1,), (9,)], "x bigint")
    assert keys.lookup_many(df, "id", wanted).collect() == [(1,)]


def test_nest_sorts_and_gives_empty_arrays(spark):
    plants = spark.createDataFrame([(1,), (2,)], "id bigint")
    figures = spark.createDataFrame([(1, 2014, 2.0), (1, 2013, 1.0)], "pid bigint, year int, v double")
    got = {
        r.id: [tuple(g) for g in r.generation]
        for r in keys.nest(plants, figures, "id", "pid", ["v"], "year", "generation").collect()
    }
    assert got == {1: [(2013, 1.0), (2014, 2.0)], 2: []}


def test_nest_refuses_repeats(spark):
    plants = spark.createDataFrame([(1,), (2,)], "id bigint")
    rows = [(1, 2013, 1.0)] * 1000 + [(2, 2013, 1.0), (None, 2013, 1.0), (None, 2013, 2.0)]
    figures = spark.createDataFrame(rows, "pid bigint, year int, v double")
    with pytest.raises(Exception, match='1000 rows of {"year":2013,"pid":1}'):
        keys.nest(plants, figures, "id", "pid", ["v"], "year", "generation").collect()
    good = figures.where("pid = 2 OR pid IS NULL")
    got = {r.id: len(r.generation) for r in keys.nest(plants, good, "id", "pid", ["v"], "year", "generation").collect()}
    assert got == {1: 0, 2: 1}
