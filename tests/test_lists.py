import pytest
from pyspark.sql import functions as F

from millrace.functions.predicates import Condition, has_all_tokens, where_all
from millrace.operators import paging
from millrace.operators.paging import PlantFilter, order


@pytest.fixture(scope="module")
def things(spark):
    rows = [(1, "a_b", 5), (2, "axb", None), (3, "100%", 7), (4, "B\\c", 7), (5, None, 1)]
    return spark.createDataFrame(rows, "id int, name string, n int").cache()


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize(
    "condition,expected",
    [
        (Condition("n", "=", 7), [3, 4]),
        (Condition("n", "=", None), []),
        (Condition("n", "!=", 7), [1, 5]),
        (Condition("n", "!=", None), []),
        (Condition("n", ">", 5), [3, 4]),
        (Condition("n", ">=", 5), [1, 3, 4]),
        (Condition("n", "<", 5), [5]),
        (Condition("n", "<=", 5), [1, 5]),
        (Condition("name", "LIKE", "a_b"), [1, 2]),
        (Condition("name", "LIKE", "a\\_b"), [1]),
        (Condition("name", "ILIKE", "A%"), [1, 2]),
        (Condition("n", "IN", [1, 7]), [3, 4, 5]),
    ],
)
def test_operators(things, condition, expected):
    assert ids(things.where(where_all([condition]))) == expected


def test_conditions_are_anded_and_may_be_absent(things):
    assert ids(things.where(where_all([]))) == [1, 2, 3, 4, 5]
    assert ids(things.where(where_all([Condition("n", "=", 7), Condition("id", ">", 3)]))) == [4]


def test_bad_conditions():
    for bad in (Condition("n", "IN", []), Condition("n", "~", 1)):
        with pytest.raises(ValueError):
            where_all([bad])


@pytest.mark.parametrize("text,expected", [("_", [1, 2, 3, 4]), ("%", [1, 2, 3, 4]), ("\\_", [1]), ("XB", [2])])
def test_search_keeps_wildcards_live(spark, things, text, expected):
    columns = things.select("id", "name", F.lit("USA").alias("country_code"))
    assert ids(columns.where(PlantFilter(search=text).predicate())) == expected


def test_filter_validation(spark):
    for bad in (
        PlantFilter(country="US"),
        PlantFilter(country=""),
        PlantFilter(fuel="coal"),
        PlantFilter(min_capacity=0),
        PlantFilter(max_capacity=-1),
        PlantFilter(max_capacity=float("nan")),
    ):
        with pytest.raises(ValueError):
            bad.predicate()
    assert spark.range(3).where(PlantFilter(fuel="", search="").predicate()).count() == 3


def test_null_order(things):
    down = things.orderBy(order("n", descending=True), "id").collect()
    up = things.orderBy(order("n"), "id").collect()
    assert [r.n for r in down] == [None, 7, 7, 5, 1]
    assert [r.n for r in up] == [1, 5, 7, 7, None]


def test_limit_and_offset_are_optional(spark):
    df = spark.range(10)
    assert [r.id for r in paging.limit_offset(df, 3, 2).collect()] == [2, 3, 4]
    assert paging.limit_offset(df, offset=8).count() == 2
    assert paging.limit_offset(df).count() == 10
    assert paging.limit_offset(df, 0).count() == 0
    for bad in ({"limit": -1}, {"offset": -1}):
        with pytest.raises(ValueError):
            paging.limit_offset(df, **bad)


@pytest.mark.parametrize("page,limit", [(0, 20), (1, 0), (1, 101), (-1, 5)])
def test_page_bounds_are_rejected(page, limit):
    with pytest.raises(ValueError):
        paging.check_page(page, limit)


def test_top_k_bounds_are_clamped():
    assert paging.clamp_limit(None, 10, 100) == 10
    assert paging.clamp_limit(0, 10, 100) == 10
    assert paging.clamp_limit(101, 10, 100) == 100
    with pytest.raises(ValueError):
        paging.clamp_limit(-1, 10, 100)


def test_page_meta(spark):
    meta = paging.page_meta(spark.range(45), page=3, limit=20).collect()[0].asDict()
    assert meta == dict(page=3, page_size=20, total=45, total_pages=3, first_shown=41, last_shown=45)
    assert paging.page_meta(spark.range(0)).collect()[0].total_pages == 0


@pytest.fixture(scope="module")
def numbers(spark):
    """Nulls, NaN, and a value that a third of all rows share."""
    n = F.when(F.col("id") % 3 == 0, 5.0).when(F.col("id") % 97 == 1, None).when(F.col("id") % 89 == 2, float("nan"))
    return spark.range(6_000).select("id", n.otherwise(F.col("id") % 211).alias("n")).repartition(6).cache()


@pytest.mark.parametrize("descending", [False, True])
def test_slices_at_any_depth(numbers, monkeypatch, descending):
    monkeypatch.setattr(paging, "REACH", 50)
    monkeypatch.setattr(paging, "CUTS", 5)
    ordering = [("n", descending), ("id", False)]
    every = [r.id for r in numbers.orderBy(*[order(*key) for key in ordering]).collect()]
    for limit, offset in ((30, 0), (30, 2_990), (700, 1_400), (10, 5_995), (10, 9_000), (None, 5_900), (0, 70)):
        got = [r.id for r in paging.sorted_slice(numbers, ordering, limit, offset).collect()]
        assert got == every[offset : None if limit is None else offset + limit]


def test_deep_pages_read_one_range_and_write_nothing(spark, tmp_path, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("a page writes nothing")

    monkeypatch.setattr("millrace.operators.keys.materialize", refuse)
    spark.range(60_000).selectExpr("id", "id % 1000 AS n").write.parquet(f"{tmp_path}/t")
    page = paging.sorted_slice(spark.read.parquet(f"{tmp_path}/t"), [("n", True), ("id", False)], 20, 30_000)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "n" in plan[plan.index("PushedFilters") :].split("]")[0]
    assert "SinglePartition" not in plan
    assert all(int(x.split(",")[0]) <= paging.REACH for x in plan.split("TakeOrderedAndProject(limit=")[1:])
    assert [r.id for r in page.collect()] == sorted((i for i in range(60_000) if i % 1000 == 499))[:20]


def test_select_query(spark):
    df = spark.range(50).select("id", (F.col("id") % 5).alias("n"))
    got = paging.select_query(
        df, ["id"], [Condition("n", ">=", 3)], order_by="n", descending=True, limit=2, offset=1, tie_breaker=["id"]
    )
    assert got.collect() == [(9,), (14,)]
    assert paging.select_query(df, ["n"]).count() == 50


def test_token_search(spark):
    df = spark.createDataFrame([(1, "Big-River Dam"), (2, "river"), (3, "Riverside dam"), (4, None)], "id int, t string")
    assert ids(df.where(has_all_tokens("t", "dam RIVER"))) == [1]
    assert ids(df.where(has_all_tokens("t", "river"))) == [1, 2]
    with pytest.raises(ValueError):
        has_all_tokens("t", " - ")


def test_list_plants_gives_rows_and_metadata(spark):
    names = [f"CAST(NULL AS string) AS {c}" for c in paging.LIST_COLUMNS if c not in ("id", "capacity_mw")]
    plants = spark.range(45).selectExpr("id", "CAST(id AS decimal(12,2)) AS capacity_mw", *names)
    rows, meta = paging.list_plants(plants, PlantFilter(min_capacity=5), page=2, limit=15)
    assert [r.id for r in rows.collect()] == list(range(29, 14, -1))
    assert meta.collect()[0].total == 40


def test_top_plants(spark):
    schema = "id int, name string, country string, country_code string, capacity_mw double, primary_fuel string, commissioning_year int"
    rows = [(i, "n", "c", "C", float(i // 2), "Gas" if i % 3 else "Coal", None) for i in range(30)]
    plants = spark.createDataFrame(rows, schema)
    got = paging.top_plants(plants, 3).collect()
    assert [(r.rank, r.id) for r in got] == [(1, 28), (2, 29), (3, 26)]
    assert {r.primary_fuel for r in paging.top_plants(plants, 5, fuel="Coal").collect()} == {"Coal"}
    with pytest.raises(ValueError):
        paging.top_plants(plants, fuel="coal")


def test_ties_stay_in_many_tasks(spark):
    # Else the few bytes of this test are merged into one partition after the shuffle.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(0, 300_000, 1, 8).selectExpr("CAST(id % 2 AS int) AS a", "1 AS b")
    for ordering in ((), [("a", True)]):
        taken = paging.limit_offset(rows, offset=5, ordering=ordering)
        sizes = [r["count"] for r in taken.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 299_995 and max(sizes) < 150_000
    some = paging.limit_offset(rows, 200_001, 10, [("a", False)])
    assert {r.a: r["count"] for r in some.groupBy("a").count().collect()} == {0: 149_990, 1: 50_011}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("descending", [False, True])
def test_pages_by_key_reach_every_row_once(spark, descending):
    n = F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 3)
    m = F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 2)
    rows = spark.range(60).select("id", n.alias("n"), m.alias("m")).cache()
    ordering = [("n", descending), ("m", not descending), ("id", False)]
    every = [tuple(r) for r in rows.orderBy(*[order(*key) for key in ordering]).collect()]
    got, after = [], None
    while page := paging.list_after(rows, ordering, after, 13).collect():
        got += [tuple(r) for r in page]
        after = (page[-1].n, page[-1].m, page[-1].id)
    assert got == every


def test_a_page_by_key_filters_the_scan(spark, tmp_path):
    spark.range(1000).write.parquet(f"{tmp_path}/t")
    rows = spark.read.parquet(f"{tmp_path}/t")
    plan = paging.list_after(rows, [("id", True)], [500])._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(id,500)" in plan and "TakeOrderedAndProject(limit=20" in plan
    for bad in ({"after": [1, 2]}, {"limit": 0}):
        with pytest.raises(ValueError):
            paging.list_after(rows, [("id", True)], **bad)
