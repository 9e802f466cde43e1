"""Hot keys: a third of all rows share one key."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import keys, proximity, stats

ROWS = 300_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_partitions(spark):
    before = {name: spark.conf.get(name, None) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def hot(spark):
    """Key 7 holds a third of the rows."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
    return spark.range(0, ROWS, 1, 8).select(F.concat(F.lit("k"), key).alias("k"), F.col("id").alias("v"))


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_key_lookup_splits_the_hot_parent(small_partitions):
    spark = small_partitions
    parents = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") + 1).alias("id"))
    rows, plan = final_plan(keys.resolve_keys(hot(spark), parents, "k", "id", "pid"))
    assert len(rows) == ROWS
    assert "skew=true" in plan


def test_crowded_cell_is_split(small_partitions):
    spark = small_partitions
    centres = spark.createDataFrame([(1, 10.0, 10.0), (2, -40.0, 100.0)], "centre_id int, centre_lat double, centre_lng double")
    place = F.col("id") % 3 == 0
    plants = spark.range(0, ROWS, 1, 8).select(
        "id",
        F.when(place, 10.0).otherwise(F.col("id") % 160 - 80).cast("double").alias("latitude"),
        F.when(place, 10.01).otherwise(F.col("id") % 331 - 165).cast("double").alias("longitude"),
    )
    rows, plan = final_plan(proximity.nearby_join(centres, plants, 50).select("centre_id", "id"))
    assert len(rows) >= ROWS // 3
    assert "skew=true" in plan


@pytest.mark.parametrize("work", ["orphans", "unique", "merge"])
def test_counts_shrink_before_the_shuffle(small_partitions, work):
    spark = small_partitions
    none = spark.range(0).select(F.col("id").cast("string").alias("k"))
    df = {
        "orphans": lambda: keys.orphans(hot(spark), none, "k", "k"),
        "unique": lambda: keys.unique_violations(hot(spark), ["k"]),
        "merge": lambda: keys.merge_copies(hot(spark), ["k"]),
    }[work]()
    rows = df.collect()
    hottest = max(r[-1] for r in rows)
    assert hottest >= ROWS // 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_statistics_with_one_huge_country(spark):
    plants = spark.range(0, ROWS, 1, 8).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 'HOT' ELSE concat('C', id % 50) END AS country_code",
        "'x' AS country",
        "concat('F', id % 15) AS primary_fuel",
        "CAST(1 AS decimal(12,2)) AS capacity_mw",
        "1990 AS commissioning_year",
    )
    top = stats.by_country(plants, 1).collect()[0]
    assert (top.country_code, top.plant_count, top.total_capacity_mw) == ("HOT", ROWS // 3, ROWS / 3)
