import time

import pytest
from pyspark.sql import functions as F

from millrace.functions.clean import null_tokens
from millrace.plans.pipeline import Pipeline
from millrace.sources import tables, workspace


def test_append_selects_columns_and_skips_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, k string, extra string")
    schema = df.select("id", "k").schema
    tables.ensure_table(spark, path, schema)
    assert tables.read_table(spark, path, schema).count() == 0
    tables.append(df, path, ["k", "id"], partition_by=["k"])
    tables.append(df.limit(0), path, ["k", "id"], partition_by=["k"])
    tables.ensure_table(spark, path, schema)
    assert tables.read_table(spark, path, schema).columns == ["id", "k"]
    assert sorted(tables.read_table(spark, path, schema).collect()) == [(1, "a"), (2, "b")]
    again = tables.not_yet_loaded(df, tables.read_table(spark, path, schema), ["id"])
    assert again.count() == 0


def test_upsert(spark):
    old = F.lit("2020-01-01").cast("timestamp")
    existing = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, t string, n int").select(
        "*", old.alias("created_at"), old.alias("updated_at")
    )
    changes = spark.createDataFrame([(2, None), (3, "c")], "id int, t string")
    got = {r.id: r for r in tables.upsert(existing, changes, "id").collect()}
    assert (got[1].t, got[2].t, got[2].n, got[3].t, got[3].n) == ("a", None, 6, "c", None)
    assert got[1].updated_at == got[1].created_at == got[2].created_at
    assert got[2].updated_at > got[2].created_at
    assert got[3].created_at is not None and got[3].updated_at == got[3].created_at


def test_stamps(spark):
    row = tables.stamp_new(spark.range(1)).collect()[0]
    assert row.created_at == row.updated_at and abs(row.created_at.timestamp() - time.time()) < 600


def test_materialize_cuts_lineage_and_fixes_values(spark):
    random = spark.range(100).select(F.rand().alias("r"))
    fixed = workspace.materialize(random, "test")
    assert fixed.collect() == fixed.collect()
    assert "Rand" not in fixed._jdf.queryExecution().optimizedPlan().toString()


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert workspace.shared_dir(spark).rstrip("/") == configured.rstrip("/")
    assert workspace.new_path(spark, "x") != workspace.new_path(spark, "x")


@pytest.fixture
def pipeline(spark, tmp_path):
    source = spark.createDataFrame([("1", "a"), ("2", "NA"), ("3", "c")], "id string, t string")

    def saver(name):
        return lambda df: df.write.parquet(str(tmp_path / name))

    return Pipeline(
        spark,
        extract=lambda s: null_tokens(source),
        transforms={"all": lambda raw: raw, "named": lambda raw: raw.where("t IS NOT NULL")},
        loaders={"all": saver("all"), "named": saver("named")},
        validate=lambda: {"named": spark.read.parquet(str(tmp_path / "named"))},
    )


def test_every_transform_gets_the_raw_rows(spark, pipeline, tmp_path):
    assert pipeline.run() == {"extracted": 3, "transformed": 5, "loaded": 5, "errors": 0, "all": 3, "named": 2}
    assert spark.read.parquet(str(tmp_path / "all")).count() == 3
    assert pipeline.validated()["named"].count() == 2


def test_dry_run_counts_but_writes_nothing(pipeline, tmp_path):
    assert pipeline.run(dry_run=True) == {"extracted": 3, "transformed": 5, "loaded": 0, "errors": 0, "all": 3, "named": 2}
    assert not (tmp_path / "all").exists()
    assert pipeline.validated(dry_run=True) == {}


def test_missing_or_extra_loader_is_an_error(pipeline):
    del pipeline.loaders["named"]
    with pytest.raises(ValueError):
        pipeline.run()


def test_defaults_of_a_pipeline_without_validation(spark):
    assert Pipeline(spark, extract=lambda s: s.range(1), transforms={}, loaders={}).validated() == {}
