import pytest
from pyspark.errors import SparkRuntimeException

from millrace import contract
from millrace.contract import GENERATION, PLANTS
from millrace.operators import checks


def plant_rows(spark, *rows):
    base = dict(
        gppd_idnr="P",
        name="n",
        country_code="USA",
        country="United States",
        capacity_mw="5",
        latitude="1",
        longitude="1",
        primary_fuel="Coal",
    )
    names = list(base)
    df = spark.createDataFrame([tuple((base | r)[n] for n in names) for r in rows], ", ".join(f"{n} string" for n in names))
    return df.selectExpr(
        *[
            f"CAST({f.name} AS {f.type}) AS {f.name}" if f.name in names else f"CAST(NULL AS {f.type}) AS {f.name}"
            for f in PLANTS.fields
            if f.name in PLANTS.loaded_columns
        ]
    )


BAD = {
    "capacity_positive": {"capacity_mw": "0"},
    "latitude_range": {"latitude": "90.1"},
    "longitude_range": {"longitude": "-180.5"},
    "country_code_exactly_3": {"country_code": "US"},
    "gppd_idnr_max_20": {"gppd_idnr": "x" * 21},
    "name_required": {"name": None},
    "primary_fuel_domain": {"primary_fuel": "coal"},
}


@pytest.mark.parametrize("rule", BAD)
def test_each_rule(spark, rule):
    good, broken = checks.split_valid(plant_rows(spark, {}, BAD[rule]), PLANTS)
    assert good.count() == 1
    assert broken.collect()[0].violations == [rule]


def test_edges_of_the_ranges_pass(spark):
    rows = plant_rows(spark, {"latitude": "90", "longitude": "-180"}, {"latitude": "-90", "longitude": "180"})
    assert checks.split_valid(rows, PLANTS)[0].count() == 2


def test_null_passes_a_check_but_not_required(spark):
    rows = spark.createDataFrame([(1, None), (None, 1999), (1, 2031), (1, 2030)], "power_plant_id bigint, year int")
    got = [r.violations for r in checks.with_violations(rows, GENERATION).collect()]
    assert got == [["year_required"], ["power_plant_id_required", "year_range"], ["year_range"], []]


def test_enforce_keeps_good_rows_and_fails_on_bad(spark):
    assert checks.enforce(plant_rows(spark, {}, {}), PLANTS).count() == 2
    with pytest.raises(SparkRuntimeException, match="capacity_positive"):
        checks.enforce(plant_rows(spark, {"capacity_mw": "-1"}), PLANTS).collect()


def test_counts_cover_every_rule(spark):
    rows = plant_rows(spark, {}, BAD["capacity_positive"], BAD["name_required"])
    counts = {r.rule: r.n_rows for r in checks.violation_counts(rows, PLANTS).collect()}
    assert counts["capacity_positive"] == counts["name_required"] == 1
    assert sum(counts.values()) == 2


def test_tables_up_and_down(spark):
    database = "contract_test"
    contract.reset_tables(spark, database)
    names = {t.name for t in spark.catalog.listTables(database)}
    assert names == {"power_plants", "power_plant_generation"}
    columns = [c.name for c in spark.catalog.listColumns(f"{database}.power_plants")]
    assert sorted(columns) == sorted(PLANTS.schema.names)
    contract.drop_tables(spark, database)
    contract.drop_tables(spark, database)
    assert spark.catalog.listTables(database) == []
    spark.sql(f"DROP DATABASE {database}")


def test_declared_lengths_are_enforced_on_insert(spark):
    database = "contract_lengths"
    contract.reset_tables(spark, database)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        spark.sql(
            f"INSERT INTO {database}.power_plant_generation (id, estimation_method) VALUES (1, repeat('x', 51))"
        )
    contract.drop_tables(spark, database)
    spark.sql(f"DROP DATABASE {database}")
