from decimal import Decimal

from millrace.contract import SOURCE_COLUMNS, text_schema
from millrace.functions.clean import null_tokens
from millrace.operators import reshape

GOOD = {
    "country": "USA",
    "country_long": "United States",
    "name": "A",
    "gppd_idnr": "P1",
    "capacity_mw": "10",
    "latitude": "1.5",
    "longitude": "2.5",
    "primary_fuel": "Coal",
}


def raw(spark, *rows, columns=SOURCE_COLUMNS):
    data = [tuple((GOOD | row).get(c) for c in columns) for row in rows]
    return null_tokens(spark.createDataFrame(data, text_schema(list(columns))))


def test_mapping_defaults_and_types(spark):
    row = reshape.plants_transform(
        raw(spark, {"name": "NA", "other_fuel1": "Peat", "other_fuel2": "Gas", "commissioning_year": "1998.9"})
    ).collect()[0]
    assert (row.name, row.country_code, row.country) == ("Unknown", "USA", "United States")
    assert (row.other_fuel1, row.other_fuel2, row.commissioning_year) == (None, "Gas", 1998)
    assert row.capacity_mw == Decimal("10.00") and row.latitude == Decimal("1.500000")


def test_absent_columns_read_as_null(spark):
    slim = raw(spark, {}, columns=tuple(GOOD))
    row = reshape.plants_transform(slim).collect()[0]
    assert row.owner is None and row.commissioning_year is None
    assert reshape.generation_unpivot(slim).count() == 0


def test_reject_reasons_and_valid_rows(spark):
    typed = reshape.plants_transform(
        raw(
            spark,
            {"gppd_idnr": "ok"},
            {"gppd_idnr": "c", "capacity_mw": "1d"},
            {"gppd_idnr": "f", "primary_fuel": "coal"},
            {"gppd_idnr": "n", "latitude": ""},
            {"gppd_idnr": "z", "capacity_mw": "0"},
        )
    )
    assert {r.gppd_idnr for r in reshape.valid_plants(typed).collect()} == {"ok", "z"}
    counts = {r.reject_reason: r.n_rows for r in reshape.reject_counts(typed).collect()}
    assert counts == {"capacity_mw missing": 1, "primary_fuel missing": 1, "latitude missing": 1}


def test_unpivot(spark):
    rows = reshape.generation_unpivot(
        raw(
            spark,
            {
                "generation_gwh_2013": "1.5",
                "estimated_generation_gwh_2014": "2",
                "estimated_generation_note_2014": "HYDRO-V1",
                "generation_gwh_2015": "abc",
                "generation_gwh_2019": "4",
                "estimated_generation_note_2016": "NO-ESTIMATION",
                "generation_data_source": "S",
            },
        )
    ).collect()
    assert [(r.year, r.generation_gwh, r.estimated_generation_gwh, r.estimation_method) for r in rows] == [
        (2013, Decimal("1.50"), None, None),
        (2014, None, Decimal("2.00"), "HYDRO-V1"),
        (2019, Decimal("4.00"), None, None),
    ]
    assert {r.data_source for r in rows} == {"S"}


def test_unpivot_is_narrow(spark):
    plan = reshape.generation_unpivot(raw(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert "Generate stack" in plan and "Exchange" not in plan and "Python" not in plan
