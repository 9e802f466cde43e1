from decimal import Decimal

import pytest

from millrace.operators import stats

PLANTS = "id bigint, country_code string, country string, primary_fuel string, capacity_mw decimal(12,2), commissioning_year int"


@pytest.fixture(scope="module")
def plants(spark):
    rows = [
        (1, "USA", "United States", "Coal", Decimal("100"), 1990),
        (2, "USA", "United States", "Gas", Decimal("300.50"), None),
        (3, "FRA", "France", "Coal", Decimal("99.50"), 2001),
        (4, "FRA", "France", "Solar", Decimal("0.25"), 2015),
    ]
    return spark.createDataFrame(rows, PLANTS).cache()


@pytest.fixture(scope="module")
def nobody(spark):
    return spark.createDataFrame([], PLANTS)


def test_summary(plants, nobody):
    row = stats.summary(plants).collect()[0]
    assert (row.total_plants, row.total_capacity_mw, row.total_countries, row.fuel_types) == (4, 500.25, 2, 3)
    assert row.avg_capacity_mw == 500.25 / 4 and row.max_capacity_mw == 300.5
    assert (row.oldest_plant_year, row.newest_plant_year) == (1990, 2015)
    empty = stats.summary(nobody).collect()[0]
    assert (empty.total_plants, empty.total_countries, empty.total_capacity_mw) == (0, 0, None)


def test_by_country(plants):
    rows = stats.by_country(plants).collect()
    assert [(r.country_code, r.plant_count, r.total_capacity_mw, r.fuel_diversity) for r in rows] == [
        ("USA", 2, 400.5, 2),
        ("FRA", 2, 99.75, 2),
    ]
    assert stats.by_country(plants, limit=1).count() == 1


def test_fuel_share_is_of_everything_and_top_is_of_shown(plants):
    share = {r.fuel: r.percentage_of_total for r in stats.fuel_share(plants).collect()}
    assert share == {"Gas": "60.07", "Coal": "39.88", "Solar": "0.05"}
    top = {r.fuel: r.percent_of_shown for r in stats.top_fuels(plants, 2).collect()}
    assert top == {"Gas": "60", "Coal": "40"}
    assert stats.fuel_total(plants).collect()[0][0] == 500.25


def test_one_country_code_with_two_names_counts_once_per_fuel(spark):
    rows = [(1, "USA", "US", "Coal", Decimal(1), None), (2, "USA", "United States", "Coal", Decimal(1), None)]
    assert stats.by_fuel(spark.createDataFrame(rows, PLANTS)).collect()[0].country_count == 1


def test_trends_prefer_reported_and_turn_nothing_into_zero(spark):
    rows = [
        (1, 2013, Decimal("1.00"), Decimal("9.00")),
        (2, 2013, None, Decimal("2.50")),
        (3, 2014, None, None),
    ]
    schema = "power_plant_id bigint, year int, generation_gwh decimal(12,2), estimated_generation_gwh decimal(12,2)"
    got = [tuple(r) for r in stats.generation_trends(spark.createDataFrame(rows, schema)).collect()]
    assert got == [(2013, 2, 3.5, 0.0035), (2014, 1, 0.0, 0.0)]


def test_reports_aggregate_before_the_shuffle(plants):
    for report in (stats.summary, stats.by_country, stats.by_fuel):
        plan = report(plants)._jdf.queryExecution().executedPlan().toString()
        first = plan[plan.rindex("Exchange") :]
        assert "partial_sum" in first
