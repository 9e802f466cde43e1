"""Grouped statistics.

Every report over the plants starts from small cells, one per country and fuel: the scan
is aggregated inside each task, and distinct counts become plain counts over the cells.
Cells do not grow with the number of plants, and a country or fuel that holds most of the
plants sends one row per task like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.clean import col
from millrace.functions.labels import fixed_label
from millrace.operators.paging import clamp_limit


def capacity_cells(plants: DataFrame, *keys: str) -> DataFrame:
    """One row per combination of the keys, by default country code and fuel."""
    return plants.groupBy(*(keys or ("country_code", "primary_fuel"))).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("capacity_mw").alias("n_capacity"),
        F.sum("capacity_mw").cast("decimal(38,2)").alias("capacity"),
        F.max("capacity_mw").alias("largest"),
        F.min("commissioning_year").alias("oldest"),
        F.max("commissioning_year").alias("newest"),
    )


def _total_mw():
    return F.sum("capacity").cast("double")


def _mean_mw():
    return F.sum("capacity").cast("double") / F.nullif(F.sum("n_capacity"), F.lit(0))


def summary(plants: DataFrame) -> DataFrame:
    """One row about the whole table; without plants the counts are 0 and the rest null."""
    return summary_of(capacity_cells(plants))


def summary_of(cells: DataFrame) -> DataFrame:
    """The same from cells, such as those of `running`."""
    return cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_plants"),
        _total_mw().alias("total_capacity_mw"),
        (_total_mw() / 1000).alias("total_capacity_gw"),
        F.countDistinct("country_code").alias("total_countries"),
        F.countDistinct("primary_fuel").alias("fuel_types"),
        _mean_mw().alias("avg_capacity_mw"),
        F.max("largest").cast("double").alias("max_capacity_mw"),
        F.min("oldest").alias("oldest_plant_year"),
        F.max("newest").alias("newest_plant_year"),
    )


def by_country(plants: DataFrame, limit: int | None = None) -> DataFrame:
    """Countries by total capacity: the largest 20, or ``limit`` up to 200, as a request bounds it.

    `all_countries` gives every one.
    """
    k = clamp_limit(limit, 20, 200)
    ordering = [F.col("total_capacity_mw").desc_nulls_first(), "country_code", "country"]
    return all_countries(plants).orderBy(*ordering).limit(k)


def all_countries(plants: DataFrame) -> DataFrame:
    """Every country with count, capacity and number of fuels."""
    return countries_of(capacity_cells(plants, "country_code", "country", "primary_fuel"))


def countries_of(cells: DataFrame) -> DataFrame:
    """The same from one cell per country and fuel."""
    return cells.groupBy("country_code", "country").agg(
        F.sum("n").alias("plant_count"),
        _total_mw().alias("total_capacity_mw"),
        (_total_mw() / 1000).alias("total_capacity_gw"),
        _mean_mw().alias("avg_capacity_mw"),
        F.count("primary_fuel").alias("fuel_diversity"),
    )


def by_fuel(plants: DataFrame) -> DataFrame:
    """Fuels with count, capacity and number of countries."""
    return capacity_cells(plants).groupBy(col("primary_fuel").alias("fuel")).agg(
        F.sum("n").alias("plant_count"),
        _total_mw().alias("total_capacity_mw"),
        (_total_mw() / 1000).alias("total_capacity_gw"),
        _mean_mw().alias("avg_capacity_mw"),
        F.count("country_code").alias("country_count"),
    )


def fuel_share(plants: DataFrame) -> DataFrame:
    """:func:`by_fuel` with each fuel's percentage of the total, largest first.

    The total is a window over the grouped rows: one per label of the closed fuel domain.
    """
    grouped = by_fuel(plants)
    everything = F.sum("total_capacity_mw").over(Window.partitionBy())
    percent = F.col("total_capacity_mw") / everything * 100
    shared = grouped.withColumn("percentage_of_total", fixed_label(percent, 2))
    return shared.orderBy(F.col("total_capacity_mw").desc_nulls_first(), "fuel")


def fuel_total(plants: DataFrame) -> DataFrame:
    """The grand total shown next to the fuel rows."""
    return capacity_cells(plants).agg(_total_mw().alias("total_capacity_mw"))


def top_fuels(plants: DataFrame, k: int = 8) -> DataFrame:
    """The k largest fuels and their share among the k shown (not of everything)."""
    top = (
        by_fuel(plants)
        .select("fuel", "total_capacity_gw")
        .orderBy(F.col("total_capacity_gw").desc_nulls_first(), "fuel")
        .limit(k)
    )
    shown = F.sum("total_capacity_gw").over(Window.partitionBy())
    return top.withColumn("percent_of_shown", fixed_label(F.col("total_capacity_gw") / shown * 100, 0))


def generation_trends(generation: DataFrame) -> DataFrame:
    """Rows and total generation per year, reported figures before estimates."""
    figure = F.coalesce("generation_gwh", "estimated_generation_gwh")
    total = F.coalesce(F.sum(figure).cast("double"), F.lit(0.0))
    return (
        generation.groupBy("year")
        .agg(
            F.count(F.lit(1)).alias("plants_with_data"),
            total.alias("total_generation_gwh"),
            (total / 1000).alias("total_generation_twh"),
        )
        .orderBy("year")
    )


def validate_counts(plants: DataFrame, generation: DataFrame) -> DataFrame:
    """Loaded plants, generation rows and countries, one row per check."""
    cells = capacity_cells(plants).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("power_plants"),
        F.countDistinct("country_code").alias("countries"),
    )
    from_plants = cells.unpivot([], ["power_plants", "countries"], "check", "n_rows")
    from_generation = generation.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("generation_records").alias("check"), "n_rows"
    )
    return from_plants.unionByName(from_generation)


def validate_fuel_breakdown(plants: DataFrame) -> DataFrame:
    return (
        plants.groupBy(col("primary_fuel").alias("fuel"))
        .agg(
            F.count(F.lit(1)).alias("plant_count"),
            F.sum("capacity_mw").cast("double").alias("total_mw"),
        )
        .orderBy(F.col("total_mw").desc_nulls_first(), "fuel")
    )


def quality_profile(plants: DataFrame, generation: DataFrame) -> DataFrame:
    """Data quality rates, one row per measure, from one scan of each table.

    Missing commissioning years, plants with a reported figure, estimated figures.
    """
    # One row per plant before the join, however many figures a plant has.
    per_plant = generation.groupBy("power_plant_id").agg(
        F.count(F.lit(1)).alias("n_figures"), F.count("generation_gwh").alias("n_reported")
    )
    both = plants.select("id", "commissioning_year").join(
        per_plant, F.col("id") == F.col("power_plant_id"), "full"
    )
    counted = both.selectExpr(
        "count_if(id IS NOT NULL AND commissioning_year IS NULL) AS no_year",
        "count_if(id IS NOT NULL AND n_reported > 0) AS covered",
        "count(id) AS n_plants",
        "coalesce(sum(n_figures - n_reported), 0) AS estimated",
        "coalesce(sum(n_figures), 0) AS n_figures",
    )
    rows = counted.selectExpr(
        """stack(3, 'commissioning_year_missing', no_year, n_plants,
        'plants_with_reported_generation', covered, n_plants,
        'generation_estimated', estimated, n_figures) AS (measure, n, out_of)"""
    )
    return rows.selectExpr("*", "n / nullif(out_of, 0) AS rate")
