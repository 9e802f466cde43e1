"""Raw wide rows to the plants table and the long generation table."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.contract import FUELS, GENERATION_YEARS, PLANTS
from millrace.functions.clean import (
    col,
    decimal_sql,
    default_sql,
    domain_sql,
    int_sql,
    number_sql,
    quoted,
)

# Target column to source column, copied unchanged.
COPIED = {
    "gppd_idnr": "gppd_idnr",
    "country_code": "country",
    "country": "country_long",
    "owner": "owner",
    "source": "source",
    "url": "url",
    "geolocation_source": "geolocation_source",
    "wepp_id": "wepp_id",
}

# A row without one of these is not loaded.
NEEDED = ("capacity_mw", "latitude", "longitude", "primary_fuel")


def column_or_null(df: DataFrame, name: str) -> str:
    """The column, or a typed null when the file does not carry it (as SQL text)."""
    return quoted(name) if name in df.columns else "CAST(NULL AS string)"


def plants_transform(raw: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    """Typed plant rows, one per raw row, valid or not; a single projection.

    ``extra`` expressions are computed from the raw row and carried along.
    """

    def number(name: str, precision: int, scale: int) -> str:
        return decimal_sql(number_sql(column_or_null(raw, name)), precision, scale)

    typed = {target: column_or_null(raw, name) for target, name in COPIED.items()}
    typed["name"] = default_sql(column_or_null(raw, "name"), "Unknown")
    typed["capacity_mw"] = number("capacity_mw", 12, 2)
    typed["latitude"] = number("latitude", 10, 6)
    typed["longitude"] = number("longitude", 11, 6)
    for name in ("primary_fuel", "other_fuel1", "other_fuel2", "other_fuel3"):
        typed[name] = domain_sql(column_or_null(raw, name), FUELS)
    for name in ("commissioning_year", "year_of_capacity_data"):
        typed[name] = int_sql(column_or_null(raw, name))
    return raw.selectExpr(*[f"{typed[name]} AS {name}" for name in PLANTS.loaded_columns], *extra)


def with_reject_reason(plants: DataFrame) -> DataFrame:
    """Adds ``reject_reason``: the first needed column that is missing, null for a valid row."""
    reasons = " ".join(f"WHEN {c} IS NULL THEN '{c} missing'" for c in NEEDED)
    return plants.withColumn("reject_reason", F.expr(f"CASE {reasons} END"))


def valid_plants(plants: DataFrame) -> DataFrame:
    return plants.where(" AND ".join(f"{c} IS NOT NULL" for c in NEEDED))


def reject_counts(plants: DataFrame) -> DataFrame:
    """Rejected rows per reason; at most one partial row per reason leaves each task."""
    tagged = with_reject_reason(plants).where("reject_reason IS NOT NULL")
    return tagged.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def year_columns(raw: DataFrame) -> list[str]:
    """The yearly text columns this file carries, and the source they share."""
    return [c for c in raw.columns if c.startswith(("generation_", "estimated_generation_"))]


def figure_years(columns: Iterable[str]) -> list[int]:
    """The years for which a file carries a figure, from its header."""
    found = (re.fullmatch(r"(?:estimated_)?generation_gwh_(\d+)", c) for c in columns)
    return sorted({int(m[1]) for m in found if m})


def generation_unpivot(
    raw: DataFrame,
    years: Iterable[int] = GENERATION_YEARS,
    keep: Iterable[str] = ("gppd_idnr",),
) -> DataFrame:
    """Wide text columns to one typed row per raw row and year with a figure.

    Year columns the file lacks read as null.  ``stack`` is a narrow generator: no shuffle,
    however many years.  Text is parsed after it, by one expression for all years: parsing
    every year column of the wide row generates a method too large for the JIT compiler.
    """
    years = list(years)
    kept = [quoted(c) for c in keep]
    measures = ("generation_gwh", "estimated_generation_gwh", "estimated_generation_note")
    slots = ", ".join(
        f"{y}, " + ", ".join(column_or_null(raw, f"{measure}_{y}") for measure in measures) for y in years
    )
    source = column_or_null(raw, "generation_data_source")
    text = raw.selectExpr(
        *kept, f"{source} AS data_source", f"stack({len(years)}, {slots}) AS (year, reported, estimated, method)"
    )
    typed = text.where("reported IS NOT NULL OR estimated IS NOT NULL").selectExpr(
        *kept,
        "year",
        f"{decimal_sql(number_sql('reported'), 12, 2)} AS generation_gwh",
        f"{decimal_sql(number_sql('estimated'), 12, 2)} AS estimated_generation_gwh",
        "method AS estimation_method",
        "data_source",
    )
    return typed.where("generation_gwh IS NOT NULL OR estimated_generation_gwh IS NOT NULL")
