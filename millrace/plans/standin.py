"""The power-plant data model laid over the given star-schema tables.

The real source file is not available, so customers act as plants and their orders as
generation figures.  Every row of the tables is used; nothing is sampled.

* plant: ``customer`` with its ``nation``; the account balance is the capacity, so some
  plants break the positive-capacity check
* figure: an order counts as reported (status F), estimated (O) or unknown (P); order
  years 1995..2001 are moved to 2013..2019
* raw rows: the same, as text, with dirt added by rule so that every cleaning step has work
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.contract import FUELS, GENERATION_YEARS

YEAR_SHIFT = 18

_FUEL_LIST = ", ".join(f"'{f}'" for f in FUELS)
# Five segments of three fuels each.
_SEGMENT = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1
    WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END"""

_PLANT = {
    "id": "c_custkey",
    "gppd_idnr": "c_name",
    "name": "concat(n_name, ' ', lower(c_mktsegment), ' ', c_custkey)",
    "country_code": "concat('N', lpad(CAST(c_nationkey AS string), 2, '0'))",
    "country": "n_name",
    "capacity_mw": "CAST(c_acctbal AS decimal(12,2))",
    "latitude": "CAST(CAST(c_custkey * 7919 % 18000 AS double) / 100 - 90 AS decimal(10,6))",
    "longitude": "CAST(CAST(c_custkey * 104729 % 36000 AS double) / 100 - 180 AS decimal(11,6))",
    "primary_fuel": f"element_at(array({_FUEL_LIST}), CAST(({_SEGMENT}) * 3 + c_custkey % 3 + 1 AS int))",
    "commissioning_year": "CASE WHEN c_custkey % 5 >= 2 THEN CAST(1900 + c_custkey % 124 AS int) END",
    "owner": "CASE WHEN c_custkey % 4 > 0 THEN concat('Owner ', c_custkey % 97) END",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))


def plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed plants; one per customer."""
    return _customers(spark, sf_dir).selectExpr(*[f"{e} AS {c}" for c, e in _PLANT.items()])


def order_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, so a plant can have several rows for a year."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        "o_custkey AS power_plant_id",
        f"year(o_orderdate) + {YEAR_SHIFT} AS year",
        "CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS decimal(12,2)) END AS generation_gwh",
        "CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS decimal(12,2)) END AS estimated_generation_gwh",
    )


def generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed long generation; one row per plant and year with at least one figure.

    Orders are summed inside each task first, so a plant with very many orders is no hot spot.
    """
    summed = (
        order_figures(spark, sf_dir)
        .groupBy("power_plant_id", "year")
        .agg(
            F.sum("generation_gwh").cast("decimal(12,2)").alias("generation_gwh"),
            F.sum("estimated_generation_gwh").cast("decimal(12,2)").alias("estimated_generation_gwh"),
        )
    )
    method = F.when(F.col("estimated_generation_gwh").isNotNull(), F.lit("CAPACITY-FACTOR-V1"))
    return summed.where(
        "generation_gwh IS NOT NULL OR estimated_generation_gwh IS NOT NULL"
    ).withColumn("estimation_method", method)


_RAW = {
    "country": _PLANT["country_code"],
    "country_long": "n_name",
    "name": f"CASE c_custkey % 17 WHEN 3 THEN 'NULL' WHEN 4 THEN '' WHEN 5 THEN 'None' ELSE {_PLANT['name']} END",
    "gppd_idnr": "c_name",
    "capacity_mw": """CASE c_custkey % 13
        WHEN 1 THEN concat(' ', CAST(CAST(c_acctbal AS decimal(12,2)) AS string), ' ')
        WHEN 3 THEN 'NA' WHEN 5 THEN 'n/a' WHEN 7 THEN '12abc' WHEN 9 THEN '1,000'
        WHEN 11 THEN concat(CAST(CAST(c_acctbal AS decimal(12,2)) AS string), 'e0')
        ELSE CAST(CAST(c_acctbal AS decimal(12,2)) AS string) END""",
    "latitude": f"CASE WHEN c_custkey % 31 = 3 THEN '' ELSE CAST({_PLANT['latitude']} AS string) END",
    "longitude": f"CAST({_PLANT['longitude']} AS string)",
    "primary_fuel": f"""CASE WHEN c_custkey % 23 = 5 THEN 'coal' WHEN c_custkey % 29 = 7 THEN 'Peat'
        ELSE {_PLANT['primary_fuel']} END""",
    "other_fuel1": "CASE c_custkey % 6 WHEN 1 THEN 'Oil' WHEN 2 THEN 'Peat' WHEN 3 THEN 'N/A' END",
    "commissioning_year": """CASE c_custkey % 5 WHEN 0 THEN 'NaN' WHEN 1 THEN NULL
        WHEN 2 THEN concat(CAST(1900 + c_custkey % 124 AS string), '.9')
        ELSE CAST(1900 + c_custkey % 124 AS string) END""",
    "owner": _PLANT["owner"],
    "year_of_capacity_data": "CASE WHEN c_custkey % 3 = 0 THEN '2017.0' ELSE '2019' END",
}


def raw_plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text rows without the yearly columns."""
    return _customers(spark, sf_dir).selectExpr(*[f"{e} AS {c}" for c, e in _RAW.items()])


def _wide(keyed: DataFrame, key: str, figures: DataFrame, estimates: tuple[int, ...]) -> DataFrame:
    """Raw rows joined with their yearly figures as text columns, one set per row."""

    def yearly(measure: str, years: tuple[int, ...]) -> list[Column]:
        return [
            F.expr(
                f"""CAST(CAST(CAST(sum({measure}) FILTER (WHERE year = {y}) AS decimal(20,0)) / 100 AS decimal(12,2)) AS string)
                AS {measure}_{y}"""
            )
            for y in years
        ]

    # Summed as whole hundredths, exactly: sums of this decimal do not fit a long, and each row adds to all of them.
    cents = {c: F.expr(f"CAST({c} * 100 AS bigint)") for c in ("generation_gwh", "estimated_generation_gwh")}
    figures = figures.withColumns(cents)
    wide = figures.groupBy("power_plant_id").agg(
        *yearly("generation_gwh", GENERATION_YEARS), *yearly("estimated_generation_gwh", estimates)
    )
    joined = keyed.join(wide, F.col(key) == F.col("power_plant_id"), "left")
    notes = [
        f"""CASE WHEN estimated_generation_gwh_{y} IS NOT NULL THEN 'CAPACITY-FACTOR-V1' END
        AS estimated_generation_note_{y}"""
        for y in estimates
    ]
    return joined.selectExpr("*", "'orders' AS generation_data_source", *notes).drop(key, "power_plant_id")


def raw_wide(spark: SparkSession, sf_dir: str, estimates: tuple[int, ...] = GENERATION_YEARS) -> DataFrame:
    """Raw text rows with reported 2013..2019 and the given years of estimates; one per customer."""
    keyed = _customers(spark, sf_dir).selectExpr("c_custkey", *[f"{e} AS {c}" for c, e in _RAW.items()])
    return _wide(keyed, "c_custkey", order_figures(spark, sf_dir), estimates)


_RAW_ORDER = {
    "country": "concat('P0', left(o_orderpriority, 1))",
    "country_long": "o_orderpriority",
    "name": "concat('Order ', o_orderkey)",
    "gppd_idnr": "concat('Order#', lpad(CAST(o_orderkey AS string), 12, '0'))",
    "capacity_mw": "CAST(CAST(o_totalprice AS decimal(12,2)) AS string)",
    "latitude": "CAST(o_orderkey * 7919 % 180 - 90 AS string)",
    "longitude": "CAST(o_orderkey * 104729 % 360 - 180 AS string)",
    "primary_fuel": f"element_at(array({_FUEL_LIST}), CAST(o_orderkey % {len(FUELS)} + 1 AS int))",
    "commissioning_year": "concat(CAST(year(o_orderdate) AS string), '.5')",
}


def raw_wide_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same shape from the two large tables: orders as plants, line items as figures."""
    keyed = table(spark, sf_dir, "orders").selectExpr("o_orderkey", *[f"{e} AS {c}" for c, e in _RAW_ORDER.items()])
    figures = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS power_plant_id",
        f"year(l_shipdate) + {YEAR_SHIFT} AS year",
        "CASE WHEN l_returnflag <> 'N' THEN CAST(l_extendedprice AS decimal(12,2)) END AS generation_gwh",
        "CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS decimal(12,2)) END AS estimated_generation_gwh",
    )
    return _wide(keyed, "o_orderkey", figures, GENERATION_YEARS)


# The same views for the oracle.  Names: plants, order_figures, generation, raw.
_DUCK_FUELS = f"[{_FUEL_LIST}]"
_DUCK_LAT = "CAST(CAST(c_custkey * 7919 % 18000 AS DOUBLE) / 100 - 90 AS DECIMAL(10,6))"
_DUCK_LNG = "CAST(CAST(c_custkey * 104729 % 36000 AS DOUBLE) / 100 - 180 AS DECIMAL(11,6))"
_DUCK_FUEL = f"{_DUCK_FUELS}[({_SEGMENT}) * 3 + c_custkey % 3 + 1]"
_DUCK_CODE = "'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0')"
_DUCK_NAME = "n_name || ' ' || lower(c_mktsegment) || ' ' || CAST(c_custkey AS VARCHAR)"
_DUCK_CAP = "CAST(c_acctbal AS DECIMAL(12,2))"
_DUCK_OWNER = "CASE WHEN c_custkey % 4 > 0 THEN 'Owner ' || CAST(c_custkey % 97 AS VARCHAR) END"

PLANTS_CTE = f"""plants AS (
  SELECT c_custkey AS id, c_name AS gppd_idnr, {_DUCK_NAME} AS name, {_DUCK_CODE} AS country_code,
    n_name AS country, {_DUCK_CAP} AS capacity_mw, {_DUCK_LAT} AS latitude, {_DUCK_LNG} AS longitude,
    {_DUCK_FUEL} AS primary_fuel,
    CASE WHEN c_custkey % 5 >= 2 THEN CAST(1900 + c_custkey % 124 AS INTEGER) END AS commissioning_year,
    {_DUCK_OWNER} AS owner
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

FIGURES_CTE = f"""order_figures AS (
  SELECT o_orderkey AS id, o_custkey AS power_plant_id,
    CAST(year(o_orderdate) + {YEAR_SHIFT} AS INTEGER) AS year,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS generation_gwh,
    CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS estimated_generation_gwh
  FROM orders)"""

GENERATION_CTE = f"""{FIGURES_CTE},
generation AS (
  SELECT power_plant_id, year, sum(generation_gwh) AS generation_gwh,
    sum(estimated_generation_gwh) AS estimated_generation_gwh,
    CASE WHEN sum(estimated_generation_gwh) IS NOT NULL THEN 'CAPACITY-FACTOR-V1' END AS estimation_method
  FROM order_figures GROUP BY power_plant_id, year
  HAVING sum(generation_gwh) IS NOT NULL OR sum(estimated_generation_gwh) IS NOT NULL)"""

RAW_CTE = f"""raw AS (
  SELECT c_custkey, {_DUCK_CODE} AS country, n_name AS country_long,
    CASE c_custkey % 17 WHEN 3 THEN 'NULL' WHEN 4 THEN '' WHEN 5 THEN 'None' ELSE {_DUCK_NAME} END AS name,
    c_name AS gppd_idnr,
    CASE c_custkey % 13 WHEN 1 THEN ' ' || CAST({_DUCK_CAP} AS VARCHAR) || ' '
      WHEN 3 THEN 'NA' WHEN 5 THEN 'n/a' WHEN 7 THEN '12abc' WHEN 9 THEN '1,000'
      WHEN 11 THEN CAST({_DUCK_CAP} AS VARCHAR) || 'e0' ELSE CAST({_DUCK_CAP} AS VARCHAR) END AS capacity_mw,
    CASE WHEN c_custkey % 31 = 3 THEN '' ELSE CAST({_DUCK_LAT} AS VARCHAR) END AS latitude,
    CAST({_DUCK_LNG} AS VARCHAR) AS longitude,
    CASE WHEN c_custkey % 23 = 5 THEN 'coal' WHEN c_custkey % 29 = 7 THEN 'Peat'
      ELSE {_DUCK_FUEL} END AS primary_fuel,
    CASE c_custkey % 6 WHEN 1 THEN 'Oil' WHEN 2 THEN 'Peat' WHEN 3 THEN 'N/A' END AS other_fuel1,
    CASE c_custkey % 5 WHEN 0 THEN 'NaN' WHEN 1 THEN NULL
      WHEN 2 THEN CAST(1900 + c_custkey % 124 AS VARCHAR) || '.9'
      ELSE CAST(1900 + c_custkey % 124 AS VARCHAR) END AS commissioning_year,
    {_DUCK_OWNER} AS owner,
    CASE WHEN c_custkey % 3 = 0 THEN '2017.0' ELSE '2019' END AS year_of_capacity_data
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

# The missing-value tokens that occur in the raw rows above.
_TOKENS = "('', 'NA', 'n/a', 'N/A', 'NULL', 'None', 'NaN')"


def _token(text: str) -> str:
    return f"CASE WHEN {text} NOT IN {_TOKENS} THEN {text} END"


_DOMAIN = ", ".join(f"'{f}'" for f in FUELS)
TYPED_CTE = f"""{RAW_CTE},
typed AS (
  SELECT c_custkey, gppd_idnr, coalesce({_token('name')}, 'Unknown') AS name, country AS country_code,
    country_long AS country,
    CAST(TRY_CAST(trim({_token('capacity_mw')}) AS DOUBLE) AS DECIMAL(12,2)) AS capacity_mw,
    CAST(TRY_CAST({_token('latitude')} AS DOUBLE) AS DECIMAL(10,6)) AS latitude,
    CAST(TRY_CAST({_token('longitude')} AS DOUBLE) AS DECIMAL(11,6)) AS longitude,
    CASE WHEN primary_fuel IN ({_DOMAIN}) THEN primary_fuel END AS primary_fuel,
    CASE WHEN other_fuel1 IN ({_DOMAIN}) THEN other_fuel1 END AS other_fuel1,
    CAST(trunc(TRY_CAST({_token('commissioning_year')} AS DOUBLE)) AS INTEGER) AS commissioning_year,
    owner,
    CAST(trunc(TRY_CAST(year_of_capacity_data AS DOUBLE)) AS INTEGER) AS year_of_capacity_data
  FROM raw),
tagged AS (
  SELECT *, CASE WHEN capacity_mw IS NULL THEN 'capacity_mw missing'
    WHEN latitude IS NULL THEN 'latitude missing' WHEN longitude IS NULL THEN 'longitude missing'
    WHEN primary_fuel IS NULL THEN 'primary_fuel missing' END AS reject_reason
  FROM typed)"""


def with_views(sql: str, *ctes: str) -> str:
    """Prefix a query with the views it uses."""
    return f"WITH {', '.join(ctes)}\n{sql}"
