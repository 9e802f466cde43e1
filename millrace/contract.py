"""Table contracts: columns, bounds, domains and keys, stated once.

A contract gives the Spark schema, the DDL, and one boolean rule per constraint.  All
row rules are evaluated in one narrow pass; only key rules (see
:mod:`millrace.operators.checks`) need a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from millrace.functions.clean import text_literal

# The closed domain of fuel labels.
FUELS = (
    "Biomass",
    "Coal",
    "Cogeneration",
    "Gas",
    "Geothermal",
    "Hydro",
    "Nuclear",
    "Oil",
    "Other",
    "Petcoke",
    "Solar",
    "Storage",
    "Waste",
    "Wave and Tidal",
    "Wind",
)

# Years the wide source carries.
GENERATION_YEARS = (2013, 2014, 2015, 2016, 2017, 2018, 2019)
ESTIMATE_YEARS = (2013, 2014, 2015, 2016, 2017)


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = False
    max_length: int | None = None
    exact_length: int | None = None
    domain: tuple[str, ...] = ()
    stamped: bool = False  # filled by the writer, absent before the load

    @property
    def ddl(self) -> str:
        kind = self.type.upper()
        if self.exact_length:
            kind = f"CHAR({self.exact_length})"
        elif self.max_length:
            kind = f"VARCHAR({self.max_length})"
        return f"`{self.name}` {kind}{' NOT NULL' if self.required else ''}"


@dataclass(frozen=True)
class TableContract:
    name: str
    fields: tuple[Field, ...]
    checks: tuple[tuple[str, str, str], ...] = ()  # (rule name, column, SQL test); null passes
    unique: tuple[tuple[str, ...], ...] = ()
    parent: tuple[str, str, str] | None = None  # (own column, parent table, parent column)
    partition_by: tuple[str, ...] = ()
    key: str = "id"

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f.name, T.DataType.fromDDL(f.type), True) for f in self.fields]
        )

    @property
    def loaded_columns(self) -> list[str]:
        """Columns the transform must deliver: all but the key and the stamps."""
        return [f.name for f in self.fields if f.name != self.key and not f.stamped]

    def rules(self, values: Mapping[str, str]) -> dict[str, str]:
        """Rule name to an SQL predicate, never null and true for a good row.

        ``values`` gives the SQL text of each column to check; rules of others are left out.
        """
        out: dict[str, str] = {}
        for f in self.fields:
            if f.name not in values:
                continue
            value = values[f.name]
            if f.required and not (f.stamped or f.name == self.key):
                out[f"{f.name}_required"] = f"{value} IS NOT NULL"
            if f.max_length:
                out[f"{f.name}_max_{f.max_length}"] = _passes(f"length({value}) <= {f.max_length}")
            if f.exact_length:
                out[f"{f.name}_exactly_{f.exact_length}"] = _passes(f"length({value}) = {f.exact_length}")
            if f.domain:
                labels = ", ".join(text_literal(x) for x in f.domain)
                out[f"{f.name}_domain"] = _passes(f"{value} IN ({labels})")
        for name, column, test in self.checks:
            if column in values:
                out[name] = _passes(f"{values[column]} {test}")
        return out

    def create_sql(self, database: str) -> str:
        columns = ", ".join(f.ddl for f in self.fields)
        parts = ", ".join(f"`{p}`" for p in self.partition_by)
        tail = f" PARTITIONED BY ({parts})" if parts else ""
        return f"CREATE TABLE IF NOT EXISTS `{database}`.`{self.name}` ({columns}) USING parquet{tail}"


def _passes(test: str) -> str:
    """A comparison with null passes, as a check constraint does."""
    return f"coalesce({test}, true)"


# Names, types, lengths and ranges of the two tables.
PLANTS = TableContract(
    name="power_plants",
    fields=(
        Field("id", "bigint", required=True),
        Field("gppd_idnr", "string", required=True, max_length=20),
        Field("name", "string", required=True, max_length=500),
        Field("country_code", "string", required=True, exact_length=3),
        Field("country", "string", required=True, max_length=100),
        Field("capacity_mw", "decimal(12,2)", required=True),
        Field("latitude", "decimal(10,6)", required=True),
        Field("longitude", "decimal(11,6)", required=True),
        Field("primary_fuel", "string", required=True, domain=FUELS),
        Field("other_fuel1", "string", domain=FUELS),
        Field("other_fuel2", "string", domain=FUELS),
        Field("other_fuel3", "string", domain=FUELS),
        Field("commissioning_year", "int"),
        Field("owner", "string", max_length=500),
        Field("source", "string", max_length=200),
        Field("url", "string"),
        Field("geolocation_source", "string", max_length=200),
        Field("wepp_id", "string", max_length=50),
        Field("year_of_capacity_data", "int"),
        Field("created_at", "timestamp", stamped=True),
        Field("updated_at", "timestamp", stamped=True),
    ),
    checks=(
        ("capacity_positive", "capacity_mw", "> 0"),
        ("latitude_range", "latitude", "BETWEEN -90 AND 90"),
        ("longitude_range", "longitude", "BETWEEN -180 AND 180"),
    ),
    unique=(("gppd_idnr",),),
    partition_by=("primary_fuel",),
)

GENERATION = TableContract(
    name="power_plant_generation",
    fields=(
        Field("id", "bigint", required=True),
        Field("power_plant_id", "bigint", required=True),
        Field("year", "int", required=True),
        Field("generation_gwh", "decimal(12,2)"),
        Field("estimated_generation_gwh", "decimal(12,2)"),
        Field("estimation_method", "string", max_length=50),
        Field("data_source", "string", max_length=200),
    ),
    checks=(("year_range", "year", "BETWEEN 2000 AND 2030"),),
    unique=(("power_plant_id", "year"),),
    parent=("power_plant_id", "power_plants", "id"),
)

# Parents first; drop in the reverse order.
TABLES = (PLANTS, GENERATION)

# The columns of the raw file.
SOURCE_COLUMNS = (
    "country",
    "country_long",
    "name",
    "gppd_idnr",
    "capacity_mw",
    "latitude",
    "longitude",
    "primary_fuel",
    "other_fuel1",
    "other_fuel2",
    "other_fuel3",
    "commissioning_year",
    "owner",
    "source",
    "url",
    "geolocation_source",
    "wepp_id",
    "year_of_capacity_data",
    *[f"generation_gwh_{y}" for y in GENERATION_YEARS],
    "generation_data_source",
    *[f"estimated_generation_gwh_{y}" for y in ESTIMATE_YEARS],
    *[f"estimated_generation_note_{y}" for y in ESTIMATE_YEARS],
)


def text_schema(columns: tuple[str, ...] | list[str] = SOURCE_COLUMNS) -> T.StructType:
    """All-string schema for a raw file."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def create_tables(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for contract in TABLES:
        spark.sql(contract.create_sql(database))


def drop_tables(spark: SparkSession, database: str) -> None:
    """Roll back: children before parents; missing tables are fine."""
    for contract in reversed(TABLES):
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{contract.name}`")


def reset_tables(spark: SparkSession, database: str) -> None:
    drop_tables(spark, database)
    create_tables(spark, database)
