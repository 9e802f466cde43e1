"""Registered queries: reading, cleaning, checking and loading."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.contract import ESTIMATE_YEARS, FUELS, GENERATION, PLANTS, create_tables, drop_tables, text_schema
from millrace.functions import clean
from millrace.functions.clean import col, null_tokens
from millrace.operators import checks, keys, reshape, running, stats
from millrace.operators.paging import order
from millrace.plans import standin
from millrace.plans.migration import Migration
from millrace.plans.pipeline import Pipeline
from millrace.plans.registry import plain, query
from millrace.plans.standin import (
    FIGURES_CTE,
    GENERATION_CTE,
    PLANTS_CTE,
    RAW_CTE,
    TYPED_CTE,
    with_views,
)
from millrace.sources import files, records, tables
from millrace.sources.versions import Store, Table, Version
from millrace.sources.workspace import materialize, new_path
from millrace.streaming.ingest import ingest_available, staged_batches, staged_quarantine, staged_rows

# -- files -----------------------------------------------------------------------

_PART_TEXT = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "price")
_PART_SQL = """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
  CAST(p_size AS VARCHAR) AS p_size, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS price FROM part"""


def _part_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = standin.table(spark, sf_dir, "part")
    price = col("p_retailprice").cast("decimal(12,2)").alias("price")
    return part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", price).select(
        *[col(c).cast("string") for c in _PART_TEXT]
    )


def _part_files(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "part-csv")
    files.write_csv(_part_text(spark, sf_dir), path)
    return path


@query("src_csv_scan", _PART_SQL)
def src_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.extract(spark, _part_files(spark, sf_dir), text_schema(_PART_TEXT))


@query("src_count", "SELECT count(*) AS n_records FROM part")
def src_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = files.scan_csv(spark, _part_files(spark, sf_dir), text_schema(_PART_TEXT))
    return files.count_records(scanned)


@query("ingest_incremental", _PART_SQL)
def ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of the same folder; the second holds only repeats and adds nothing."""
    landing, staging, checkpoint = (new_path(spark, n) for n in ("landing", "staging", "checkpoint"))
    text = _part_text(spark, sf_dir)
    schema = text_schema(_PART_TEXT)
    for _ in range(2):
        text.write.mode("append").options(header="true", quote='"', escape='"').csv(landing)
        ingest_available(spark, landing, schema, staging, checkpoint)
    return staged_rows(spark, staging, schema, ["p_partkey"])


_LINE_SQL = """SELECT CAST(p_partkey AS VARCHAR) || ',' ||
    CASE WHEN p_size > 25 THEN p_type || ', ' || p_name
         WHEN p_size > 10 THEN '"' || p_type || ', ' || p_name || '"' ELSE p_name END ||
    ',' || p_brand AS raw_line, p_size FROM part"""


def _part_lines(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "ragged-csv")
    standin.table(spark, sf_dir, "part").selectExpr(
        """concat(p_partkey, ',',
             CASE WHEN p_size > 25 THEN concat(p_type, ', ', p_name)
                  WHEN p_size > 10 THEN concat('"', p_type, ', ', p_name, '"') ELSE p_name END,
             ',', p_brand) AS value"""
    ).write.text(path)
    return path


@query("csv_quarantine", f"SELECT raw_line FROM ({_LINE_SQL}) WHERE p_size > 25")
def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with a bare comma make a row too long; quoted commas do not."""
    path = _part_lines(spark, sf_dir)
    schema = text_schema(["part_key", "name", "brand"])
    scanned = files.scan_csv(spark, path, schema, header=False, keep_raw_line=True)
    _, quarantine = files.split_ragged(materialize(scanned, "scanned"))
    return quarantine


# Breaks in every column, the last one too, one of them followed by what looks like a row.
_BROKEN = {
    "p_partkey": "CAST(p_partkey AS {text})",
    "p_name": "CASE p_partkey % 4 WHEN 0 THEN replace(p_name, ' ', {lf}) WHEN 1 THEN concat(p_name, ', \"', p_type, '\"') ELSE p_name END",
    "p_brand": "CASE p_partkey % 5 WHEN 0 THEN concat(p_brand, {cr}, {lf}, '1,fake,row') ELSE p_brand END",
    "p_type": "CASE p_partkey % 6 WHEN 0 THEN concat(p_type, {lf}, p_type, {lf}, {lf}, p_type) ELSE p_type END",
}


def _broken(text: str, lf: str, cr: str) -> dict[str, str]:
    return {c: e.format(text=text, lf=lf, cr=cr) for c, e in _BROKEN.items()}


@query(
    "csv_multiline",
    f"SELECT {', '.join(f'{e} AS {c}' for c, e in _broken('VARCHAR', 'chr(10)', 'chr(13)').items())} FROM part",
)
def csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line breaks inside quotes in any column; files stay splittable and no value is cut."""
    path = new_path(spark, "broken-csv")
    fields = [f"""concat('"', replace({e}, '"', '""'), '"')""" for e in _broken("string", "chr(10)", "chr(13)").values()]
    standin.table(spark, sf_dir, "part").selectExpr(f"concat_ws(',', {', '.join(fields)}) AS value").write.text(path)
    return records.scan_records(spark, path, text_schema(list(_BROKEN)), header=False).drop(files.RAW_LINE)


@query("ingest_quarantine", f"SELECT raw_line FROM ({_LINE_SQL}) WHERE p_size > 25")
def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ragged lines arriving as a stream."""
    staging, checkpoint = (new_path(spark, n) for n in ("staging", "checkpoint"))
    schema = text_schema(["part_key", "name", "brand"])
    ingest_available(spark, _part_lines(spark, sf_dir), schema, staging, checkpoint, header=False)
    return staged_quarantine(spark, staging, schema)


# -- cleaning --------------------------------------------------------------------


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.plants_transform(null_tokens(standin.raw_plants(spark, sf_dir)))


_T = "('', 'NA', 'n/a', 'N/A', 'NULL', 'None', 'NaN')"


@query(
    "null_tokens",
    with_views(
        f"""SELECT gppd_idnr, CASE WHEN name NOT IN {_T} THEN name END AS name,
          CASE WHEN capacity_mw NOT IN {_T} THEN capacity_mw END AS capacity_mw,
          CASE WHEN latitude NOT IN {_T} THEN latitude END AS latitude,
          CASE WHEN other_fuel1 NOT IN {_T} THEN other_fuel1 END AS other_fuel1,
          CASE WHEN commissioning_year NOT IN {_T} THEN commissioning_year END AS commissioning_year
        FROM raw""",
        RAW_CTE,
    ),
)
def null_token_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = standin.raw_plants(spark, sf_dir)
    return null_tokens(raw).select(
        "gppd_idnr", "name", "capacity_mw", "latitude", "other_fuel1", "commissioning_year"
    )


@query(
    "safe_numeric",
    with_views(
        f"""SELECT gppd_idnr, TRY_CAST(trim(CASE WHEN capacity_mw NOT IN {_T} THEN capacity_mw END) AS DOUBLE)
        AS capacity FROM raw""",
        RAW_CTE,
    ),
)
def safe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = null_tokens(standin.raw_plants(spark, sf_dir), ["capacity_mw"])
    return raw.select("gppd_idnr", clean.safe_numeric("capacity_mw").alias("capacity"))


@query(
    "safe_int",
    with_views(
        f"""SELECT gppd_idnr, CAST(trunc(TRY_CAST(CASE WHEN commissioning_year NOT IN {_T}
        THEN commissioning_year END AS DOUBLE)) AS INTEGER) AS year FROM raw""",
        RAW_CTE,
    ),
)
def safe_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = null_tokens(standin.raw_plants(spark, sf_dir), ["commissioning_year"])
    return raw.select("gppd_idnr", clean.safe_int("commissioning_year").alias("year"))


@query(
    "map_values",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'reported' WHEN 'O' THEN 'estimated' END AS kind,
      n_name AS country FROM orders LEFT JOIN customer ON o_custkey = c_custkey
      LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def map_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A literal dictionary for the status, and tables as dictionaries for the country."""
    orders = standin.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        clean.map_values("o_orderstatus", {"F": "reported", "O": "estimated"}).alias("kind"),
        col("o_custkey").alias("country"),
    )
    customer = standin.table(spark, sf_dir, "customer")
    nation = standin.table(spark, sf_dir, "nation")
    coded = clean.map_values_from(orders, "country", customer, "c_custkey", "c_nationkey")
    return clean.map_values_from(coded, "country", nation, "n_nationkey", "n_name")


@query(
    "decimal_cast",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(12,1)) AS DOUBLE) AS price,
      CASE WHEN abs(l_extendedprice) < 9999.995 THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) END
        AS small_price FROM lineitem""",
)
def decimal_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounding to the declared scale, and null where the declared precision overflows."""
    return plain(
        standin.table(spark, sf_dir, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            clean.safe_decimal("l_extendedprice", 12, 1).alias("price"),
            clean.safe_decimal("l_extendedprice", 6, 2).alias("small_price"),
        )
    )


_TYPED_COLUMNS = """gppd_idnr, name, country_code, country, CAST(capacity_mw AS DOUBLE) AS capacity_mw,
  CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, primary_fuel, other_fuel1,
  commissioning_year, owner, year_of_capacity_data"""
_TYPED_NAMES = (
    "gppd_idnr name country_code country capacity_mw latitude longitude primary_fuel other_fuel1 "
    "commissioning_year owner year_of_capacity_data"
).split()


@query("plants_transform", with_views(f"SELECT {_TYPED_COLUMNS} FROM typed", TYPED_CTE))
def plants_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_typed(spark, sf_dir).select(*_TYPED_NAMES))


@query(
    "valid_plants",
    with_views(f"SELECT {_TYPED_COLUMNS} FROM tagged WHERE reject_reason IS NULL", TYPED_CTE),
)
def valid_plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reshape.valid_plants(_typed(spark, sf_dir)).select(*_TYPED_NAMES))


@query(
    "reject_count",
    with_views(
        "SELECT reject_reason, count(*) AS n_rows FROM tagged WHERE reject_reason IS NOT NULL GROUP BY reject_reason",
        TYPED_CTE,
    ),
)
def reject_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.reject_counts(_typed(spark, sf_dir))


# -- wide to long ----------------------------------------------------------------

_UNPIVOT_SQL = """SELECT c_name AS gppd_idnr, year, CAST(generation_gwh AS DOUBLE) AS generation_gwh,
    CASE WHEN year <= 2017 THEN CAST(estimated_generation_gwh AS DOUBLE) END AS estimated_generation_gwh,
    CASE WHEN year <= 2017 THEN estimation_method END AS estimation_method, 'orders' AS data_source
  FROM generation JOIN customer ON c_custkey = power_plant_id
  WHERE generation_gwh IS NOT NULL OR year <= 2017"""


@query("generation_unpivot", with_views(_UNPIVOT_SQL, GENERATION_CTE))
def generation_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file lacks the last two years of estimates, as the real one does."""
    return plain(reshape.generation_unpivot(standin.raw_wide(spark, sf_dir, ESTIMATE_YEARS)))


# -- contract --------------------------------------------------------------------


def _rule_sql(name: str, broken: str) -> str:
    return f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {broken}) AS n_rows FROM typed"


def _contract_sql() -> str:
    # Columns the stand-in rows do not carry are all null.
    absent = ("other_fuel2", "other_fuel3", "source", "url", "geolocation_source", "wepp_id")
    out = []
    for f in PLANTS.fields:
        if f.name not in PLANTS.loaded_columns:
            continue
        value = "CAST(NULL AS VARCHAR)" if f.name in absent else f.name
        if f.required:
            out.append(_rule_sql(f"{f.name}_required", f"{value} IS NULL"))
        if f.max_length:
            out.append(_rule_sql(f"{f.name}_max_{f.max_length}", f"length({value}) > {f.max_length}"))
        if f.exact_length:
            out.append(_rule_sql(f"{f.name}_exactly_{f.exact_length}", f"length({value}) <> {f.exact_length}"))
        if f.domain:
            labels = ", ".join(f"'{x}'" for x in FUELS)
            out.append(_rule_sql(f"{f.name}_domain", f"{value} NOT IN ({labels})"))
    out.append(_rule_sql("capacity_positive", "capacity_mw <= 0"))
    out.append(_rule_sql("latitude_range", "latitude < -90 OR latitude > 90"))
    out.append(_rule_sql("longitude_range", "longitude < -180 OR longitude > 180"))
    return with_views(" UNION ALL ".join(out), TYPED_CTE)


@query("contract_checks", _contract_sql())
def contract_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.violation_counts(_typed(spark, sf_dir), PLANTS)


_METHOD = "CASE WHEN power_plant_id % 7 = 0 THEN repeat('M', 51) ELSE 'CAPACITY-FACTOR-V1' END"
_SOURCE = "CASE WHEN power_plant_id % 11 = 0 THEN repeat('s', 201) ELSE 'orders' END"
_SHIFTED = "year + CASE power_plant_id % 13 WHEN 0 THEN 15 WHEN 1 THEN -14 ELSE 0 END"
_NULLED = "CASE WHEN power_plant_id % 17 <> 0 THEN power_plant_id END"


@query(
    "generation_checks",
    with_views(
        f"""SELECT 'power_plant_id_required' AS rule, count(*) FILTER (WHERE {_NULLED} IS NULL) AS n_rows FROM generation
        UNION ALL SELECT 'year_required', 0
        UNION ALL SELECT 'estimation_method_max_50', count(*) FILTER (WHERE length({_METHOD}) > 50) FROM generation
        UNION ALL SELECT 'data_source_max_200', count(*) FILTER (WHERE length({_SOURCE}) > 200) FROM generation
        UNION ALL SELECT 'year_range', count(*) FILTER (WHERE {_SHIFTED} NOT BETWEEN 2000 AND 2030) FROM generation""",
        GENERATION_CTE,
    ),
)
def generation_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows breaking each rule of the generation table, with dirt added by rule."""
    dirty = standin.generation(spark, sf_dir).selectExpr(
        f"{_NULLED} AS power_plant_id", f"{_SHIFTED} AS year", f"{_METHOD} AS estimation_method", f"{_SOURCE} AS data_source"
    )
    return checks.violation_counts(dirty, GENERATION)


@query(
    "contract_tables",
    with_views(
        """SELECT 'power_plants' AS table_name, count(*) AS n_rows FROM plants WHERE capacity_mw > 0
        UNION ALL SELECT 'power_plant_generation', count(*) FROM generation
        UNION ALL SELECT 'tables after the drop', 0""",
        PLANTS_CTE,
        GENERATION_CTE,
    ),
)
def contract_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create both tables, load them, count what they hold, and drop them."""
    database = f"contract_{uuid.uuid4().hex[:12]}"
    rows = {
        PLANTS.name: (PLANTS, standin.plants(spark, sf_dir).where("capacity_mw > 0")),
        GENERATION.name: (GENERATION, standin.generation(spark, sf_dir).withColumn("id", F.monotonically_increasing_id())),
    }
    create_tables(spark, database)
    counts = {}
    for name, (contract, df) in rows.items():
        known = [col(f.name).cast(f.type) if f.name in df.columns else F.lit(None).cast(f.type) for f in contract.fields]
        named = df.select(*[c.alias(f.name) for c, f in zip(known, contract.fields)])
        stored = spark.table(f"{database}.{name}").columns
        named.select(*[col(c) for c in stored]).write.insertInto(f"{database}.{name}")
        counts[name] = spark.table(f"{database}.{name}").count()
    drop_tables(spark, database)
    counts["tables after the drop"] = len(spark.catalog.listTables(database))
    spark.sql(f"DROP DATABASE `{database}`")
    return spark.createDataFrame(list(counts.items()), "table_name string, n_rows bigint")


@query(
    "contract_quarantine",
    with_views(
        """SELECT gppd_idnr, CAST(capacity_mw AS DOUBLE) AS capacity_mw, 'capacity_positive' AS broken_rules
        FROM tagged WHERE reject_reason IS NULL AND capacity_mw <= 0""",
        TYPED_CTE,
    ),
)
def contract_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows that break a rule of the table, with the rules' names."""
    _, broken = checks.split_valid(reshape.valid_plants(_typed(spark, sf_dir)), PLANTS)
    rules = F.concat_ws(",", checks.VIOLATIONS).alias("broken_rules")
    return plain(broken.select("gppd_idnr", "capacity_mw", rules))


def _profile_sql() -> str:
    present = "id gppd_idnr name country_code country capacity_mw latitude longitude primary_fuel commissioning_year owner"
    fields = [f for f in PLANTS.fields if f.name in present.split()]
    return with_views(
        " UNION ALL ".join(
            f"""SELECT '{f.name}' AS column_name, '{f.type}' AS column_type, {str(f.required).lower()} AS required,
            count(*) FILTER (WHERE {f.name} IS NULL) AS n_null,
            CAST(max(length(CAST({f.name} AS VARCHAR))) AS BIGINT) AS max_length FROM plants"""
            for f in fields
        ),
        PLANTS_CTE,
    )


@query("contract_schema", _profile_sql())
def contract_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's columns as the contract declares them, with what they hold."""
    return checks.column_profile(standin.plants(spark, sf_dir), PLANTS)


@query(
    "unique_violations",
    with_views(
        """SELECT power_plant_id, year, count(*) AS n_rows FROM order_figures
        GROUP BY power_plant_id, year HAVING count(*) > 1""",
        FIGURES_CTE,
    ),
)
def unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.unique_violations(standin.order_figures(spark, sf_dir), GENERATION.unique[0])


@query(
    "fk_violations",
    with_views(
        """SELECT gppd_idnr, count(*) AS n_rows FROM (
          SELECT 'Customer#' || lpad(CAST(power_plant_id AS VARCHAR), 9, '0') AS gppd_idnr FROM order_figures)
        WHERE gppd_idnr NOT IN (SELECT gppd_idnr FROM tagged WHERE reject_reason IS NULL) GROUP BY gppd_idnr""",
        FIGURES_CTE,
        TYPED_CTE,
    ),
)
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures whose plant was rejected, by natural key."""
    children = _with_natural_key(standin.order_figures(spark, sf_dir))
    return keys.orphans(children, reshape.valid_plants(_typed(spark, sf_dir)), "gppd_idnr", "gppd_idnr")


# -- keys ------------------------------------------------------------------------


def _with_natural_key(figures: DataFrame) -> DataFrame:
    return figures.withColumn(
        "gppd_idnr", F.expr("concat('Customer#', lpad(CAST(power_plant_id AS string), 9, '0'))")
    )


def _loadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plants that keep the capacity rule; the others cannot be parents."""
    return standin.plants(spark, sf_dir).where("capacity_mw > 0")


@query(
    "surrogate_key",
    """SELECT row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderkey) AS id, o_custkey, o_orderkey
    FROM orders""",
)
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = standin.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return keys.surrogate_key(orders, ["o_custkey", "o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "order_nulls",
    with_views(
        """SELECT id, commissioning_year,
          row_number() OVER (ORDER BY commissioning_year DESC NULLS FIRST, id ASC) AS position FROM plants""",
        PLANTS_CTE,
    ),
)
def order_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every plant with its position in a descending sort: missing years come first."""
    rows = standin.plants(spark, sf_dir).select("id", "commissioning_year")
    ordering = [order("commissioning_year", descending=True), order("id")]
    return keys.surrogate_key(rows, ordering, name="position")


@query(
    "gen_key_resolve",
    with_views(
        """SELECT f.id, f.power_plant_id, f.year, CAST(f.generation_gwh AS DOUBLE) AS generation_gwh
        FROM order_figures f JOIN plants p ON p.id = f.power_plant_id WHERE p.capacity_mw > 0""",
        FIGURES_CTE,
        PLANTS_CTE,
    ),
)
def gen_key_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    children = _with_natural_key(standin.order_figures(spark, sf_dir)).select(
        "id", "gppd_idnr", "year", "generation_gwh"
    )
    parents = _loadable(spark, sf_dir).withColumnRenamed("id", "plant_id")
    resolved = keys.resolve_keys(children, parents, "gppd_idnr", "plant_id", "power_plant_id")
    return plain(resolved)


@query(
    "gen_orphans",
    with_views(
        """SELECT power_plant_id, count(*) AS n_rows FROM order_figures
        WHERE power_plant_id NOT IN (SELECT id FROM plants WHERE capacity_mw > 0) GROUP BY power_plant_id""",
        FIGURES_CTE,
        PLANTS_CTE,
    ),
)
def gen_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.orphans(standin.order_figures(spark, sf_dir), _loadable(spark, sf_dir), "power_plant_id", "id")


@query(
    "cascade_delete",
    with_views(
        """SELECT id, power_plant_id, year FROM order_figures
        WHERE power_plant_id NOT IN (SELECT id FROM plants WHERE capacity_mw <= 0)""",
        FIGURES_CTE,
        PLANTS_CTE,
    ),
)
def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    children = standin.order_figures(spark, sf_dir).select("id", "power_plant_id", "year")
    deleted = standin.plants(spark, sf_dir).where("capacity_mw <= 0")
    return keys.cascade_delete(children, deleted, "power_plant_id", "id")


# -- loads -----------------------------------------------------------------------


@query(
    "load_append",
    with_views(
        """SELECT gppd_idnr, CAST(capacity_mw AS DOUBLE) AS capacity_mw, primary_fuel
        FROM tagged WHERE reject_reason IS NULL""",
        TYPED_CTE,
    ),
)
def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load twice; the second run finds every key present."""
    path = new_path(spark, "plants")
    rows = reshape.valid_plants(_typed(spark, sf_dir))
    columns = ["gppd_idnr", "capacity_mw", "primary_fuel"]
    schema = rows.select(*columns).schema
    tables.ensure_table(spark, path, schema)
    for _ in range(2):
        new = tables.not_yet_loaded(rows, tables.read_table(spark, path, schema), ["gppd_idnr"])
        tables.append(new, path, columns, partition_by=["primary_fuel"])
    return plain(tables.read_table(spark, path, schema))


@query(
    "audit_stamp",
    with_views(
        """SELECT id, coalesce(owner, 'State') AS owner, owner IS NULL AS changed,
          '2020-01-01' AS created_on FROM plants""",
        PLANTS_CTE,
    ),
)
def audit_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plants without an owner get one; only they get a fresh change stamp."""
    loaded = F.lit("2020-01-01 00:00:00").cast("timestamp")
    existing = standin.plants(spark, sf_dir).select(
        "id", "owner", loaded.alias("created_at"), loaded.alias("updated_at")
    )
    changes = existing.where("owner IS NULL").select("id", F.lit("State").alias("owner"))
    after = tables.upsert(existing, changes, "id")
    return after.selectExpr(
        "id", "owner", "updated_at > created_at AS changed", "date_format(created_at, 'yyyy-MM-dd') AS created_on"
    )


@query(
    "upsert_versioned",
    with_views(
        """SELECT gppd_idnr, coalesce(owner, 'State') AS owner, CASE WHEN id % 10 = 0 THEN 'new'
          WHEN owner IS NULL THEN 'changed' ELSE 'as it was' END AS fate, CAST(capacity_mw AS DOUBLE) AS capacity_mw FROM plants""",
        PLANTS_CTE,
    ),
)
def upsert_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in two versions: the second gives owners to plants without one, and adds plants."""
    store = Store(spark, new_path(spark, "store"))
    loaded = F.lit("2020-01-01 00:00:00").cast("timestamp")
    names = ["id", "gppd_idnr", "owner", "capacity_mw", "primary_fuel"]
    rows = standin.plants(spark, sf_dir).select(*names, loaded.alias("created_at"), loaded.alias("updated_at"))
    key, parts = ["gppd_idnr"], ["primary_fuel"]
    first, _ = store.added("plants", Table(), rows.where("id % 10 <> 0"), rows.schema, key, parts)
    base = store.commit(Version(), {"plants": first})
    named = rows.where("owner IS NULL OR id % 10 = 0").withColumn("owner", F.coalesce("owner", F.lit("State")))
    second, _ = store.upserted("plants", base.table("plants"), named.drop("id"), rows.schema, key, parts)
    store.commit(base, {"plants": second})
    fate = """CASE WHEN created_at > TIMESTAMP'2020-01-01 00:00:00' THEN 'new'
        WHEN updated_at > created_at THEN 'changed' ELSE 'as it was' END AS fate"""
    after = store.read(store.version().table("plants"), rows.schema)
    return plain(after.selectExpr("gppd_idnr", "owner", fate, "capacity_mw"))


_GONE = "id % 11 = 0"
_AFTER_CTE = """after AS (
  SELECT id, country_code, country, primary_fuel, commissioning_year,
    capacity_mw + CASE WHEN id % 10 <> 0 AND id % 7 = 0 THEN 1 ELSE 0 END AS capacity_mw
  FROM plants WHERE id % 11 <> 0)"""


@query(
    "stats_incremental",
    with_views(
        """SELECT country_code, country, count(*) AS plant_count, CAST(sum(capacity_mw) AS DOUBLE) AS total_capacity_mw,
          CAST(sum(capacity_mw) AS DOUBLE) / 1000 AS total_capacity_gw,
          CAST(sum(capacity_mw) AS DOUBLE) / count(capacity_mw) AS avg_capacity_mw, count(DISTINCT primary_fuel) AS fuel_diversity,
          CAST((SELECT max(capacity_mw) FROM after) AS DOUBLE) AS max_capacity_mw,
          (SELECT min(commissioning_year) FROM after) AS oldest_plant_year
        FROM after GROUP BY country_code, country""",
        PLANTS_CTE,
        _AFTER_CTE,
    ),
)
def stats_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports from cells kept through a load, corrections, more rows and deletes."""
    store, key = Store(spark, new_path(spark, "store")), ["gppd_idnr"]
    names = ["id", "gppd_idnr", "country_code", "country", "primary_fuel", "commissioning_year", "capacity_mw"]
    rows = standin.plants(spark, sf_dir).select(*names)
    first, _ = store.added("plants", Table(), rows.where("id % 10 <> 0"), rows.schema, key)
    base = store.commit(Version(), {"plants": first})
    cells = materialize(running.cells_of(store.read(first, rows.schema)), "cells")
    raised = F.col("capacity_mw") + F.when(F.expr("id % 10 <> 0"), 1).otherwise(0)
    changed = rows.where("id % 10 = 0 OR id % 7 = 0").withColumn("capacity_mw", raised.cast("decimal(12,2)"))
    second, _ = store.upserted("plants", first, changed.drop("id"), rows.schema, key)
    gone = store.lookup(second, rows.where(_GONE), key)
    third, _ = store.deleted("plants", second, gone)
    for before, after in ((first, second), (second, third)):
        added, removed = store.changes(before, after, rows.schema)
        cells = running.updated_cells(cells, added, removed, store.read(after, rows.schema))
    store.commit(base, {"plants": third})
    total = stats.summary_of(running.regrouped(cells, "country_code", "primary_fuel"))
    countries = stats.countries_of(running.regrouped(cells, "country_code", "country", "primary_fuel"))
    # One row beside each country.
    most, oldest = total.select("max_capacity_mw", "oldest_plant_year").first()
    return countries.select("*", F.lit(most).alias("max_capacity_mw"), F.lit(oldest).alias("oldest_plant_year"))


@query(
    "cascade_delete_vectors",
    with_views(
        """SELECT id, power_plant_id, year FROM order_figures
        WHERE power_plant_id NOT IN (SELECT id FROM plants WHERE capacity_mw <= 0)""",
        FIGURES_CTE,
        PLANTS_CTE,
    ),
)
def cascade_delete_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plants and their figures deleted together in a version, without writing a file of either anew."""
    store = Store(spark, new_path(spark, "store"))
    figures = standin.order_figures(spark, sf_dir).select("id", "power_plant_id", "year")
    plants = standin.plants(spark, sf_dir).select("id", "gppd_idnr", "capacity_mw")
    children, _ = store.added("figures", Table(), figures, figures.schema, ["id"])
    parents, _ = store.added("plants", Table(), plants, plants.schema, ["gppd_idnr"])
    base = store.commit(Version(), {"figures": children, "plants": parents})
    gone = store.read(parents, plants.schema, with_file=True).where("capacity_mw <= 0")
    held = store.read(children, figures.select("power_plant_id").schema, with_file=True)
    orphaned = held.join(gone.select(col("id").alias("power_plant_id")), "power_plant_id", "left_semi")
    parents_left, _ = store.deleted("plants", parents, gone)
    children_left, _ = store.deleted("figures", children, orphaned)
    store.commit(base, {"figures": children_left, "plants": parents_left})
    return store.read(store.version().table("figures"), figures.schema)


@query(
    "nan_to_null",
    "SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN p_retailprice END AS price FROM part",
)
def nan_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not-a-number becomes null before a table is written."""
    price = F.when(F.expr("p_partkey % 3 = 0"), F.lit(float("nan"))).otherwise(F.col("p_retailprice"))
    rows = standin.table(spark, sf_dir, "part").select("p_partkey", price.alias("price"))
    return materialize(clean.nan_to_null(rows), "prices")


@query("empty_load", "SELECT 0::BIGINT AS loaded, count(*) AS n_rows, 1::BIGINT AS versions FROM part")
def empty_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load without rows leaves a table and its version as they were."""
    store = Store(spark, new_path(spark, "store"))
    part = standin.table(spark, sf_dir, "part").select(col("p_partkey").alias("id"), "p_name")
    first, _ = store.added("part", Table(), part, part.schema, ["id"])
    base = store.commit(Version(), {"part": first})
    after, loaded = store.added("part", first, part.limit(0), part.schema, ["id"])
    if after != base.table("part"):
        store.commit(base, {"part": after})
    n = store.read(after, part.schema).count()
    return spark.createDataFrame([(loaded, n, len(store.numbers()))], "loaded bigint, n_rows bigint, versions bigint")


def _fan_out(spark: SparkSession, sf_dir: str) -> tuple[Pipeline, dict[str, str]]:
    paths = {name: new_path(spark, name) for name in ("plants", "rejects")}

    def loader(name: str):
        return lambda df: df.write.parquet(paths[name])

    pipeline = Pipeline(
        spark,
        extract=lambda s: null_tokens(standin.raw_plants(s, sf_dir)),
        transforms={
            "plants": lambda raw: reshape.valid_plants(reshape.plants_transform(raw)),
            "rejects": lambda raw: reshape.with_reject_reason(reshape.plants_transform(raw)).where(
                "reject_reason IS NOT NULL"
            ),
        },
        loaders={name: loader(name) for name in paths},
        rejects={"rejects"},
    )
    return pipeline, paths


@query(
    "fan_out",
    with_views(
        """SELECT gppd_idnr, CASE WHEN reject_reason IS NULL THEN 'plants' ELSE 'rejects' END AS output,
          reject_reason FROM tagged""",
        TYPED_CTE,
    ),
)
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source, two outputs, each with its own writer; read back from what was written."""
    pipeline, paths = _fan_out(spark, sf_dir)
    pipeline.run()
    plants = spark.read.parquet(paths["plants"]).select(
        "gppd_idnr", F.lit("plants").alias("output"), F.lit(None).cast("string").alias("reject_reason")
    )
    rejects = spark.read.parquet(paths["rejects"]).select(
        "gppd_idnr", F.lit("rejects").alias("output"), "reject_reason"
    )
    return plants.unionByName(rejects)


def _metrics_sql(loaded: str) -> str:
    counts = {
        "extracted": "count(*)",
        "transformed": "count(*)",
        "loaded": loaded,
        "errors": "count(*) FILTER (WHERE reject_reason IS NOT NULL)",
        "plants": "count(*) FILTER (WHERE reject_reason IS NULL)",
        "rejects": "count(*) FILTER (WHERE reject_reason IS NOT NULL)",
    }
    return with_views(
        " UNION ALL ".join(f"SELECT '{k}' AS metric, {v} AS n FROM tagged" for k, v in counts.items()), TYPED_CTE
    )


def _metrics(spark: SparkSession, stats: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(stats.items()), "metric string, n bigint")


@query("run_metrics", _metrics_sql("count(*)"))
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, _fan_out(spark, sf_dir)[0].run())


@query("dry_run_metrics", _metrics_sql("count(*) FILTER (WHERE false)"))
def dry_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, _fan_out(spark, sf_dir)[0].run(dry_run=True))


_MIGRATION_SQL = with_views(
    f"""SELECT row_number() OVER (ORDER BY t.gppd_idnr) AS plant_id, t.gppd_idnr, g.n_years, g.reported, g.estimated
    FROM tagged t LEFT JOIN (
      SELECT gppd_idnr, count(*) AS n_years, CAST(sum(CAST(generation_gwh AS DECIMAL(12,2))) AS DOUBLE) AS reported,
        CAST(sum(CAST(estimated_generation_gwh AS DECIMAL(12,2))) AS DOUBLE) AS estimated
      FROM (SELECT *, c_name AS gppd_idnr FROM generation JOIN customer ON c_custkey = power_plant_id)
      GROUP BY gppd_idnr) g ON g.gppd_idnr = t.gppd_idnr
    WHERE t.reject_reason IS NULL AND t.capacity_mw > 0""",
    TYPED_CTE,
    GENERATION_CTE,
)


def _loaded(job: Migration) -> DataFrame:
    """What a migration left in its two tables, one row per plant."""
    per_plant = (
        job.table(GENERATION)
        .groupBy("power_plant_id")
        .agg(
            F.count(F.lit(1)).alias("n_years"),
            F.sum("generation_gwh").alias("reported"),
            F.sum("estimated_generation_gwh").alias("estimated"),
        )
    )
    plants = job.table(PLANTS).select(col("id").alias("plant_id"), "gppd_idnr")
    joined = plants.join(per_plant, col("plant_id") == col("power_plant_id"), "left")
    return plain(joined.drop("power_plant_id"))


@query("migration", _MIGRATION_SQL)
def migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: wide text files in, two linked tables out, read back per plant."""
    source = new_path(spark, "wide-csv")
    files.write_csv(standin.raw_wide(spark, sf_dir), source)
    job = Migration(spark, source, new_path(spark, "tables"))
    job.run()
    return _loaded(job)


@query(
    "migration_update",
    with_views(
        """SELECT row_number() OVER (ORDER BY gppd_idnr) AS plant_id, gppd_idnr,
          CASE WHEN gppd_idnr LIKE '%3' THEN 'new owner' ELSE owner END AS owner, gppd_idnr LIKE '%3' AS changed FROM tagged
        WHERE reject_reason IS NULL AND capacity_mw > 0""",
        TYPED_CTE,
    ),
)
def migration_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed rows of a second delivery replace the loaded ones under their old ids."""
    job, _ = _redelivery(spark, sf_dir, update=True)
    return job.table(PLANTS).selectExpr("id AS plant_id", "gppd_idnr", "owner", "updated_at > created_at AS changed")


@query("migration_incremental", _MIGRATION_SQL)
def migration_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files arriving twice in a landing folder: streamed to staging, then loaded."""
    landing, staging, checkpoint, target = (
        new_path(spark, n) for n in ("landing", "staging", "checkpoint", "tables")
    )
    wide = materialize(standin.raw_wide(spark, sf_dir), "wide")
    schema = text_schema(wide.columns)
    for _ in range(2):
        wide.write.mode("append").options(header="true", quote='"', escape='"').csv(landing)
        batches = ingest_available(spark, landing, schema, staging, checkpoint)
        job = Migration(spark, staged_batches(spark, staging, schema, batches), target)
        job.run()
    return _loaded(job)


@query(
    "migration_bulk",
    f"""SELECT year, count(*) AS plants_with_data,
      CAST(sum(coalesce(reported, estimated)) AS DOUBLE) AS total_generation_gwh,
      CAST(sum(coalesce(reported, estimated)) AS DOUBLE) / 1000 AS total_generation_twh
    FROM (
      SELECT l_orderkey, CAST(year(l_shipdate) + {standin.YEAR_SHIFT} AS INTEGER) AS year,
        sum(CAST(l_extendedprice AS DECIMAL(12,2))) FILTER (WHERE l_returnflag <> 'N') AS reported,
        sum(CAST(l_extendedprice AS DECIMAL(12,2))) FILTER (WHERE l_returnflag = 'N') AS estimated
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2)
    WHERE reported IS NOT NULL OR estimated IS NOT NULL GROUP BY year""",
)
def migration_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job over the two large tables; yearly totals of what was loaded."""
    source = new_path(spark, "bulk-csv")
    files.write_csv(standin.raw_wide_orders(spark, sf_dir), source)
    job = Migration(spark, source, new_path(spark, "tables"))
    job.run()
    return stats.generation_trends(job.table(GENERATION))


_DELIVERED = """delivered AS (
  SELECT gppd_idnr, capacity_mw, CASE WHEN reject_reason IS NULL AND capacity_mw > 0 THEN 'good'
    WHEN reject_reason IS NULL THEN 'broken' ELSE 'error' END AS fate FROM tagged)"""


def _redelivery(spark: SparkSession, sf_dir: str, update: bool = False) -> tuple[Migration, list[dict[str, int]]]:
    """A delivery, and a second one: as it was, with other owners, and every row twice."""
    wide = materialize(standin.raw_wide(spark, sf_dir), "wide")
    every = wide.select([c for c in wide.columns if c != "owner"] + ["owner"])
    changed = every.withColumn("owner", F.when(F.col("gppd_idnr").endswith("3"), F.lit("new owner")).otherwise(F.col("owner")))
    target, counts = new_path(spark, "tables"), []
    for rows in (every, changed.union(changed)):
        job = Migration(spark, rows, target, update=update)
        counts.append(job.run())
    return job, counts


@query(
    "migration_changed",
    with_views(
        """SELECT gppd_idnr, 'new owner' AS owner FROM tagged
        WHERE reject_reason IS NULL AND capacity_mw > 0 AND gppd_idnr LIKE '%3'""",
        TYPED_CTE,
    ),
)
def migration_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a second delivery that differ from what is loaded: reported, not dropped."""
    job, _ = _redelivery(spark, sf_dir)
    return spark.read.parquet(job.path("quarantine/changed")).select("gppd_idnr", "owner")


@query(
    "migration_accounting",
    with_views(
        """SELECT 'plants_extracted' AS metric, 2 * count(*) AS n FROM delivered
        UNION ALL SELECT 'errors', 2 * count(*) FILTER (WHERE fate = 'error') FROM delivered
        UNION ALL SELECT 'broken', 2 * count(*) FILTER (WHERE fate = 'broken') FROM delivered
        UNION ALL SELECT 'plants_merged', count(*) FILTER (WHERE fate = 'good') FROM delivered
        UNION ALL SELECT 'plants_changed', count(*) FILTER (WHERE fate = 'good' AND gppd_idnr LIKE '%3') FROM delivered
        UNION ALL SELECT 'plants_known', count(*) FILTER (WHERE fate = 'good' AND gppd_idnr NOT LIKE '%3') FROM delivered
        UNION ALL SELECT 'figures_extracted', 2 * count(*) FROM generation
        UNION ALL SELECT 'figures_orphaned', 2 * count(*) FILTER (WHERE fate <> 'good')
          FROM generation JOIN customer ON c_custkey = power_plant_id JOIN delivered ON gppd_idnr = c_name
        UNION ALL SELECT 'figures_known', count(*) FILTER (WHERE fate = 'good')
          FROM generation JOIN customer ON c_custkey = power_plant_id JOIN delivered ON gppd_idnr = c_name""",
        TYPED_CTE,
        _DELIVERED,
        GENERATION_CTE,
    ),
)
def migration_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the second delivery, which add up to what it held."""
    _, counts = _redelivery(spark, sf_dir)
    shown = (
        "plants_extracted errors broken plants_merged plants_changed plants_known figures_extracted "
        "figures_orphaned figures_known"
    ).split()
    return _metrics(spark, {k: counts[1][k] for k in shown})


@query(
    "migration_copies",
    with_views(
        """SELECT t.gppd_idnr, CAST(2 AS BIGINT) AS copies, g.year, CAST(g.generation_gwh AS DOUBLE) AS kept,
          CAST(g.generation_gwh + 1 AS DOUBLE) AS lost
        FROM tagged t JOIN customer ON c_name = t.gppd_idnr JOIN generation g ON g.power_plant_id = customer.c_custkey
        WHERE t.reject_reason IS NULL AND t.capacity_mw > 0 AND g.generation_gwh IS NOT NULL""",
        TYPED_CTE,
        GENERATION_CTE,
    ),
)
def migration_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row delivered twice, the copy with other reported figures: one wins, one is kept aside."""
    wide = materialize(standin.raw_wide(spark, sf_dir), "wide")
    names = [c for c in wide.columns if c.startswith("generation_gwh_")]
    copy = wide.withColumns({c: (col(c).cast("decimal(12,2)") + 1).cast("string") for c in names})
    job = Migration(spark, wide.union(copy.select(wide.columns)), new_path(spark, "tables"))
    job.run()
    lost = spark.read.parquet(job.path("quarantine/figure_conflicts"))
    copies = spark.read.parquet(job.path("quarantine/copies")).select("gppd_idnr", "copies")
    plants = job.table(PLANTS).select(col("id").alias("power_plant_id"), "gppd_idnr")
    loaded = job.table(GENERATION).select("power_plant_id", "year", col("generation_gwh").alias("kept"))
    pairs = loaded.join(lost.select("power_plant_id", "year", col("generation_gwh").alias("lost")), ["power_plant_id", "year"])
    named = pairs.join(plants, "power_plant_id").join(copies, "gppd_idnr")
    return plain(named.select("gppd_idnr", "copies", "year", "kept", "lost"))
