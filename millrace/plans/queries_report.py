"""Registered queries: lists, statistics, detail, geography and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import labels
from millrace.functions.clean import col
from millrace.functions.predicates import Condition, contains_text, has_all_tokens, where_all
from millrace.operators import keys, paging, proximity, stats, trigrams, wordlists
from millrace.operators.nearest import nearest_k
from millrace.operators.paging import LIST_COLUMNS, PlantFilter, order
from millrace.plans import standin
from millrace.plans.registry import plain, query
from millrace.plans.standin import GENERATION_CTE, PLANTS_CTE, with_views
from millrace.sources.versions import Store, Table
from millrace.sources.workspace import materialize, new_path

# -- statistics ------------------------------------------------------------------


@query(
    "stats_summary",
    with_views(
        """SELECT count(*) AS total_plants, CAST(sum(capacity_mw) AS DOUBLE) AS total_capacity_mw,
          CAST(sum(capacity_mw) AS DOUBLE) / 1000 AS total_capacity_gw,
          count(DISTINCT country_code) AS total_countries, count(DISTINCT primary_fuel) AS fuel_types,
          CAST(sum(capacity_mw) AS DOUBLE) / count(capacity_mw) AS avg_capacity_mw,
          CAST(max(capacity_mw) AS DOUBLE) AS max_capacity_mw,
          min(commissioning_year) AS oldest_plant_year, max(commissioning_year) AS newest_plant_year
        FROM plants""",
        PLANTS_CTE,
    ),
)
def stats_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.summary(standin.plants(spark, sf_dir))


@query(
    "stats_by_country",
    with_views(
        """SELECT country_code, country, count(*) AS plant_count,
          CAST(sum(capacity_mw) AS DOUBLE) AS total_capacity_mw,
          CAST(sum(capacity_mw) AS DOUBLE) / 1000 AS total_capacity_gw,
          CAST(sum(capacity_mw) AS DOUBLE) / count(capacity_mw) AS avg_capacity_mw,
          count(DISTINCT primary_fuel) AS fuel_diversity
        FROM plants GROUP BY country_code, country
        ORDER BY total_capacity_mw DESC, country_code LIMIT 20""",
        PLANTS_CTE,
    ),
)
def stats_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.by_country(standin.plants(spark, sf_dir))


_BY_FUEL = """SELECT primary_fuel AS fuel, count(*) AS plant_count,
    CAST(sum(capacity_mw) AS DOUBLE) AS total_capacity_mw,
    CAST(sum(capacity_mw) AS DOUBLE) / 1000 AS total_capacity_gw,
    CAST(sum(capacity_mw) AS DOUBLE) / count(capacity_mw) AS avg_capacity_mw,
    count(DISTINCT country_code) AS country_count
  FROM plants GROUP BY primary_fuel"""


@query("stats_by_fuel", with_views(_BY_FUEL, PLANTS_CTE))
def stats_by_fuel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.by_fuel(standin.plants(spark, sf_dir))


@query(
    "stats_fuel_share",
    with_views(
        f"""SELECT *, CAST(CAST(total_capacity_mw / sum(total_capacity_mw) OVER () * 100 AS DECIMAL(24,2)) AS VARCHAR)
        AS percentage_of_total FROM ({_BY_FUEL})""",
        PLANTS_CTE,
    ),
)
def stats_fuel_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.fuel_share(standin.plants(spark, sf_dir))


@query(
    "stats_fuel_total",
    with_views("SELECT CAST(sum(capacity_mw) AS DOUBLE) AS total_capacity_mw FROM plants", PLANTS_CTE),
)
def stats_fuel_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.fuel_total(standin.plants(spark, sf_dir))


@query(
    "top_fuels",
    with_views(
        f"""SELECT fuel, total_capacity_gw,
          CAST(CAST(total_capacity_gw / sum(total_capacity_gw) OVER () * 100 AS DECIMAL(24,0)) AS VARCHAR)
            AS percent_of_shown
        FROM (SELECT fuel, total_capacity_gw FROM ({_BY_FUEL}) ORDER BY total_capacity_gw DESC, fuel LIMIT 8)""",
        PLANTS_CTE,
    ),
)
def top_fuels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.top_fuels(standin.plants(spark, sf_dir))


@query(
    "generation_trends",
    with_views(
        """SELECT year, count(*) AS plants_with_data,
          coalesce(CAST(sum(coalesce(generation_gwh, estimated_generation_gwh)) AS DOUBLE), 0.0)
            AS total_generation_gwh,
          coalesce(CAST(sum(coalesce(generation_gwh, estimated_generation_gwh)) AS DOUBLE), 0.0) / 1000
            AS total_generation_twh
        FROM generation GROUP BY year""",
        GENERATION_CTE,
    ),
)
def generation_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.generation_trends(standin.generation(spark, sf_dir))


@query(
    "validate_counts",
    with_views(
        """SELECT 'power_plants' AS "check", count(*) AS n_rows FROM plants
        UNION ALL SELECT 'countries', count(DISTINCT country_code) FROM plants
        UNION ALL SELECT 'generation_records', count(*) FROM generation""",
        PLANTS_CTE,
        GENERATION_CTE,
    ),
)
def validate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.validate_counts(standin.plants(spark, sf_dir), standin.generation(spark, sf_dir))


@query(
    "validate_fuel_breakdown",
    with_views(
        """SELECT primary_fuel AS fuel, count(*) AS plant_count, CAST(sum(capacity_mw) AS DOUBLE) AS total_mw
        FROM plants GROUP BY primary_fuel""",
        PLANTS_CTE,
    ),
)
def validate_fuel_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.validate_fuel_breakdown(standin.plants(spark, sf_dir))


@query(
    "quality_profile",
    with_views(
        """SELECT *, CAST(n AS DOUBLE) / nullif(out_of, 0) AS rate FROM (
          SELECT 'commissioning_year_missing' AS measure,
            count(*) FILTER (WHERE commissioning_year IS NULL) AS n, count(*) AS out_of FROM plants
          UNION ALL SELECT 'plants_with_reported_generation',
            count(*) FILTER (WHERE id IN (SELECT power_plant_id FROM generation WHERE generation_gwh IS NOT NULL)),
            count(*) FROM plants
          UNION ALL SELECT 'generation_estimated', count(*) FILTER (WHERE generation_gwh IS NULL), count(*)
            FROM generation)""",
        PLANTS_CTE,
        GENERATION_CTE,
    ),
)
def quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.quality_profile(standin.plants(spark, sf_dir), standin.generation(spark, sf_dir))


# -- lists -----------------------------------------------------------------------

_LIST = """id, gppd_idnr, name, country_code, country, CAST(capacity_mw AS DOUBLE) AS capacity_mw,
  CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, primary_fuel,
  commissioning_year, owner"""
_FILTER = PlantFilter(country="n07", fuel="Solar", min_capacity=500, max_capacity=9000, search="HOUSE%1")
_FILTER_SQL = """country_code = 'N07' AND primary_fuel = 'Solar' AND capacity_mw >= 500 AND capacity_mw <= 9000
  AND name ILIKE '%HOUSE%1%'"""


@query("list_filtered", with_views(f"SELECT {_LIST} FROM plants WHERE {_FILTER_SQL}", PLANTS_CTE))
def list_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All optional filters at once."""
    matching = standin.plants(spark, sf_dir).where(_FILTER.predicate())
    return plain(matching.select(*LIST_COLUMNS))


@query(
    "list_capacity_range",
    with_views(f"SELECT {_LIST} FROM plants WHERE capacity_mw BETWEEN 2500 AND 5000", PLANTS_CTE),
)
def list_capacity_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = PlantFilter(min_capacity=2500, max_capacity=5000)
    return plain(standin.plants(spark, sf_dir).where(bounds.predicate()).select(*LIST_COLUMNS))


@query("list_total", with_views("SELECT count(*) AS total FROM plants WHERE capacity_mw >= 1000", PLANTS_CTE))
def list_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = PlantFilter(min_capacity=1000)
    return paging.total(standin.plants(spark, sf_dir).where(large.predicate()))


@query(
    "list_page",
    with_views(
        f"SELECT {_LIST} FROM plants WHERE capacity_mw >= 1000 ORDER BY capacity_mw DESC, id LIMIT 20 OFFSET 40",
        PLANTS_CTE,
    ),
)
def list_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = PlantFilter(min_capacity=1000)
    matching = standin.plants(spark, sf_dir).where(large.predicate())
    return plain(paging.list_page(matching, page=3, limit=20))


@query(
    "list_page_deep",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate
    LIMIT 100 OFFSET 30000""",
)
def list_page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page far from the start, found by counting ranges instead of by a growing top-k."""
    names = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    rows = standin.table(spark, sf_dir, "lineitem").select(*names, "l_shipdate")
    ties = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    ordering = [("l_extendedprice", True), *[(c, False) for c in ties]]
    return paging.sorted_slice(rows, ordering, limit=100, offset=30_000).select(*names)


@query(
    "list_page_stored",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate
    LIMIT 100 OFFSET 30000""",
)
def list_page_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same page from the list that is kept with the table's version: its range is read, nothing is counted."""
    names = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    ties = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    store, rows = Store(spark, new_path(spark, "store")), standin.table(spark, sf_dir, "lineitem").select(*names, "l_shipdate")
    folder, _, _ = store.write("lineitem", rows, rows.columns)
    table = store.listed("lineitem", Table([folder]), rows.schema, "price", [("l_extendedprice", True), *[(c, False) for c in ties]])
    version = store.commit(store.version(), {"lineitem": table})
    return store.page(version.table("lineitem"), "price", limit=100, offset=30_000).select(*names)


@query(
    "page_meta",
    with_views(
        """SELECT 3 AS page, 20 AS page_size, count(*) AS total, CAST(ceil(count(*) / 20.0) AS BIGINT) AS total_pages,
          CAST(41 AS BIGINT) AS first_shown, least(CAST(60 AS BIGINT), count(*)) AS last_shown
        FROM plants WHERE capacity_mw >= 1000""",
        PLANTS_CTE,
    ),
)
def page_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = PlantFilter(min_capacity=1000)
    return paging.page_meta(standin.plants(spark, sf_dir).where(large.predicate()), page=3, limit=20)


_TOP = """id, name, country, country_code, CAST(capacity_mw AS DOUBLE) AS capacity_mw, primary_fuel,
  commissioning_year, CAST(row_number() OVER (ORDER BY capacity_mw DESC, id) AS INTEGER) AS rank"""


@query(
    "top_plants",
    with_views(f"SELECT {_TOP} FROM plants ORDER BY rank LIMIT 10", PLANTS_CTE),
)
def top_plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(paging.top_plants(standin.plants(spark, sf_dir)))


@query(
    "top_plants_by_fuel",
    with_views(f"SELECT {_TOP} FROM plants WHERE primary_fuel = 'Hydro' ORDER BY rank LIMIT 100", PLANTS_CTE),
)
def top_plants_by_fuel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A size above the maximum is cut to 100."""
    return plain(paging.top_plants(standin.plants(spark, sf_dir), limit=250, fuel="Hydro"))


# -- predicates and sorting ------------------------------------------------------

_ORDER = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"
_ORDER_NAMES = _ORDER.split(", ")


def _orders_where(spark: SparkSession, sf_dir: str, *conditions: Condition) -> DataFrame:
    return paging.select_query(standin.table(spark, sf_dir, "orders"), _ORDER_NAMES, conditions)


@query("pred_eq", f"SELECT {_ORDER} FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F'")
def pred_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_where(
        spark, sf_dir, Condition("o_orderpriority", "=", "2-HIGH"), Condition("o_orderstatus", "=", "F")
    )


@query("pred_ne", f"SELECT {_ORDER} FROM orders WHERE o_orderstatus != 'P' AND o_orderpriority != '5-LOW'")
def pred_ne(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_where(
        spark, sf_dir, Condition("o_orderstatus", "!=", "P"), Condition("o_orderpriority", "!=", "5-LOW")
    )


@query(
    "pred_cmp",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem
    WHERE l_quantity > 40 AND l_quantity <= 48 AND l_discount < 0.05 AND l_tax >= 0.06""",
)
def pred_cmp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.select_query(
        standin.table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"],
        [
            Condition("l_quantity", ">", 40.0),
            Condition("l_quantity", "<=", 48.0),
            Condition("l_discount", "<", 0.05),
            Condition("l_tax", ">=", 0.06),
        ],
    )


@query("pred_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 's%_ring'")
def pred_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = standin.table(spark, sf_dir, "part")
    return part.where(where_all([Condition("p_name", "LIKE", "s%_ring")])).select("p_partkey", "p_name")


@query("pred_ilike", "SELECT p_partkey, p_type FROM part WHERE p_type ILIKE '%om%'")
def pred_ilike(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = standin.table(spark, sf_dir, "part")
    return part.where(where_all([Condition("p_type", "ILIKE", "%om%")])).select("p_partkey", "p_type")


@query("pred_in", f"SELECT {_ORDER} FROM orders WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM')")
def pred_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_where(spark, sf_dir, Condition("o_orderpriority", "IN", ["1-URGENT", "3-MEDIUM"]))


@query("search_ilike", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RING%' AND p_retailprice >= 950")
def search_ilike(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = standin.table(spark, sf_dir, "part")
    return part.where(contains_text("p_name", "RING") & (col("p_retailprice") >= 950)).select("p_partkey", "p_name")


@query("search_trigram", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RING%' AND p_retailprice >= 950")
def search_trigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows through lists of character sequences."""
    part, path = standin.table(spark, sf_dir, "part"), new_path(spark, "trigrams")
    trigrams.build_trigrams(part, path, "p_partkey", "p_name")
    found = trigrams.search_text(part.where(col("p_retailprice") >= 950), path, "RING", "p_partkey", "p_name")
    return found.select("p_partkey", "p_name")


@query(
    "token_search",
    """SELECT p_partkey, p_name FROM part
    WHERE list_contains(string_split(lower(p_name), ' '), 'ring')
      AND list_contains(string_split(lower(p_name), ' '), 'small')""",
)
def token_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = standin.table(spark, sf_dir, "part")
    return part.where(has_all_tokens("p_name", "Small RING")).select("p_partkey", "p_name")


@query(
    "token_search_index",
    """SELECT p_partkey, p_name FROM part
    WHERE regexp_matches(lower(p_name), '(^|[^a-z])ring(s|ed|ing)?($|[^a-z])')
      AND regexp_matches(lower(p_name), '(^|[^a-z])small(s|ed|ing)?($|[^a-z])')""",
)
def token_search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole words in whatever inflection, through lists of the rows that hold a stem."""
    part, path = standin.table(spark, sf_dir, "part"), new_path(spark, "words")
    wordlists.build_words(part, path, "p_partkey", "p_name")
    return wordlists.search_words(part, path, "The small RINGS", "p_partkey").select("p_partkey", "p_name")


@query(
    "limit_offset",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 25 OFFSET 50""",
)
def limit_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    ties = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    ordering = [("l_extendedprice", False), *[(c, False) for c in ties]]
    rows = paging.limit_offset(standin.table(spark, sf_dir, "lineitem"), 25, 50, ordering)
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "offset_only",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderpriority, o_orderkey OFFSET 2500",
)
def offset_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything from a position on; the leading column has five values only."""
    ordering = [("o_orderpriority", False), ("o_orderkey", False)]
    rows = paging.limit_offset(standin.table(spark, sf_dir, "orders"), offset=2500, ordering=ordering)
    return rows.select("o_orderkey", "o_totalprice")


@query("offset_ties", "SELECT o_orderpriority FROM orders ORDER BY o_orderpriority OFFSET 2500")
def offset_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An offset among thousands of equal rows."""
    rows = standin.table(spark, sf_dir, "orders").select("o_orderpriority")
    return paging.limit_offset(rows, offset=2500, ordering=[("o_orderpriority", False)])


@query(
    "list_after",
    with_views(
        """SELECT id, commissioning_year, CAST(capacity_mw AS DOUBLE) AS capacity_mw FROM plants
        ORDER BY commissioning_year DESC NULLS FIRST, capacity_mw, id LIMIT 50 OFFSET 100""",
        PLANTS_CTE,
    ),
)
def list_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third page, each found behind the last row of the one before."""
    rows = standin.plants(spark, sf_dir).select("id", "commissioning_year", "capacity_mw")
    ordering = [("commissioning_year", True), ("capacity_mw", False), ("id", False)]
    after = None
    for _ in range(2):
        last = paging.list_after(rows, ordering, after, 50).collect()[-1]
        after = [last[name] for name, _ in ordering]
    return plain(paging.list_after(rows, ordering, after, 50))


@query(
    "select_query",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice < 400000
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 10""",
)
def select_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.select_query(
        standin.table(spark, sf_dir, "orders"),
        ["o_orderkey", "o_totalprice"],
        [Condition("o_orderstatus", "=", "O"), Condition("o_totalprice", "<", 400000.0)],
        order_by="o_totalprice",
        descending=True,
        limit=50,
        offset=10,
        tie_breaker=["o_orderkey"],
    )


# -- lookup and detail -----------------------------------------------------------


@query("plant_by_id", with_views(f"SELECT {_LIST} FROM plants WHERE id = 7", PLANTS_CTE))
def plant_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(keys.lookup(standin.plants(spark, sf_dir), "id", 7))


@query(
    "plants_by_ids",
    with_views(
        f"""SELECT {_LIST} FROM plants
        WHERE id IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
        PLANTS_CTE,
    ),
)
def plants_by_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch lookup: the plants that have an urgent order."""
    orders = standin.table(spark, sf_dir, "orders")
    wanted = orders.where(where_all([Condition("o_orderpriority", "=", "1-URGENT")])).select("o_custkey")
    return plain(keys.lookup_many(standin.plants(spark, sf_dir), "id", wanted))


@query("plant_detail")
def plant_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every plant with its yearly figures as a sorted array; checked flat below."""
    figures = standin.generation(spark, sf_dir).select(
        "power_plant_id",
        "year",
        col("generation_gwh").alias("reported"),
        col("estimated_generation_gwh").alias("estimated"),
        "estimation_method",
    )
    return keys.nest(
        standin.plants(spark, sf_dir),
        figures,
        key="id",
        child_key="power_plant_id",
        columns=["year", "reported", "estimated", "estimation_method"],
        order_by="year",
        name="generation",
    )


@query(
    "plant_detail_flat",
    with_views(
        """SELECT p.id, p.name, g.year, CAST(g.generation_gwh AS DOUBLE) AS reported,
          CAST(g.estimated_generation_gwh AS DOUBLE) AS estimated, g.estimation_method,
          CASE WHEN g.year IS NOT NULL THEN
            CAST(row_number() OVER (PARTITION BY p.id ORDER BY g.year) - 1 AS INTEGER) END AS place
        FROM plants p LEFT JOIN generation g ON g.power_plant_id = p.id""",
        PLANTS_CTE,
        GENERATION_CTE,
    ),
)
def plant_detail_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested detail taken apart again, with each figure's place in its array."""
    nested = plant_detail(spark, sf_dir).select("id", "name", F.posexplode_outer("generation"))
    figures = ["col.year", "col.reported", "col.estimated", "col.estimation_method"]
    return plain(nested.select("id", "name", *figures, col("pos").alias("place")))


# -- geography -------------------------------------------------------------------


def _distance_sql(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    a1, o1, a2, o2 = (f"radians(CAST({c} AS DOUBLE))" for c in (lat1, lng1, lat2, lng2))
    return (
        f"6371 * acos(least(1.0, greatest(-1.0, cos({a1}) * cos({a2}) * cos({o2} - {o1}) + sin({a1}) * sin({a2}))))"
    )


_NEARBY = """id, gppd_idnr, name, country_code, country, CAST(capacity_mw AS DOUBLE) AS capacity_mw,
  CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, primary_fuel"""


@query(
    "nearby",
    with_views(
        f"""SELECT {_NEARBY}, round(d, 3) AS distance_km
        FROM (SELECT *, {_distance_sql('48.85', '2.35', 'latitude', 'longitude')} AS d FROM plants)
        WHERE d < 1500 ORDER BY d, id LIMIT 100""",
        PLANTS_CTE,
    ),
)
def nearby(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = proximity.nearby(standin.plants(spark, sf_dir), 48.85, 2.35, radius_km=1500, limit=100)
    return plain(found.withColumn("distance_km", F.round("distance_km", 3)))


def _centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest plant of each country.

    Stored, so that the planner sees how small the result is.
    """
    largest = keys.keep_first(
        standin.plants(spark, sf_dir).select(
            "country_code", (-col("capacity_mw")).alias("smallness"), "id", "latitude", "longitude"
        ),
        ["country_code"],
        ["smallness", "id"],
    )
    return materialize(
        largest.select(
            col("country_code").alias("centre_id"),
            col("latitude").alias("centre_lat"),
            col("longitude").alias("centre_lng"),
        ),
        "centres",
    )


_PAIRS_SQL = f"""SELECT c.country_code AS centre_id, p.id,
    {_distance_sql('c.latitude', 'c.longitude', 'p.latitude', 'p.longitude')} AS d
  FROM (SELECT * FROM plants QUALIFY
    row_number() OVER (PARTITION BY country_code ORDER BY capacity_mw DESC, id) = 1) c, plants p"""


@query(
    "nearby_join",
    with_views(f"SELECT centre_id, id, round(d, 2) AS distance_km FROM ({_PAIRS_SQL}) WHERE d < 800", PLANTS_CTE),
)
def nearby_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All plants around each country's largest plant."""
    plants = standin.plants(spark, sf_dir).select("id", "latitude", "longitude")
    pairs = proximity.nearby_join(_centres(spark, sf_dir), plants, 800)
    return pairs.select("centre_id", "id", F.round("distance_km", 2).alias("distance_km"))


@query(
    "nearest_per_centre",
    with_views(
        f"""SELECT centre_id, id, rank FROM (
          SELECT centre_id, id, CAST(row_number() OVER (PARTITION BY centre_id ORDER BY d, id) AS INTEGER) AS rank
          FROM ({_PAIRS_SQL}) WHERE d < 2500) WHERE rank <= 5""",
        PLANTS_CTE,
    ),
)
def nearest_per_centre(spark: SparkSession, sf_dir: str) -> DataFrame:
    plants = standin.plants(spark, sf_dir).select("id", "latitude", "longitude")
    ranked = proximity.nearest_join(_centres(spark, sf_dir), plants, 2500, limit=5)
    return ranked.select("centre_id", "id", "rank")


@query(
    "nearest_all",
    with_views(
        f"""SELECT centre_id, id, rank FROM (
          SELECT centre_id, id, CAST(row_number() OVER (PARTITION BY centre_id ORDER BY d, id) AS INTEGER) AS rank
          FROM ({_PAIRS_SQL}) WHERE d < 6000) WHERE rank <= 150""",
        PLANTS_CTE,
    ),
)
def nearest_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More neighbours than a request may ask for."""
    plants = standin.plants(spark, sf_dir).select("id", "latitude", "longitude")
    ranked = proximity.nearest_join(_centres(spark, sf_dir), plants, 6000, limit=150)
    return ranked.select("centre_id", "id", "rank")


@query(
    "nearest_unbounded",
    with_views(
        f"""SELECT centre_id, id, rank FROM (
          SELECT centre_id, id, CAST(row_number() OVER (PARTITION BY centre_id ORDER BY d, id) AS INTEGER) AS rank
          FROM ({_PAIRS_SQL})) WHERE rank <= 7""",
        PLANTS_CTE,
    ),
)
def nearest_unbounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest plants however far they are."""
    plants = standin.plants(spark, sf_dir).select("id", "latitude", "longitude")
    return nearest_k(_centres(spark, sf_dir), plants, 7).select("centre_id", "id", "rank")


# -- labels ----------------------------------------------------------------------


@query(
    "fmt_capacity",
    with_views(
        """SELECT id, CASE WHEN cents >= 100000
            THEN CAST((cents + 5000) // 10000 // 10 AS VARCHAR) || '.' ||
              CAST((cents + 5000) // 10000 % 10 AS VARCHAR) || ' GW'
            ELSE CAST(sign(cents) * ((abs(cents) + 50) // 100) AS VARCHAR) || ' MW' END AS label
        FROM (SELECT id, CAST(capacity_mw * 100 AS BIGINT) AS cents FROM plants)""",
        PLANTS_CTE,
    ),
)
def fmt_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin.plants(spark, sf_dir).select("id", labels.capacity_label(col("capacity_mw")).alias("label"))


@query(
    "fmt_number",
    """SELECT o_orderkey, format('{:,}', cents // 100) || CASE WHEN cents % 100 = 0 THEN ''
        ELSE '.' || rtrim(lpad(CAST(cents % 100 AS VARCHAR), 2, '0'), '0') END AS price_label,
      format('{:,}', o_orderkey) AS key_label
    FROM (SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS cents FROM orders)""",
)
def fmt_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = col("o_totalprice").cast("decimal(12,2)")
    return standin.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        labels.number_label(price).alias("price_label"),
        labels.number_label(col("o_orderkey")).alias("key_label"),
    )


@query(
    "display_defaults",
    with_views(
        """SELECT id, coalesce(nullif(owner, ''), 'Unknown') AS owner,
          coalesce(CAST(nullif(commissioning_year, 0) AS VARCHAR), 'Unknown') AS year FROM plants""",
        PLANTS_CTE,
    ),
)
def display_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin.plants(spark, sf_dir).select(
        "id",
        labels.display_default(col("owner")).alias("owner"),
        labels.display_default(col("commissioning_year"), number=True).alias("year"),
    )


@query(
    "geo_label",
    with_views(
        """SELECT id, CAST(CAST(latitude AS DECIMAL(24,4)) AS VARCHAR) || ', ' ||
            CAST(CAST(longitude AS DECIMAL(24,4)) AS VARCHAR) AS short_label,
          CAST(CAST(latitude AS DECIMAL(24,6)) AS VARCHAR) || ', ' ||
            CAST(CAST(longitude AS DECIMAL(24,6)) AS VARCHAR) AS long_label,
          '?q=' || CAST(latitude AS VARCHAR) || ',' || CAST(longitude AS VARCHAR) AS link FROM plants""",
        PLANTS_CTE,
    ),
)
def geo_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lng = col("latitude"), col("longitude")
    return standin.plants(spark, sf_dir).select(
        "id",
        labels.coordinate_label(lat, lng, 4).alias("short_label"),
        labels.coordinate_label(lat, lng, 6).alias("long_label"),
        labels.map_query(lat, lng).alias("link"),
    )
