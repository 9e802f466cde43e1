"""Sorting, limits, pages and top-k."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.contract import FUELS
from millrace.functions.clean import col
from millrace.functions.predicates import Condition, all_of, contains_text, where_all
from millrace.operators.keys import dense_numbers
from millrace.sources.workspace import materialize

DEFAULT_PAGE_SIZE = 20
MAX_PAGE_SIZE = 100

# Positions that a top-k may reach, and values that cut a column into ranges at a time.
REACH = 2_000
CUTS = 64

# A sort column and whether it descends.
Key = tuple[str, bool]


def order(column: str, descending: bool = False) -> Column:
    """Sort expression with nulls last ascending and first descending."""
    return col(column).desc_nulls_first() if descending else col(column).asc_nulls_last()


def limit_offset(
    df: DataFrame, limit: int | None = None, offset: int | None = None, ordering: Sequence[Key] = ()
) -> DataFrame:
    """Limit and offset of the rows as ``ordering`` sorts them; both optional.

    An offset needs an order: without one the rows are taken in the order of all columns.
    """
    for label, value in (("limit", limit), ("offset", offset)):
        if value is not None and value < 0:
            raise ValueError(f"{label} must not be negative")
    if not offset and not ordering:
        return df if limit is None else df.limit(limit)
    return sorted_slice(df, list(ordering) or [(c, False) for c in df.columns], limit, offset or 0)


def sorted_slice(df: DataFrame, ordering: Sequence[Key], limit: int | None, offset: int = 0) -> DataFrame:
    """Rows ``offset + 1 .. offset + limit`` of the sorted frame, or all from there on.

    While the last position is out of a top-k's reach, the leading sort column is cut into
    ranges at values drawn by hash, rows are counted per range, and the search goes on in
    the ranges that hold the wanted positions, by a condition on the column that a scan can
    use.  Rows of one value go on with the next sort column.  A page near the start needs
    no such round, so its frame is lazy; for others the counting runs while it is built.
    Nothing is written, no task sorts more than its share, and a top-k passes over ``REACH``
    rows at most.  ``ordering`` should identify a row; where many rows tie in all of it, some
    of them are numbered and taken, each task its own.
    """
    ordering = list(ordering)
    columns = [order(*key) for key in ordering]
    parts = _slice(df, ordering, offset, None if limit is None else offset + limit)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    if limit is not None and offset + limit <= REACH:
        return found.orderBy(*columns).limit(limit)
    # Ranges of the sort can only part rows that differ: a number sets equal ones apart.
    return found.withColumn("_tie", F.monotonically_increasing_id()).orderBy(*columns, "_tie").drop("_tie")


def _slice(df: DataFrame, ordering: list[Key], start: int, stop: int | None) -> list[DataFrame]:
    """Frames that together hold the positions ``start`` to ``stop`` (exclusive) of the sorted frame."""
    if start == 0 and stop is None:
        return [df]
    if stop is not None and stop <= REACH:
        return [df.orderBy(*[order(*key) for key in ordering]).offset(start).limit(stop - start)]
    if not ordering:
        # Rows that no sort column tells apart: any will do.
        return [some_rows(df, (df.count() if stop is None else stop) - start)]
    name, descending = ordering[0]
    cells = _cells(df, name, descending, [key for key, _ in ordering])
    total = sum(n for _, _, n in cells)
    stop = total if stop is None else min(stop, total)
    out, before, whole = [], 0, []
    for condition, is_value, n in cells:
        low, high = max(start - before, 0), min(stop - before, n)
        before += n
        if low >= high:
            continue
        if low == 0 and high == n:
            whole.append(condition)
            continue
        rest = df.where(condition)
        if n <= REACH:
            out.append(rest.orderBy(*[order(*key) for key in ordering]).offset(low).limit(high - low))
        else:
            out += _slice(rest, ordering[1:] if is_value else ordering, low, None if high == n else high)
    if whole:
        out.append(df.where(reduce(or_, whole)))
    return out or [df.limit(0)]


def some_rows(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` of the rows, left where they are: no task gathers them.

    Rows are stored with their place, and counted per task; the counts before a task (one
    row each) tell how many of its rows are wanted.
    """
    placed = materialize(df.withColumn("_place", F.monotonically_increasing_id()), "tied")
    return dense_numbers(placed, "_number").where(F.col("_number") <= n).select(*[col(c) for c in df.columns])


def list_after(
    df: DataFrame, ordering: Sequence[Key], after: Sequence[object] | None = None, limit: int = DEFAULT_PAGE_SIZE
) -> DataFrame:
    """The next ``limit`` rows behind the row with the values ``after`` in the sort columns.

    However deep the page lies, it costs one top-k over rows that a range on the leading
    column admits, which reaches the scan.  ``ordering`` must identify a row; rows added or
    removed before the position shift nothing.
    """
    if limit < 1:
        raise ValueError("limit must be positive")
    if after is not None:
        if len(after) != len(ordering):
            raise ValueError("one value is needed for each sort column")
        df = df.where(_follows(df, list(ordering), list(after)))
        name, descending = ordering[0]
        if after[0] is not None and after[0] == after[0]:
            reach = col(name) <= F.lit(after[0]) if descending else (col(name) >= F.lit(after[0])) | col(name).isNull()
            df = df.where(reach)
    return df.orderBy(*[order(*key) for key in ordering]).limit(limit)


def _follows(df: DataFrame, ordering: list[Key], after: list[object]) -> Column:
    """Whether a row comes after the values: nulls last ascending and first descending."""
    (name, descending), value = ordering[0], after[0]
    column = col(name)
    if value is None:
        later = column.isNotNull() if descending else F.lit(False)
    else:
        # Not-a-number counts as the largest number, as in the sort.
        later = column < F.lit(value) if descending else (column > F.lit(value)) | column.isNull()
    later = F.coalesce(later, F.lit(False))
    if len(ordering) == 1:
        return later
    return later | (column.eqNullSafe(F.lit(value).cast(df.schema[name].dataType)) & _follows(df, ordering[1:], after[1:]))


def _cells(df: DataFrame, name: str, descending: bool, ordering: list[str]) -> list[tuple[Column, bool, int]]:
    """Conditions that part the rows by one column, in its order: (condition, one value only, rows)."""
    column = col(name)
    is_float = df.schema[name].dataType.typeName() in ("float", "double")
    drawn = df.where(column.isNotNull() & ~F.isnan(column) if is_float else column.isNotNull())
    drawn = drawn.select(column.alias("v"), F.xxhash64(*[col(c) for c in ordering]).alias("h"))
    # At most CUTS values.
    cuts = sorted({r.v for r in drawn.orderBy("h", "v").limit(CUTS).collect()})

    def place(low: int, high: int) -> Column:
        # Cell 2 i lies below cut i, cell 2 i + 1 is the cut itself.
        if low == high:
            return F.lit(2 * low)
        middle = (low + high) // 2
        cut = F.lit(cuts[middle])
        return F.when(column < cut, place(low, middle)).when(column == cut, F.lit(2 * middle + 1)).otherwise(place(middle + 1, high))

    # Not-a-number sorts above all numbers, null above that.
    nan, null = 2 * len(cuts) + 1, 2 * len(cuts) + 3
    cell = F.when(column.isNull(), F.lit(null))
    if is_float:
        cell = cell.when(F.isnan(column), F.lit(nan))
    cell = cell.otherwise(place(0, len(cuts)))
    counts = {r.cell: r.n for r in df.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()}

    def condition(at: int) -> Column:
        if at == null:
            return column.isNull()
        if at == nan:
            return F.isnan(column)
        if at % 2:
            return column == F.lit(cuts[at // 2])
        above = column > F.lit(cuts[at // 2 - 1]) if at else column.isNotNull()
        if at // 2 < len(cuts):
            return above & (column < F.lit(cuts[at // 2]))
        return above & ~F.isnan(column) if is_float else above

    ordered = sorted(counts, reverse=descending)
    return [(condition(at), at % 2 == 1, counts[at]) for at in ordered]


def select_query(
    df: DataFrame,
    columns: Iterable[str],
    conditions: Iterable[Condition] = (),
    order_by: str | None = None,
    descending: bool = False,
    limit: int | None = None,
    offset: int | None = None,
    tie_breaker: Sequence[str] = (),
) -> DataFrame:
    """Columns, AND-ed conditions, one sort column, limit and offset; all but columns optional."""
    picked = df.where(where_all(conditions))
    if order_by is None:
        return limit_offset(picked, limit, offset).select(*[col(c) for c in columns])
    ordering = [(order_by, descending), *[(c, False) for c in tie_breaker]]
    return limit_offset(picked, limit, offset, ordering).select(*[col(c) for c in columns])


@dataclass(frozen=True)
class PlantFilter:
    """Optional filters of the plant list; empty and absent ones do not apply."""

    country: str | None = None
    fuel: str | None = None
    min_capacity: float | None = None
    max_capacity: float | None = None
    search: str | None = None

    def predicate(self, fuels: Iterable[str] = FUELS) -> Column:
        """Bounds are decimal literals: a double would force a cast on the stored column."""
        parts = []
        if self.country is not None:
            if len(self.country) != 3:
                raise ValueError("country must have exactly 3 characters")
            parts.append(col("country_code") == F.lit(self.country.upper()))
        if self.fuel:
            parts.append(col("primary_fuel") == F.lit(known_label(self.fuel, fuels)))
        for bound in (self.min_capacity, self.max_capacity):
            if bound is not None and not bound > 0:
                raise ValueError("capacity bounds must be positive")
        if self.min_capacity is not None:
            parts.append(col("capacity_mw") >= F.lit(Decimal(str(self.min_capacity))))
        if self.max_capacity is not None:
            parts.append(col("capacity_mw") <= F.lit(Decimal(str(self.max_capacity))))
        if self.search:
            parts.append(contains_text("name", self.search))
        return all_of(parts)


def known_label(label: str, domain: Iterable[str]) -> str:
    """A label outside the closed domain is an error, not an empty result."""
    if label not in set(domain):
        raise ValueError(f"unknown label {label!r}")
    return label


def check_page(page: int, limit: int) -> tuple[int, int]:
    """Reject a page below 1 and a page size outside 1..100; gives (offset, limit)."""
    if page < 1:
        raise ValueError("page must be at least 1")
    if not 1 <= limit <= MAX_PAGE_SIZE:
        raise ValueError(f"limit must be between 1 and {MAX_PAGE_SIZE}")
    return (page - 1) * limit, limit


def clamp_limit(limit: int | None, default: int, most: int) -> int:
    """Top-k size: zero or absent gives the default, too large is cut to the most."""
    wanted = limit or default
    if wanted < 0:
        raise ValueError("limit must not be negative")
    return min(wanted, most)


# The columns of a listed plant.
LIST_COLUMNS = (
    "id",
    "gppd_idnr",
    "name",
    "country_code",
    "country",
    "capacity_mw",
    "latitude",
    "longitude",
    "primary_fuel",
    "commissioning_year",
    "owner",
)


def list_page(df: DataFrame, page: int = 1, limit: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """One page of (already filtered) plants, largest capacity first, id as tie-breaker."""
    offset, size = check_page(page, limit)
    rows = df.select(*[col(c) for c in LIST_COLUMNS])
    return sorted_slice(rows, [("capacity_mw", True), ("id", False)], size, offset)


def total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


def page_meta(df: DataFrame, page: int = 1, limit: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """Page, size, total rows and pages, and the displayed range of row numbers."""
    offset, size = check_page(page, limit)
    n = F.col("total")
    return total(df).select(
        F.lit(page).cast("int").alias("page"),
        F.lit(size).cast("int").alias("page_size"),
        n,
        F.ceil(n / size).cast("bigint").alias("total_pages"),
        F.lit(offset + 1).cast("bigint").alias("first_shown"),
        F.least(F.lit(offset + size).cast("bigint"), n).alias("last_shown"),
    )


def list_plants(
    plants: DataFrame,
    filters: PlantFilter | None = None,
    page: int = 1,
    limit: int = DEFAULT_PAGE_SIZE,
) -> tuple[DataFrame, DataFrame]:
    """``(rows of the page, page metadata)`` under the same filters.

    Two jobs: a top-k for the rows and a count, which reads only the filtered columns.
    """
    matching = plants.where((filters or PlantFilter()).predicate())
    return list_page(matching, page, limit), page_meta(matching, page, limit)


def top_plants(df: DataFrame, limit: int | None = None, fuel: str | None = None, fuels: Iterable[str] = FUELS) -> DataFrame:
    """Largest plants with their position; ``fuel`` narrows the list."""
    k = clamp_limit(limit, 10, 100)
    if fuel:
        df = df.where(col("primary_fuel") == F.lit(known_label(fuel, fuels)))
    # The columns of a ranked plant.
    columns = ("id", "name", "country", "country_code", "capacity_mw", "primary_fuel", "commissioning_year")
    ordering = [order("capacity_mw", True), order("id")]
    top = df.select(*[col(c) for c in columns]).orderBy(*ordering).limit(k)
    # At most k <= 100 rows are left, so one task for the position is enough.
    position = F.row_number().over(Window.orderBy(*ordering))
    return top.withColumn("rank", position)
