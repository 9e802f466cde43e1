"""Turning all-text columns into typed ones.

Everything is a built-in expression, so a cleaning step stays inside one codegen stage
with the scan and never shuffles.  The expressions are SQL text: a wide table is then
one ``selectExpr`` instead of thousands of small calls into the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Whole cells that mean "missing"; case matters.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# The only characters a number may have.  Spark's cast alone also takes '1d', '1f', '0x1p3',
# 'NaN' and 'Infinity'; what is left of the grammar is its own.
NUMBER_TEXT = r"^[\s0-9+.eE-]*$"


def quoted(name: str) -> str:
    """A column name as SQL text, dots and blanks included."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def text_literal(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _labels(values: Iterable[str]) -> str:
    return ", ".join(text_literal(v) for v in values)


def null_tokens(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    extra: Iterable[str] = (),
) -> DataFrame:
    """Blank out missing-value tokens in the given (default: all) text columns."""
    wanted = set(df.columns if columns is None else columns)
    tokens = _labels([*NULL_TOKENS, *extra])
    return df.selectExpr(
        *[
            f"CASE WHEN {quoted(c)} NOT IN ({tokens}) THEN {quoted(c)} END AS {quoted(c)}"
            if c in wanted
            else quoted(c)
            for c in df.columns
        ]
    )


def number_sql(text: str) -> str:
    """Text to double, null when it is no number; only '1e400' and the like overflow to infinity."""
    return f"CASE WHEN {text} RLIKE r'{NUMBER_TEXT}' THEN try_cast({text} AS double) END"


def int_sql(text: str) -> str:
    """Text to int, cutting fractions toward zero; null when absent or out of range."""
    return f"try_cast({number_sql(text)} AS int)"


def decimal_sql(number: str, precision: int, scale: int) -> str:
    """Round half away from zero to the declared scale; overflow and infinity become null."""
    return f"try_cast({number} AS decimal({precision},{scale}))"


def domain_sql(value: str, domain: Iterable[str]) -> str:
    """The value itself when it is a known label, else null."""
    return f"CASE WHEN {value} IN ({_labels(domain)}) THEN {value} END"


def default_sql(value: str, default: str) -> str:
    return f"coalesce({value}, {text_literal(default)})"


def safe_numeric(column: str) -> Column:
    """Text column to double; anything that is not a finite number becomes null, never NaN."""
    number = number_sql(quoted(column))
    return F.expr(f"CASE WHEN abs({number}) < double('Infinity') THEN {number} END")


def safe_int(column: str) -> Column:
    return F.expr(int_sql(quoted(column)))


def safe_decimal(column: str, precision: int, scale: int) -> Column:
    return F.expr(decimal_sql(quoted(column), precision, scale))


def in_domain(column: str, domain: Iterable[str]) -> Column:
    return F.expr(domain_sql(quoted(column), domain))


def fill_default(column: str, default: str) -> Column:
    return F.expr(default_sql(quoted(column), default))


def map_values(column: str, mapping: Mapping[str, str]) -> Column:
    """Dictionary lookup with a literal map; unmapped values become null.

    For dictionaries that belong in a table use :func:`map_values_from`.
    """
    if all(k == v for k, v in mapping.items()):
        return in_domain(column, mapping)
    return F.expr(f"try_element_at(map({_labels(chain(*mapping.items()))}), {quoted(column)})")


def map_values_from(df: DataFrame, column: str, mapping: DataFrame, key: str, value: str) -> DataFrame:
    """Dictionary lookup against a table with unique keys, replacing ``column``.

    No broadcast hint: Spark broadcasts the dictionary when its measured size allows.
    """
    lookup = mapping.select(col(key).alias("_map_key"), col(value).alias("_map_value"))
    joined = df.join(lookup, col(column) == F.col("_map_key"), "left")
    return joined.select(*[F.col("_map_value").alias(c) if c == column else df[c] for c in df.columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in float and double columns; other columns are untouched."""
    floats = {f.name for f in df.schema if f.dataType.typeName() in ("float", "double")}
    return df.selectExpr(
        *[
            f"CASE WHEN NOT isnan({quoted(c)}) THEN {quoted(c)} END AS {quoted(c)}" if c in floats else quoted(c)
            for c in df.columns
        ]
    )
