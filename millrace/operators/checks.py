"""Applying a table contract to rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.contract import TableContract
from millrace.functions.clean import col, quoted

VIOLATIONS = "violations"


def _values(df: DataFrame) -> dict[str, str]:
    return {c: quoted(c) for c in df.columns}


def all_pass_sql(rules: Mapping[str, str]) -> str:
    return " AND ".join(f"({ok})" for ok in rules.values()) or "true"


def broken_rules_sql(rules: Mapping[str, str]) -> str:
    """Names of the broken rules as an array, empty for a good row."""
    names = [f"CASE WHEN NOT {ok} THEN '{name}' END" for name, ok in rules.items()]
    return f"array_compact(array({', '.join(names) or 'CAST(NULL AS string)'}))"


def with_violations(df: DataFrame, contract: TableContract) -> DataFrame:
    """Adds the names of the broken row rules."""
    return df.withColumn(VIOLATIONS, F.expr(broken_rules_sql(contract.rules(_values(df)))))


def split_valid(df: DataFrame, contract: TableContract) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)``; quarantine keeps the rule names.

    Both are narrow views of the same input: stage the input first when it is costly.
    """
    clean = all_pass_sql(contract.rules(_values(df)))
    return df.where(clean), with_violations(df, contract).where(f"NOT ({clean})")


def enforce(df: DataFrame, contract: TableContract) -> DataFrame:
    """The same rows, failing the job at the first row that breaks a rule."""
    tagged = with_violations(df, contract)
    message = F.concat(F.lit(f"{contract.name}: "), F.concat_ws(", ", VIOLATIONS))
    # The filter keeps every row: it is only there to evaluate the assertion.
    return tagged.where(F.assert_true(F.size(VIOLATIONS) == 0, message).isNull()).drop(VIOLATIONS)


def violation_counts(df: DataFrame, contract: TableContract) -> DataFrame:
    """One row per rule with the number of rows breaking it, in one pass."""
    rules = contract.rules(_values(df))
    counted = df.agg(*[F.expr(f"count_if(NOT {ok}) AS {name}") for name, ok in rules.items()])
    return counted.unpivot([], list(rules), "rule", "n_rows")


def column_profile(df: DataFrame, contract: TableContract) -> DataFrame:
    """Per contract column: declared type, nulls and longest text, in one pass."""
    fields = [f for f in contract.fields if f.name in df.columns]
    counted = df.agg(
        *[F.count_if(col(f.name).isNull()).alias(f"n_{i}") for i, f in enumerate(fields)],
        *[
            F.max(F.length(col(f.name).cast("string")).cast("bigint")).alias(f"l_{i}")
            for i, f in enumerate(fields)
        ],
    )
    slots = ", ".join(
        f"'{f.name}', '{f.type}', {str(f.required).lower()}, n_{i}, l_{i}" for i, f in enumerate(fields)
    )
    return counted.selectExpr(
        f"stack({len(fields)}, {slots}) AS (column_name, column_type, required, n_null, max_length)"
    )
