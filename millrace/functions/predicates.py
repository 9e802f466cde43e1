"""Predicates given as data, turned into Column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.clean import col


@dataclass(frozen=True)
class Condition:
    """One comparison: column, operator, value.

    Operators: ``= != > >= < <= LIKE ILIKE IN``.
    """

    column: str
    operator: str
    value: Any


OPERATORS: dict[str, Callable[[Column, Any], Column]] = {
    "=": lambda c, v: c == F.lit(v),
    "!=": lambda c, v: c != F.lit(v),
    ">": lambda c, v: c > F.lit(v),
    ">=": lambda c, v: c >= F.lit(v),
    "<": lambda c, v: c < F.lit(v),
    "<=": lambda c, v: c <= F.lit(v),
    "LIKE": lambda c, v: c.like(v),
    "ILIKE": lambda c, v: c.ilike(v),
    "IN": lambda c, v: c.isin(list(v)),
}


def to_column(condition: Condition) -> Column:
    if condition.operator not in OPERATORS:
        raise ValueError(f"unknown operator {condition.operator!r}")
    if condition.operator == "IN" and not list(condition.value):
        raise ValueError(f"IN on {condition.column!r} needs at least one value")
    return OPERATORS[condition.operator](col(condition.column), condition.value)


def all_of(predicates: Iterable[Column]) -> Column:
    """AND of the predicates; true when there are none."""
    return reduce(and_, predicates, F.lit(True))


def where_all(conditions: Iterable[Condition]) -> Column:
    return all_of(to_column(c) for c in conditions)


def contains_text(column: str, text: str) -> Column:
    """Case-insensitive substring; ``%``, ``_`` and backslash in the text stay live."""
    return col(column).ilike(f"%{text}%")


def tokens(text: Column) -> Column:
    """Distinct lower-case words of a text."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def has_all_tokens(column: str, query: str) -> Column:
    """True when every word of the query occurs as a whole word in the column.

    A row-local test, so a search is one narrow pass; there is no stemming.
    """
    if not any(character.isalnum() for character in query):
        raise ValueError("token search needs at least one word")
    return F.size(F.array_except(tokens(F.lit(query)), tokens(col(column)))) == 0
