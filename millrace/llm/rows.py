"""A number for every row of a table, the same whenever the table is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.clean import col
from millrace.sources.workspace import materialize


def numbered_rows(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, str]:
    """The rows with a column that is unique, and that column's name.

    Where the ids are unique and none is null they serve as they are.  Otherwise the rows
    are stored in the shared folder with their place in the input.
    """
    rows, ids = docs.agg(F.count("*"), F.count_distinct(col(id_col))).first()
    if rows == ids and docs.schema[id_col].dataType.typeName() in ("integer", "long"):
        return docs, id_col
    name = spare_name(docs, "__row")
    return materialize(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def spare_name(docs: DataFrame, name: str) -> str:
    """The name, lengthened until no column has it in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, row: str, gone: DataFrame, columns: list[str]) -> DataFrame:
    """The numbered rows that are not listed in ``gone``, with the given columns."""
    name = spare_name(docs, "__gone")
    kept = docs.join(gone.select(F.col("row").alias(name)), col(row) == F.col(name), "left_anti")
    return kept.select(*[col(c) for c in columns])
