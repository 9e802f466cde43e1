"""Delimited text in, everything as strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.clean import col, null_tokens

RAW_LINE = "_raw_line"

# RFC 4180: a quote inside a quoted field is doubled.  Spark's default escape is a backslash.
# enforceSchema=false compares every file's header with the schema instead of trusting order.
CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "enforceSchema": "false",
    "nullValue": "",
}


def csv_options(encoding: str = "UTF-8", multi_line: bool = False, header: bool = True) -> dict[str, str]:
    flags = {"multiLine": multi_line, "header": header}
    return CSV_OPTIONS | {"encoding": encoding} | {k: str(v).lower() for k, v in flags.items()}


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    encoding: str = "UTF-8",
    multi_line: bool = False,
    header: bool = True,
    keep_raw_line: bool = False,
) -> DataFrame:
    """Read delimited text with an all-string schema; nothing is inferred.

    ``multi_line`` allows line breaks inside quotes but makes each file one task, so it
    is off by default.  ``keep_raw_line`` adds the raw text of ragged rows.
    """
    if keep_raw_line:
        schema = T.StructType([*schema.fields, T.StructField(RAW_LINE, T.StringType(), True)])
    reader = spark.read.schema(schema).options(**csv_options(encoding, multi_line, header))
    if keep_raw_line:
        # Without all columns the parser would not notice a wrong number of fields.
        reader = reader.option("columnNameOfCorruptRecord", RAW_LINE).option("columnPruning", "false")
    return reader.csv(path)


def header_columns(spark: SparkSession, path: str, encoding: str = "UTF-8") -> list[str]:
    """Column names of the header line; only the first line is read."""
    options = csv_options(encoding) | {"inferSchema": "false"}
    return spark.read.options(**options).csv(path).columns


def ragged_sql(n_columns: int) -> str:
    """True for a row of `scan_csv` with more fields than the header or an open quote; never null.

    A shorter row is not ragged: its missing tail reads as null, as the source rules say.
    A quoted line break read without ``multi_line`` leaves two lines with an odd number of
    quotes each; both are ragged, unless the break is in the last column, whose first half
    has all its fields, so that the parser keeps no line of it.  `records.scan_records` has no such gap.
    """
    return f"({RAW_LINE} IS NOT NULL AND {ragged_text_sql(RAW_LINE, n_columns)})"


def ragged_text_sql(column: str, n_columns: int) -> str:
    """True for a record with more fields than columns or an odd number of quotes; never null.

    Fields are counted after dropping quoted parts, whose commas do not separate.  Text
    without a quote, as nearly all is, needs no regular expression.
    """
    unquoted = f"""regexp_replace({column}, r'"(?:[^"]++|"")*+"', '')"""
    with_quotes = f"coalesce(size(split({unquoted}, ',', -1)), 0) > {n_columns} OR {odd_quotes_sql(column)}"
    return f"CASE WHEN contains({column}, '\"') THEN {with_quotes} ELSE coalesce({_occurrences(column, ',')} >= {n_columns}, false) END"


def malformed_sql(column: str) -> str:
    """True for a record with a field that starts with a quote but does not end with its pair; never null."""
    stripped = f"""regexp_replace({column}, r'(?<![^,])"(?:[^"]++|"")*+"(?=,|\\z)', '')"""
    return f"""CASE WHEN contains({column}, '"') THEN {stripped} RLIKE r'(?<![^,])"' ELSE false END"""


def odd_quotes_sql(column: str) -> str:
    """True for text with an odd number of quotes; never null."""
    return f"coalesce({_occurrences(column, chr(34))} % 2 = 1, false)"


def _occurrences(column: str, char: str) -> str:
    return f"(octet_length({column}) - octet_length(replace({column}, '{char}', '')))"


def split_ragged(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, quarantine)`` of a scan made with ``keep_raw_line`` and then staged.

    Staging parses the text once for both, and Spark refuses to read raw lines alone
    straight from the text.  Quarantine keeps the untouched line, because the fields of
    a row that is too long cannot be told apart.
    """
    data = [c for c in scanned.columns if c != RAW_LINE]
    ragged = ragged_sql(len(data))
    rows = scanned.where(f"NOT {ragged}").select(*[col(c) for c in data])
    return rows, scanned.where(ragged).select(col(RAW_LINE).alias("raw_line"))


def extract(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Scan plus missing-value tokens: the usual first step of a migration."""
    return null_tokens(scan_csv(spark, path, schema, **options))


def count_records(df: DataFrame) -> DataFrame:
    """Number of records (not of physical lines)."""
    return df.agg(F.count(F.lit(1)).alias("n_records"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(header="true", quote='"', escape='"').csv(path)
