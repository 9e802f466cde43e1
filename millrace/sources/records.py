"""Delimited text with line breaks inside quotes, read in parallel.

A quoted break hides from a reader that sees one line or one split at a time.  Here every
line is a step between two states, outside and inside a quoted field, which depends on its
own text only.  Steps are composed, first within each split, then over the splits of a
file (one row each), which gives the state every split starts in; from there each line
knows whether it ends a record.  Only lines that open or close a quote take part, and only
lines of records that span several are moved to put them together.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.files import CSV_OPTIONS, RAW_LINE, malformed_sql, odd_quotes_sql, ragged_sql, ragged_text_sql, scan_csv
from millrace.sources.workspace import materialize

#: A record of more lines is not put together: its lines go to quarantine one by one.
MOST_LINES = 10_000

#: Encodings in which a line break is the one byte it is in ASCII.
BYTE_ENCODINGS = ("UTF-8", "ISO-8859-1", "US-ASCII")

_FIELD_START = "(?<![^,])"
# Possessive, so that long fields need no stack.
_INNER = '(?:[^"]++|"")*+'
_STRIPPED = f"""regexp_replace({{0}}, r'{_FIELD_START}"{_INNER}"(?=,|\\z)', '')"""
_OPEN = f"""({_STRIPPED} RLIKE r'{_FIELD_START}"{_INNER}\\z')"""
# What is left of a line that starts inside a quote once that field has ended.
_AFTER = f"""regexp_replace({{0}}, r'^{_INNER}"[^,]*+', '')"""


def line_steps(value: str) -> tuple[str, str]:
    """SQL for the state after a line that starts outside, and inside, a quoted field (1: inside).

    A field is quoted if it starts with a quote; it ends at a single quote before a comma or
    the line's end.  A single quote elsewhere is malformed and ends the quoting as well.
    """
    text = f"regexp_replace({value}, r'\\r\\z', '')"
    outside = f"CAST(contains({value}, '\"') AND {_OPEN.format(text)} AS int)"
    stays = f"""{text} RLIKE r'^{_INNER}\\z'"""
    inside = f"CAST(NOT contains({value}, '\"') OR {stays} OR {_OPEN.format(_AFTER.format(text))} AS int)"
    return outside, inside


def text_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """The lines of text files as they are: ``file``, ``block`` (where its split starts), ``value``."""
    return _placed(spark.read.option("lineSep", "\n").text(path), encoding)


def text_stream(spark: SparkSession, path: str, files_per_batch: int, encoding: str = "UTF-8") -> DataFrame:
    """The same of files as they arrive; a batch holds whole files."""
    options = {"lineSep": "\n", "maxFilesPerTrigger": str(files_per_batch)}
    return _placed(spark.readStream.options(**options).text(path), encoding)


def _placed(lines: DataFrame, encoding: str) -> DataFrame:
    if encoding.upper() not in BYTE_ENCODINGS:
        raise ValueError(f"lines of {encoding} text cannot be told apart; one of {', '.join(BYTE_ENCODINGS)}")
    value = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    places = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    return lines.select(*places, value.alias("value"))


def _before(partition: list[str], order: str):
    return Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _composed(rows: DataFrame, partition: list[str], order: str, fixed: Column, flips: Column) -> DataFrame:
    """Adds ``_fixed`` and ``_odd``: the steps of the rows before, composed.

    A step that ends in the same state from both starts fixes it; one that swaps the states
    flips it; others change nothing.  The composition is the last fixed state, if any,
    flipped if an odd number of flips came after it.
    """
    w = _before(partition, order)
    total = F.coalesce(F.sum(flips).over(w), F.lit(0))
    # Flips up to a fixing row itself, which flips nothing.
    rows = rows.withColumn("_total", total)
    at_last = F.coalesce(F.last(F.when(fixed.isNotNull(), F.col("_total")), ignorenulls=True).over(w), F.lit(0))
    rows = rows.withColumns({"_fixed": F.last(fixed, ignorenulls=True).over(w), "_odd": (F.col("_total") - at_last) % 2})
    return rows.drop("_total")


def _flipped(state: Column, odd: Column) -> Column:
    return state.bitwiseXOR(odd.cast("int"))


def spanning_lines(lines: DataFrame) -> DataFrame:
    """The lines of records that span several: ``id``, ``owner`` (the record's first line), ``sound``.

    Not sound are records that never close, or of more than ``MOST_LINES`` lines.
    """
    split = ["file", "block"]
    events = lines.where("outside <> 0 OR inside <> 1").select(*split, "id", "outside", "inside")
    fixed = F.when(F.col("outside") == F.col("inside"), F.col("outside"))
    flips = F.when((F.col("outside") == 1) & (F.col("inside") == 0), 1).otherwise(0)
    events = materialize(_composed(events, split, "id", fixed, flips), "quotes")
    # The step of a whole split: that of the lines before its last event, and the last event.
    ends = events.groupBy(*split).agg(F.max_by(F.struct(fixed.alias("own"), flips.alias("flip"), "_fixed", "_odd"), "id").alias("e"))
    ends = ends.select(
        *split,
        F.coalesce("e.own", _flipped(F.col("e._fixed"), (F.col("e._odd") + F.col("e.flip")) % 2)).alias("to"),
        F.when(F.col("e.own").isNull() & F.col("e._fixed").isNull(), (F.col("e._odd") + F.col("e.flip")) % 2).otherwise(0).alias("flip"),
    )
    ranges = lines.groupBy(*split).agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    # One row per split from here on.
    blocks = ranges.join(ends, split, "left").withColumn("flip", F.coalesce("flip", F.lit(0)))
    blocks = _composed(blocks, ["file"], "block", F.col("to"), F.col("flip"))
    start = _flipped(F.coalesce("_fixed", F.lit(0)), F.col("_odd"))
    blocks = materialize(blocks.select(*split, "first_id", "last_id", start.alias("start")), "splits")
    states = events.join(blocks, split).withColumn("was", _flipped(F.coalesce("_fixed", "start"), F.col("_odd")))
    states = states.withColumn("now", F.when(F.col("was") == 0, F.col("outside")).otherwise(F.col("inside")))
    borders = materialize(states.where("was <> now").select(*split, "id", "last_id", (F.col("now") == 1).alias("opens")), "borders")
    # Borders alternate, so the next one in the split closes what this one opens.
    closes = F.lead("id").over(Window.partitionBy(*split).orderBy("id"))
    opened = borders.withColumn("closes", closes).where("opens")
    opened = opened.select(F.col("id").alias("from"), F.coalesce("closes", "last_id").alias("upto"), F.col("closes").isNotNull().alias("closed"), F.col("id").alias("owner"))
    edges = borders.groupBy(*split).agg(
        F.max(F.when(F.col("opens"), F.col("id"))).alias("last_open"), F.min(F.when(~F.col("opens"), F.col("id"))).alias("first_close")
    )
    carried = blocks.join(edges, split, "left").withColumn("owner", F.last("last_open", ignorenulls=True).over(_before(["file"], "block")))
    # A split that starts inside: its first border, if it has one, is a closing one.
    carried = carried.where("start = 1").select(
        F.col("first_id").alias("from"),
        F.coalesce("first_close", "last_id").alias("upto"),
        F.col("first_close").isNotNull().alias("closed"),
        "owner",
    )
    parts = materialize(opened.unionByName(carried), "spans")
    sizes = parts.groupBy("owner").agg(F.sum(F.expr("upto - from + 1")).alias("n"), F.max("closed").alias("closed"))
    sound = sizes.select("owner", (F.col("closed") & (F.col("n") <= MOST_LINES)).alias("sound"))
    # Line numbers are consecutive within a split.
    return parts.join(sound, "owner").select(F.explode(F.sequence("from", "upto")).alias("id"), "owner", "sound")


def records(lines: DataFrame, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(records, heads)`` of text lines: ``id``, ``value`` and ``sound``; heads are their files' first.

    Lines are stored once with their number and steps; where none opens a quote for another
    to close, each is a record.  The text of a record keeps its inner line breaks.
    """
    outside, inside = line_steps("value")
    numbered = lines.select("file", "block", F.monotonically_increasing_id().alias("id"), "value")
    stored = materialize(numbered.selectExpr("*", f"{outside} AS outside", f"{inside} AS inside"), "lines")
    if stored.where("outside = 1").isEmpty():
        found = stored.select("id", "value", F.lit(True).alias("sound"))
    else:
        spans = materialize(spanning_lines(stored), "spanning")
        alone = stored.select("id", "value").join(spans.select("id"), "id", "left_anti").withColumn("sound", F.lit(True))
        moved = stored.select("id", "block", "value").join(spans, "id")
        texts = F.transform(F.sort_array(F.collect_list(F.struct("block", "id", "value"))), lambda r: r["value"])
        whole = moved.where("sound").groupBy("owner").agg(F.array_join(texts, "\n").alias("value"))
        loose = moved.where("NOT sound").select("id", "value", "sound")
        found = alone.unionByName(whole.select(F.col("owner").alias("id"), "value", F.lit(True).alias("sound"))).unionByName(loose)
    found = found.withColumn("value", F.regexp_replace("value", r"\r\z", ""))
    if not header:
        return found, found.limit(0)
    # One row per file.
    heads = materialize(stored.where("block = 0").groupBy("file").agg(F.min("id").alias("id")).select("id"), "heads")
    return found.join(heads, "id", "left_anti"), found.join(heads, "id", "left_semi")


def parse_records(found: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of records as text, and `RAW_LINE`: null, or the text of a record that is not read.

    Not read are records with too many fields or malformed quotes, and lines of records that
    are not sound; their fields are null.  Blank records are skipped, as in any such file.
    """
    names = schema.names
    fields = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "enforceSchema"}
    ragged = F.expr(f"NOT sound OR {ragged_text_sql('value', len(names))} OR {malformed_sql('value')}")
    marked = found.where("trim(BOTH ' \t' FROM value) <> ''").withColumn("_ragged", ragged)
    parsed = marked.withColumn("_fields", F.from_csv(F.when(~F.col("_ragged"), F.col("value")), fields, options))
    values = [F.col(f"_fields.c{i}").alias(name) for i, name in enumerate(names)]
    return parsed.select(*values, F.when(F.col("_ragged"), F.col("value")).alias(RAW_LINE))


def check_heads(heads: DataFrame, schema: T.StructType) -> None:
    """Every file's first record must name the columns in order."""
    # Files of one kind share one text; at worst there is one per file.
    for head in heads.select("value").distinct().collect():
        names = next(csv.reader(io.StringIO(head["value"].removeprefix("\ufeff"), newline="")), [])
        if names != schema.names:
            raise ValueError(f"CSV header does not conform to the schema {schema.names}: {names}")


def scan_records(spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8", header: bool = True) -> DataFrame:
    """The records of delimited files with an all-text schema, quoted line breaks and all.

    Any number of tasks read a file.  Every record is read whole or kept whole in `RAW_LINE`:
    no half of one passes for a row.  Lines end with a line feed, with or without a carriage
    return before it.
    """
    found, heads = records(text_lines(spark, path, encoding), header)
    if header:
        check_heads(heads, schema)
    return parse_records(found, schema)


def text_rows(spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8") -> DataFrame:
    """Rows of delimited files in any encoding, as `scan_records` gives them.

    In an encoding whose line breaks are more than one byte every file is one task.
    """
    if encoding.upper() in BYTE_ENCODINGS:
        return scan_records(spark, path, schema, encoding)
    scanned = scan_csv(spark, path, schema, encoding, multi_line=True, keep_raw_line=True)
    return scanned.withColumn(RAW_LINE, F.expr(f"CASE WHEN {ragged_sql(len(schema))} THEN {RAW_LINE} END"))


def ragged_reason_sql(line: str, n_columns: int) -> str:
    """Why the text in ``line`` is no row; null where that is null."""
    return (
        f"CASE WHEN {line} IS NULL THEN NULL WHEN {odd_quotes_sql(line)} OR {malformed_sql(line)} THEN 'unbalanced quotes' "
        f"WHEN {ragged_text_sql(line, n_columns)} THEN 'too many fields' ELSE 'part of an open record' END"
    )
