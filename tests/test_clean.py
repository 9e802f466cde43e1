import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions import clean

ACCEPTED = {
    " 12 ": 12.0,
    "1e3": 1000.0,
    "+5": 5.0,
    ".5": 0.5,
    "5.": 5.0,
    "-1.5": -1.5,
    "\t7\n": 7.0,
    "1E-2": 0.01,
}
REFUSED = ["1,000", "0x10", "1_000", "True", "12abc", "1d", "1f", "0x1p3", "1 2", "--1", "+", ".", "e5", "1e", "", " "]


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def test_numbers_like_pandas(spark):
    values = [*ACCEPTED, *REFUSED]
    got = {r.t: r.n for r in texts(spark, values).select("t", clean.safe_numeric("t").alias("n")).collect()}
    assert {v: got[v] for v in ACCEPTED} == ACCEPTED
    assert all(got[v] is None for v in REFUSED)
    by_pandas = pd.to_numeric(pd.Series(values), errors="coerce")
    assert [got[v] for v in values] == [None if math.isnan(x) else x for x in by_pandas]


def test_never_nan_or_infinite(spark):
    df = texts(spark, ["NaN", "nan", "inf", "-inf", "Infinity", "1e400", "-1e400"])
    assert df.where(clean.safe_numeric("t").isNotNull()).count() == 0
    assert df.where(clean.safe_int("t").isNotNull()).count() == 0
    fitted = df.select(clean.number_sql and F.expr(clean.decimal_sql(clean.number_sql("t"), 12, 2)).alias("d"))
    assert fitted.where("d IS NOT NULL").count() == 0


def test_int_cuts_toward_zero(spark):
    df = texts(spark, ["1998.9", "-1.5", "2017.0", "99999999999", "x", None])
    assert [r[0] for r in df.select(clean.safe_int("t")).collect()] == [1998, -1, 2017, None, None, None]


def test_decimal_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.675,), (-2.675,), (0.005,), (1e11,), (9999999999.99,)], "n double")
    got = [r[0] for r in df.select(clean.safe_decimal("n", 12, 2)).collect()]
    assert [None if g is None else str(g) for g in got] == ["2.68", "-2.68", "0.01", None, "9999999999.99"]


def test_every_token_is_blanked_and_others_kept(spark):
    kept = ["na", "Null", " NA", "N/a", "0", "none"]
    df = texts(spark, [*clean.NULL_TOKENS, *kept])
    assert [r.t for r in clean.null_tokens(df).collect()] == [None] * len(clean.NULL_TOKENS) + kept


def test_tokens_match_the_csv_defaults_of_pandas():
    from pandas._libs.parsers import STR_NA_VALUES

    assert set(clean.NULL_TOKENS) == set(STR_NA_VALUES)


def test_tokens_only_in_chosen_columns_and_odd_names(spark):
    df = spark.createDataFrame([("NA", "NA")], ["a.b", "c d"])
    assert clean.null_tokens(df, ["a.b"]).collect()[0] == (None, "NA")
    assert clean.null_tokens(df, ["c d"], extra=["x"]).columns == ["a.b", "c d"]


@pytest.mark.parametrize("value,expected", [("Coal", "Coal"), ("coal", None), ("Peat", None), (None, None)])
def test_domain(spark, value, expected):
    assert texts(spark, [value]).select(clean.in_domain("t", ["Coal", "Gas"])).collect()[0][0] == expected


def test_map_values(spark):
    df = texts(spark, ["a", "b'", "c", None])
    got = df.select(clean.map_values("t", {"a": "1", "b'": "it's"})).collect()
    assert [r[0] for r in got] == ["1", "it's", None, None]
    same = df.select(clean.map_values("t", {"a": "a"})).collect()
    assert [r[0] for r in same] == ["a", None, None, None]


def test_map_values_from_table_keeps_all_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, t string")
    dictionary = spark.createDataFrame([("a", "A")], "k string, v string")
    got = clean.map_values_from(df, "t", dictionary, "k", "v")
    assert got.columns == ["id", "t"]
    assert sorted(got.collect()) == [(1, "A"), (2, None), (3, None)]


def test_fill_default_and_nan(spark):
    df = spark.createDataFrame([(None, float("nan"), 1), ("x", 2.0, 2)], "t string, d double, i int")
    assert [r[0] for r in df.select(clean.fill_default("t", "Unknown")).collect()] == ["Unknown", "x"]
    assert [tuple(r) for r in clean.nan_to_null(df).collect()] == [(None, None, 1), ("x", 2.0, 2)]
