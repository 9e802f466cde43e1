from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions import labels
from millrace.functions.clean import col


def one(spark, value, kind, make):
    return spark.createDataFrame([(value,)], f"v {kind}").select(make(col("v"))).collect()[0][0]


@pytest.mark.parametrize(
    "value,expected",
    [
        ("999.49", "999 MW"),
        ("999.50", "1000 MW"),
        ("1000", "1.0 GW"),
        ("1049.99", "1.0 GW"),
        ("1050.00", "1.1 GW"),
        ("22500", "22.5 GW"),
        ("98.5", "99 MW"),
        ("0", "0 MW"),
        ("-12.50", "-13 MW"),
    ],
)
def test_capacity(spark, value, expected):
    assert one(spark, Decimal(value), "decimal(12,2)", labels.capacity_label) == expected


@pytest.mark.parametrize(
    "value,expected", [("1234567.50", "1,234,567.5"), ("34936.00", "34,936"), ("0.05", "0.05"), ("-1000", "-1,000")]
)
def test_number(spark, value, expected):
    assert one(spark, Decimal(value), "decimal(12,2)", labels.number_label) == expected


@pytest.mark.parametrize("value,expected", [(None, "Unknown"), ("", "Unknown"), ("0", "0"), ("x", "x")])
def test_text_default(spark, value, expected):
    assert one(spark, value, "string", labels.display_default) == expected


@pytest.mark.parametrize("value,expected", [(None, "Unknown"), (0, "Unknown"), (1998, "1998")])
def test_number_default(spark, value, expected):
    assert one(spark, value, "int", lambda c: labels.display_default(c, number=True)) == expected


def test_coordinates(spark):
    row = spark.createDataFrame([(Decimal("12.345650"), Decimal("-0.5"))], "a decimal(10,6), b decimal(11,6)").select(
        labels.coordinate_label(col("a"), col("b"), 4), labels.map_query(col("a"), col("b")), F.lit(1)
    ).collect()[0]
    assert row[0] == "12.3457, -0.5000"
    assert row[1] == "?q=12.345650,-0.500000"
