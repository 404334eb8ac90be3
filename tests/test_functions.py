import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricekit.functions import (clean_path, landed_cost, normalise_date_text, normalise_quarter,
                                parse_date_text, to_amount)


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x")).alias("y")).collect()]


def test_normalise_date_text(spark):
    got = one_col(spark, ["12-Nov-24", "12-NOV-24", "2024-11-12", "2-Nov-24", None, "05-Jan-95"],
                  normalise_date_text)
    # two-digit years land in 2000-2099 (Spark's yy), unparsable dd-MMM-yy text becomes NULL
    assert got == ["2024-11-12", "2024-11-12", "2024-11-12", None, None, "2095-01-05"]


def test_parse_date_text(spark):
    got = one_col(spark, ["2024-11-12", "12-Nov-24", "garbage", None], parse_date_text)
    assert got == [dt.date(2024, 11, 12), dt.date(2024, 11, 12), None, None]


def test_to_amount_is_lenient(spark):
    got = one_col(spark, [".5", "5", "0.00", "-1", "n/a", "", None], to_amount)
    assert got == [0.5, 5.0, 0.0, -1.0, None, None, None]


@pytest.mark.parametrize("path,expected", [
    ("2024q1,a,b", "a,b"),
    ("2024q1", None),
    ("2024Q1,a", "2024Q1,a"),
    ("core", "core"),
    (None, None),
    ("1998q2,x", "1998q2,x"),
])
def test_clean_path(spark, path, expected):
    assert one_col(spark, [path], clean_path) == [expected]


def test_normalise_quarter(spark):
    assert one_col(spark, ["2024q1", "2024Q1", "1998q4"], normalise_quarter) == \
        ["2024Q01", "2024Q01", "1998Q04"]


def test_landed_cost(spark):
    df = spark.createDataFrame(
        [("100", "10", "1", None, None, None, None), ("n/a", "5", "2", "3", "", ".5", "x")],
        "matrl_cost string, malad_cost string, vwrty_cost string, vtrdx_cost string, "
        "vrlty_cost string, ovblc_cost string, ofxdc_cost string")
    got = [r[0] for r in df.select(landed_cost()).collect()]
    assert got[0] == pytest.approx(111.0)
    assert got[1] == pytest.approx(0 * 1.05 + 2 + 3 + 0 + 0.5 + 0)
