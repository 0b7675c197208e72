"""Scalar helpers under ANSI mode (T1, T2): bad input becomes null, never an error."""

import datetime as dt

from pyspark.sql import functions as F

from tillcast.functions import scalars as sc


def test_to_bool_spellings(spark):
    vals = ["TRUE", "false", "1", "0", "True", "", "junk", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(sc.to_bool("s")).collect()]
    assert got == [True, False, True, False, True, None, None, None]


def test_parse_date_and_try_cast(spark):
    df = spark.createDataFrame([("2010-02-05", "1.5"), ("2010-02-30", "NA"), ("05/02/2010", None)], "d string, x string")
    rows = df.select(sc.parse_date("d").alias("d"), sc.try_cast(F.col("x"), "double").alias("x")).collect()
    assert [r["d"] for r in rows] == [dt.date(2010, 2, 5), None, None]
    assert [r["x"] for r in rows] == [1.5, None, None]


def test_names_labels_and_first_char(spark):
    df = spark.createDataFrame([("Moving Average (4 weeks)", dt.date(2011, 11, 4), "Bx")], "m string, d date, t string")
    r = df.select(sc.safe_name("m").alias("n"), sc.month_label("d").alias("ym"), sc.first_char("t").alias("c")).first()
    assert r["n"] == "Moving_Average_4_weeks" and r["ym"] == "2011-11" and r["c"] == "B"
    assert sc.normalise_name("  Fuel Price ") == "fuel_price"


def test_holiday_weight_and_clip(spark):
    df = spark.createDataFrame([(True, -3.0), (False, 2.0), (None, None)], "h boolean, x double")
    rows = df.select(sc.holiday_weight("h", 5.0).alias("w"), sc.clip_at_zero("x").alias("c")).collect()
    assert [r["w"] for r in rows] == [5.0, 1.0, 1.0]
    assert [r["c"] for r in rows] == [0.0, 2.0, None]
