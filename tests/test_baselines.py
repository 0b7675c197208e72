"""Forecast rules on hand-made series: null rules (T4), first match (S5), hybrid fall-through."""

import datetime as dt
from decimal import Decimal

import pytest

from tillcast.operators import baselines as bl

SCHEMA = "store_id int, dept_id int, week_date date, weekly_sales decimal(18,2), isholiday boolean"


def d(y, m, day):
    return dt.date(y, m, day)


def frame(spark, rows):
    return spark.createDataFrame([(s, k, w, None if v is None else Decimal(str(v)), False) for s, k, w, v in rows],
                                 SCHEMA)


def preds(spark, train, actual, name):
    g = bl.forecast_grid(train, actual)
    return {(r["store_id"], r["dept_id"], r["week_date"]): r["predicted_sales"]
            for r in bl.predictions(g, name).collect()}


def test_last_value_rules(spark):
    # series (1,1) ends with a null sale
    train = frame(spark, [(1, 1, d(1999, 1, 1), 5), (1, 1, d(1999, 1, 8), 7), (1, 1, d(1999, 1, 15), None)])
    actual = frame(spark, [(1, 1, d(1999, 6, 4), 1)])
    key = (1, 1, d(1999, 6, 4))
    assert preds(spark, train, actual, bl.NAIVE)[key] == 7.0               # last non-null
    assert key not in preds(spark, train, actual, bl.SEASONAL_NAIVE)        # fallback is the null last row
    assert preds(spark, train, actual, bl.MOVING_AVERAGE)[key] == 6.0       # nulls skipped
    assert preds(spark, train, actual, bl.HYBRID)[key] == 6.0               # rule 4: series mean


def test_seasonal_first_match_and_average(spark):
    # 2010-01-01 and 2010-12-31 are both in calendar year 2010; ISO weeks 53 and 52
    rows = [(1, 1, d(2008, 1, 4), 10), (1, 1, d(2009, 1, 2), 20), (1, 1, d(2010, 1, 8), 30),
            (1, 1, d(2010, 1, 15), 40)]
    train = frame(spark, rows)
    actual = frame(spark, [(1, 1, d(2011, 1, 7), 1)])                       # ISO week 1 of 2011
    key = (1, 1, d(2011, 1, 7))
    assert preds(spark, train, actual, bl.SEASONAL_NAIVE)[key] == 30.0      # 2010, week 1
    # same ISO week in earlier years: 2008-01-04 (w1), 2010-01-08 (w1); 2009-01-02 is w1 too
    assert preds(spark, train, actual, bl.SEASONAL_AVERAGE)[key] == pytest.approx(20.0)
    # hybrid: fewer than 52 rows; 3 same-week rows -> mean of all of them
    assert preds(spark, train, actual, bl.HYBRID)[key] == pytest.approx(20.0)


def test_duplicate_calendar_week_takes_first_by_date(spark):
    train = frame(spark, [(1, 1, d(2010, 1, 4), 11), (1, 1, d(2010, 1, 5), 99)])   # both ISO week 1
    actual = frame(spark, [(1, 1, d(2011, 1, 4), 1)])
    assert preds(spark, train, actual, bl.SEASONAL_NAIVE)[(1, 1, d(2011, 1, 4))] == 11.0


def test_series_absent_from_train_gets_no_forecast(spark):
    train = frame(spark, [(1, 1, d(1999, 1, 1), 5)])
    actual = frame(spark, [(2, 2, d(1999, 6, 4), 1), (1, 1, d(1999, 6, 4), 1)])
    p = preds(spark, train, actual, bl.NAIVE)
    assert set(p) == {(1, 1, d(1999, 6, 4))}
