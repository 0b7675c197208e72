"""Window semantics of the feature table on hand-made series."""

import datetime as dt
from decimal import Decimal

import pytest

from tillcast.config import Params
from tillcast.operators.features import build_features
from tillcast.operators.split import with_split

SCHEMA = ("store_id int, store_type string, store_size int, dept_id int, week_date date, "
          "weekly_sales decimal(18,2), isholiday boolean, temperature decimal(6,2), fuel_price decimal(6,3), "
          "markdown1 decimal(18,4), markdown2 decimal(18,4), markdown3 decimal(18,4), markdown4 decimal(18,4), "
          "markdown5 decimal(18,4), cpi decimal(10,7), unemployment decimal(6,3)")
P = Params(train_end="2000-01-21", val_end="2000-12-31")


def row(d, sales, hol=False, md1=None):
    s = None if sales is None else Decimal(str(sales))
    m = None if md1 is None else Decimal(str(md1))
    return (1, "A", 1000, 1, d, s, hol, Decimal("50.00"), Decimal("2.500"), m, None, None, None, None,
            Decimal("200.0000000"), Decimal("7.000"))


@pytest.fixture()
def feats(spark):
    d0 = dt.date(2000, 1, 7)
    weeks = [d0 + dt.timedelta(weeks=k) for k in (0, 1, 2, 4, 5)]   # gap after the third row
    rows = [row(weeks[0], 10), row(weeks[1], -5, md1=3), row(weeks[2], 30, hol=False),
            row(weeks[3], None, hol=True), row(weeks[4], 50)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = build_features(with_split(df, P), P).orderBy("week_date").collect()
    return out


def test_clip_keeps_null_and_lags_count_rows(feats):
    assert [r["weekly_sales"] for r in feats] == [10.0, 0.0, 30.0, None, 50.0]
    # lag counts rows: the row after the gap sees the row before it
    assert [r["lag_1"] for r in feats] == [None, 10.0, 0.0, 30.0, None]
    assert feats[3]["lag_2"] == 0.0


def test_rolling_excludes_current_row(feats):
    assert feats[0]["rolling_mean_4"] is None
    assert feats[1]["rolling_mean_4"] == 10.0
    assert feats[1]["rolling_std_4"] is None            # one value: no sample std
    assert feats[2]["rolling_mean_4"] == pytest.approx(5.0)
    assert feats[4]["rolling_mean_4"] == pytest.approx(40.0 / 3)   # null skipped


def test_holiday_flags_reset_at_split_edges(feats):
    splits = [r["split"] for r in feats]
    assert splits == ["train", "train", "train", "val", "val"]
    # third row is the last train row: next week (val) is a holiday but the flag stays 0
    assert feats[2]["is_holiday_next1"] == 0
    assert feats[3]["is_holiday_prev1"] == 0
    assert feats[4]["is_holiday_prev1"] == 1
    assert feats[4]["within_7days_after_holiday"] == 1


def test_markdowns_filled(feats):
    assert feats[1]["markdown_total"] == 3.0 and feats[1]["has_markdown"] == 1
    assert feats[0]["markdown_total"] == 0.0 and feats[0]["has_markdown"] == 0
    assert feats[0]["week_of_year"] == 1 and feats[0]["year"] == 2000
