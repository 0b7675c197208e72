"""Scoring contract (J3/J4, the reference's request cases), merges (K1-K4), ingest."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillcast.operators import checks, ingest, merge
from tillcast.operators.scoring import score_batch, type_inputs
from tillcast.schemas import CONTRACT_NULLABLE, MODEL_INPUTS
from tillcast.sources.raw import read_raw_csv
from tillcast.schemas import RAW_FEATURES, RAW_STORES, RAW_TRAIN

KNOWN = dict(store_id=1, dept_id=1, store_type="A", store_size=151315, week_of_year=5, month=2, year=2010,
             day_of_year=36, isholiday=False, is_holiday_prev1=0, is_holiday_next1=0,
             within_7days_after_holiday=0, within_7days_before_holiday=0, temperature=42.31,
             fuel_price=2.572, cpi=211.0963, unemployment=8.106, markdown1=0.0, markdown2=0.0,
             markdown3=0.0, markdown4=0.0, markdown5=0.0, markdown_total=0.0, has_markdown=0)


def batch(spark, rows):
    cols = ["row_id"] + MODEL_INPUTS
    data = [tuple([i] + [r.get(c) for c in MODEL_INPUTS]) for i, r in enumerate(rows)]
    raw = spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols))
    return type_inputs(raw)


def reasons(spark, rows):
    valid, rejected = checks.apply_contract(batch(spark, rows))
    return valid.count(), [r["reasons"] for r in rejected.orderBy("row_id").collect()]


def test_known_row_is_valid_with_absent_lags(spark):
    assert all(c not in KNOWN for c in CONTRACT_NULLABLE)
    assert reasons(spark, [KNOWN]) == (1, [])


@pytest.mark.parametrize("change,reason", [
    ({"store_id": "abc"}, "store_id required"),
    ({"week_of_year": 0}, "week_of_year outside 1-53"),
    ({"week_of_year": 54}, "week_of_year outside 1-53"),
    ({"store_type": None}, "store_type required"),
    ({"isholiday": None}, "isholiday required"),
])
def test_rejected_rows(spark, change, reason):
    n_valid, rs = reasons(spark, [dict(KNOWN, **change)])
    assert n_valid == 0 and reason in rs[0]


def test_two_rows_and_empty_batch(spark):
    assert reasons(spark, [KNOWN, dict(KNOWN, dept_id=2)])[0] == 2
    empty = batch(spark, [KNOWN]).where(F.lit(False))
    with pytest.raises(ValueError):
        checks.require_non_empty(empty)


def test_scoring_types_first_and_keeps_bad_rows_as_reasons(spark):
    bad = [KNOWN, dict(KNOWN, store_id="abc"), dict(KNOWN, month="x"), dict(KNOWN, lag_1="junk"), dict(KNOWN, store_type=123),
           dict(KNOWN, isholiday=None)]
    cols = ["row_id"] + MODEL_INPUTS
    raw = spark.createDataFrame([tuple([i] + [None if r.get(c) is None else str(r[c]) for c in MODEL_INPUTS]) for i, r in enumerate(bad)],
                                "row_id int, " + ", ".join(f"`{c}` string" for c in cols[1:]))
    scored, rejected = score_batch(raw, lambda t: t.select("row_id", F.lit(1.0).alias("predicted_sales")))
    assert [r["row_id"] for r in scored.collect()] == [0]
    why = {r["row_id"]: r["reasons"] for r in rejected.collect()}
    assert "store_id unreadable" in why[1] and "month unreadable" in why[2] and why[3] == ["lag_1 unreadable"]
    assert why[4] == ["store_type not text"] and why[5] == ["isholiday required"]


def test_absent_columns_are_refused_or_null(spark):
    lags = [c for c in MODEL_INPUTS if c in CONTRACT_NULLABLE]
    raw = spark.createDataFrame([(0, *[str(KNOWN[c]) for c in MODEL_INPUTS if c in KNOWN])],
                                ", ".join(["row_id int", *[f"`{c}` string" for c in MODEL_INPUTS if c in KNOWN]]))
    assert not set(lags) & set(raw.columns)
    scored, rejected = score_batch(raw, lambda t: t.select("row_id", (F.coalesce("lag_1", F.lit(1.0))).alias("predicted_sales")))
    assert [r["predicted_sales"] for r in scored.collect()] == [1.0] and rejected.count() == 0
    for gone, why in (("isholiday", "isholiday required"), ("store_type", "store_type required"), ("store_id", "store_id required"),
                      ("month", "month outside 1-12"), ("has_markdown", "has_markdown not 0/1"), ("cpi", "cpi required")):
        scored, rejected = score_batch(raw.drop(gone), lambda t: t.select("row_id", F.lit(1.0).alias("predicted_sales")))
        assert scored.count() == 0 and rejected.first()["reasons"] == [why]


def test_range_check_covers_every_numeric_column(spark):
    row = dict(store_id=1, dept_id=1, week_date=dt.date(2010, 2, 5), weekly_sales=1.0, temperature=1.0, fuel_price=1.0, markdown1=1.0,
               markdown2=1.0, markdown3=1.0, markdown4=1.0, markdown5=1.0, cpi=1.0, unemployment=1.0)
    wrong = [dict(row, **{c: 1e11}) for c in checks.WHOLE_DIGITS] + [dict(row, dept_id=None), row]
    bad = checks.staging_range_violations(spark.createDataFrame(
        [tuple(r.values()) for r in wrong], ", ".join(f"{c} {'int' if c.endswith('_id') else 'date' if c == 'week_date' else 'double'}" for c in row)))
    assert len(checks.WHOLE_DIGITS) == 10 and bad.count() == 11


def test_two_staged_rows_of_one_store_are_an_error(spark):
    s = "store_id int, store_type string, store_size int"
    with pytest.raises(ValueError):
        merge.upsert_store(spark.createDataFrame([], s), spark.createDataFrame([(1, "A", 1), (1, "B", 1)], s))
    assert merge.upsert_store(spark.createDataFrame([], s), spark.createDataFrame([(1, "A", 1), (1, "A", 1)], s)).count() == 1


FACT = "store_id int, dept_id int, week_date date, weekly_sales decimal(12,2), markdown1 decimal(12,2)"


def test_upsert_cases(spark):
    d = dt.date(2012, 1, 6)
    target = spark.createDataFrame([(1, 1, d, Decimal("10"), Decimal("1")), (1, 2, d, Decimal("20"), Decimal("2")),
                                    (1, 3, d, Decimal("30"), Decimal("3"))], FACT)
    staging = spark.createDataFrame([(1, 2, d, Decimal("21"), None), (1, 4, d, Decimal("40"), Decimal("4"))], FACT)
    out = {r["dept_id"]: r for r in merge.upsert_fact(target, staging, target.columns).collect()}
    assert sorted(out) == [1, 2, 3, 4]                      # unchanged, changed, unchanged, new
    assert out[2]["weekly_sales"] == Decimal("21.00") and out[2]["markdown1"] is None   # staged null wins
    dup = staging.unionByName(staging.limit(1))
    with pytest.raises(ValueError):
        merge.upsert_fact(target, dup, target.columns)


def test_store_and_dept_merges(spark):
    t = spark.createDataFrame([(1, "A", 100), (2, "B", 200)], "store_id int, store_type string, store_size int")
    s = spark.createDataFrame([(2, "C", 250), (3, "A", 300)], "store_id int, store_type string, store_size int")
    assert sorted(tuple(r) for r in merge.upsert_store(t, s).collect()) == [(1, "A", 100), (2, "C", 250), (3, "A", 300)]
    td = spark.createDataFrame([(1,), (2,)], "dept_id int")
    sd = spark.createDataFrame([(2,), (3,), (3,)], "dept_id int")
    assert sorted(r[0] for r in merge.insert_missing_depts(td, sd).collect()) == [1, 2, 3]


def test_ingest_raw_csv(spark, tmp_path):
    (tmp_path / "stores.csv").write_text(" Store ,TYPE,Size\n1,A,100\n1,A,100\n2,Bx,200\n")
    (tmp_path / "features.csv").write_text(
        "Store,Date,Temperature,Fuel_Price,MarkDown1,MarkDown2,MarkDown3,MarkDown4,MarkDown5,CPI,Unemployment,IsHoliday\n"
        "1,2010-02-05,42.31,2.572,NA,NA,NA,NA,NA,211.09,8.1,FALSE\n"
        "1,2010-02-05,43.00,2.572,NA,NA,NA,NA,NA,211.09,8.1,false\n"
        "1,2010-02-12,38.51,2.548,5.5,NA,NA,NA,NA,211.24,8.1,TRUE\n")
    (tmp_path / "train.csv").write_text(
        "Store,Dept,Date,Weekly_Sales,IsHoliday\n"
        "1,1,2010-02-05,24924.5,0\n1,1,2010-02-12,46039.49,1\n1,,2010-02-19,100,false\n"
        "1,2,2010-02-30,5,false\n1,3,2010-02-12,7,junk\n")
    raw = [read_raw_csv(spark, str(tmp_path / f), s) for f, s in
           (("stores.csv", RAW_STORES), ("features.csv", RAW_FEATURES), ("train.csv", RAW_TRAIN))]
    assert raw[0].columns == ["store", "type", "size"]
    stores, depts, fact = ingest.ingest(*raw)
    assert sorted(tuple(r) for r in stores.collect()) == [(1, "A", 100), (2, "B", 200)]
    rows = fact.orderBy("dept_id", "week_date", "temperature").collect()
    # dept 1 week 1 fans out over the repeated feature row; null dept and bad date dropped
    assert [(r["dept_id"], str(r["week_date"]), r["temperature"]) for r in rows] == [
        (1, "2010-02-05", 42.31), (1, "2010-02-05", 43.0), (1, "2010-02-12", 38.51), (3, "2010-02-12", None)]
    assert rows[2]["markdown1"] == 5.5 and rows[0]["markdown1"] is None
    assert rows[3]["isholiday"] is None                      # junk flag: null, never matches
    assert sorted(r[0] for r in depts.collect() if r[0] is not None) == [1, 2, 3]


def test_lines_that_are_no_rows_are_refused_with_reasons(spark, tmp_path):
    (tmp_path / "stores.csv").write_text("Store,Type,Size\n1,A,100\n2,B\n,C,5\nx,C,5\n")
    (tmp_path / "features.csv").write_text(
        "Store,Date,Temperature,Fuel_Price,MarkDown1,MarkDown2,MarkDown3,MarkDown4,MarkDown5,CPI,Unemployment,IsHoliday\n"
        "1,2010-02-05,42.31,2.572,NA,NA,NA,NA,NA,211.1,8.1,FALSE\n1,2010-02-12,42.31,2.572,NA,NA,NA,NA,211.1,8.1,TRUE\n")
    (tmp_path / "train.csv").write_text(
        "Store,Dept,Date,Weekly_Sales,IsHoliday\n1,1,2010-02-05,\"24,924.50\",FALSE\n1,1,2010-02-12,46039.49,TRUE\n1,1,2010-02-19,41595.55\n"
        "\n1,1,2010-02-30,3,FALSE\nx,,2010-02-26,1,FALSE\n1,2,2010-03-05,5,FALSE,6\n")
    lines = [spark.read.text(str(tmp_path / f)) for f in ("stores.csv", "features.csv", "train.csv")]
    (stores, depts, fact), refused = ingest.ingest_lines(*lines)
    assert [tuple(r) for r in stores.collect()] == [(1, "A", 100)] and [r.dept_id for r in depts.collect()] == [1]
    got = {r.week_date: (r.weekly_sales, r.temperature) for r in fact.collect()}
    assert got == {dt.date(2010, 2, 5): (None, 42.31), dt.date(2010, 2, 12): (46039.49, None)}
    why = sorted((r.table, r.line, r.reasons) for r in refused.collect())
    assert [(t, x) for t, _, x in why] == [
        ("features", ["wrong number of fields"]), ("stores", ["store missing"]), ("stores", ["wrong number of fields"]), ("stores", ["store unreadable"]),
        ("train", ["blank line"]), ("train", ["wrong number of fields"]), ("train", ["date unreadable"]), ("train", ["wrong number of fields"]),
        ("train", ["store unreadable", "dept missing"])]
