"""Sinks and sources (A2, A4-A9): partitioned writes prune on read, appends accumulate,
the fingerprint does not depend on line order or partitioning."""

import datetime as dt

from pyspark.sql import functions as F

from tillcast.sources import sinks
from tillcast.sources.fingerprint import fingerprint_lines, fingerprint_text
from tillcast.sources.raw import read_split_csv


def test_predictions_partitioned_by_model(spark, tmp_path):
    rows = [("Naive", 1, 1, dt.date(2000, 1, 7), 1.0), ("Moving Average (4 weeks)", 1, 1, dt.date(2000, 1, 7), 2.0)]
    df = spark.createDataFrame(rows, "model string, store_id int, dept_id int, week_date date, predicted_sales double")
    path = str(tmp_path / "preds")
    sinks.write_predictions(df, path)
    back = sinks.read_predictions(spark, path, ["Naive", "Never Written"])
    assert [r["model"] for r in back.collect()] == ["Naive"]
    assert "model_dir=Moving_Average_4_weeks" in " ".join(p.name for p in (tmp_path / "preds").iterdir())


def test_staging_append_and_truncate(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "dept_id int")
    path = str(tmp_path / "stg")
    sinks.append_staging(df, path)
    sinks.append_staging(df, path)
    assert spark.read.parquet(path).count() == 4
    sinks.truncate_staging(spark, path, df.schema)
    assert spark.read.parquet(path).count() == 0


def test_split_csv_roundtrip(spark, tmp_path):
    from tillcast.sources.raw import split_schema
    row = tuple(None for _ in split_schema().fields)
    df = spark.createDataFrame([(1, "A", 10, 2, dt.date(2000, 1, 7), 5.5, True) + row[7:]], split_schema())
    sinks.write_csv(df, str(tmp_path / "train"))
    back = read_split_csv(spark, str(tmp_path / "train")).first()
    assert back["week_date"] == dt.date(2000, 1, 7) and back["weekly_sales"] == 5.5 and back["isholiday"] is True


def test_fingerprint_is_order_free(spark, tmp_path):
    lines = [f"line {i}" for i in range(50)]
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.txt").write_text("\n".join(reversed(lines)) + "\n")
    a = fingerprint_text(spark, str(tmp_path / "a.txt")).first()
    b = fingerprint_text(spark, str(tmp_path / "b.txt")).first()
    c = fingerprint_lines(spark.createDataFrame([(x,) for x in lines], "value string").repartition(7)).first()
    assert a == b == c and a["n_lines"] == 50


def test_splits_written_partitioned(spark, tmp_path):
    rows = [(1, 1, dt.date(2000, 1, 7), "train"), (1, 1, dt.date(2001, 1, 5), "test")]
    df = spark.createDataFrame(rows, "store_id int, dept_id int, week_date date, split string")
    sinks.write_splits(df, str(tmp_path / "splits"))
    t = spark.read.parquet(str(tmp_path / "splits")).where(F.col("split") == "test")
    assert "PartitionFilters: [isnotnull(split" in t._jdf.queryExecution().executedPlan().toString()
    assert t.count() == 1


def test_ordered_fingerprint_sees_a_swap_and_joins(spark, tmp_path):
    import hashlib

    from tillcast.sources.fingerprint import BASES, PRIME, joined, ordered_fingerprint, ordered_fingerprint_text
    lines = [f"line {i % 7} of {i}" for i in range(300)]

    def plain(ls):
        return len(ls), "-".join(str(sum(int(hashlib.md5(x.encode()).hexdigest()[8 * k:8 * k + 8], 16) % PRIME * pow(b, i, PRIME)
                                         for i, x in enumerate(ls)) % PRIME) for k, b in enumerate(BASES))

    def of(ls, parts):
        df = spark.createDataFrame(list(enumerate(ls)), "at int, value string").repartition(parts)
        return tuple(ordered_fingerprint(df, ["at"]).first())

    assert of(lines, 1) == of(lines, 6) == plain(lines)
    assert of([lines[1], lines[0], *lines[2:]], 6) != plain(lines)
    assert joined(plain(lines[:90]), plain(lines[90:])) == plain(lines)
    assert tuple(ordered_fingerprint(spark.createDataFrame([], "at int, value string"), ["at"]).first()) == plain([])
    (tmp_path / "a.txt").write_text("\n".join(lines[:90]))
    (tmp_path / "b.txt").write_text("\n".join(lines[90:]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert tuple(ordered_fingerprint_text(spark, str(tmp_path)).first()) == plain(lines)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_tables_stored_by_series_need_no_exchange(spark, tmp_path):
    from tests.conftest import SMALL
    from tillcast.operators.features import build_features
    from tillcast.operators.split import with_split
    from tillcast.plans.feature_plans import view
    sv = with_split(view(spark, SMALL))
    path = str(tmp_path / "splits")
    sinks.write_by_series(sv, path, buckets=4)
    stored = sinks.read_by_series(spark, path)
    assert stored.schema.fieldNames() == sv.schema.fieldNames() and stored.count() == sv.count()
    built = build_features(stored)
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    assert sorted(map(str, built.collect())) == sorted(map(str, build_features(sv).collect()))
    # a session that did not write it names the layout again
    spark.sql(f"DROP TABLE {sinks._table_name(path)}")
    again = sinks.read_by_series(spark, path)
    assert "Exchange" not in build_features(again)._jdf.queryExecution().executedPlan().toString()
    sinks.write_by_series(sv.limit(10), path, buckets=2)                     # written anew
    assert sinks.read_by_series(spark, path).count() == 10
