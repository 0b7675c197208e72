"""Registered queries: ingest, checks, contract, merges, fingerprint (A1, A9, B1-B8, B21, C1, C3,
D1, D2, D25, J1-J5, K1-K4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.operators import checks as ck
from tillcast.operators import ingest as ig
from tillcast.operators import merge as mg
from tillcast.plans.feature_plans import FEATURE_CTES, features, shared_features, shared_view
from tillcast.session import durable
from tillcast.plans.registry import register, with_base
from tillcast.schemas import (CONTRACT_DOUBLE_REQUIRED, CONTRACT_FLAGS, CONTRACT_INT_REQUIRED,
                              CONTRACT_RANGES, FACT, KEYS, MARKDOWNS, RAW_TRAIN)
from tillcast.sources import fixtures as fx
from tillcast.sources.fingerprint import BASES, PLACE_BITS, PRIME, fingerprint_lines, ordered_fingerprint, squares, table_lines
from tillcast.sources.raw import raw_from_view

EXPECTED = {"dim_store": 5}   # regions: fixed by the generator's spec; others only non-empty


def star(spark, sf):
    """Fact materialised once: the suite reads it in six checks."""
    fact = durable(fx.fact_sales(spark, sf))
    return fact, fx.dim_store(spark, sf), fx.dim_dept(spark, sf)


def suite(spark, sf):
    """The suite over the fact with planted faults, so that each check has something to find."""
    fact, stores, depts = star(spark, sf)
    fact = durable(fx.defective(fact))
    return ck.validation_suite(fact, stores, depts, expected=EXPECTED, view=fx.analytics_view(spark, sf, fact))


def staged(spark, sf):
    return ig.ingest(*raw_from_view(shared_view(spark, sf)))


SUITE_SQL_CTES = fx.DEFECT_CTES + """,
checks AS (
  SELECT 'row_count_dim_store' AS "check", COUNT(*) = 5 AS passed, 'error' AS severity, CAST(COUNT(*) AS VARCHAR) AS value FROM dim_store
  UNION ALL SELECT 'row_count_dim_dept', COUNT(*) > 0, 'error', CAST(COUNT(*) AS VARCHAR) FROM dim_dept
  UNION ALL SELECT 'row_count_fact', COUNT(*) > 0, 'error', CAST(COUNT(*) AS VARCHAR) FROM bad
  UNION ALL SELECT 'row_count_view', COUNT(*) = (SELECT COUNT(*) FROM bad), 'error', CAST(COUNT(*) AS VARCHAR) FROM bad JOIN dim_store USING (store_id) JOIN dim_dept USING (dept_id)
  UNION ALL SELECT 'null_values', n = 0, 'error', CAST(n AS VARCHAR) FROM (SELECT
      COUNT(*) FILTER (WHERE store_id IS NULL) + COUNT(*) FILTER (WHERE dept_id IS NULL)
      + COUNT(*) FILTER (WHERE week_date IS NULL) + COUNT(*) FILTER (WHERE weekly_sales IS NULL) AS n FROM bad)
  UNION ALL SELECT 'duplicate_keys', COUNT(*) = 0, 'error', CAST(COUNT(*) AS VARCHAR) FROM (
      SELECT 1 FROM bad GROUP BY store_id, dept_id, week_date HAVING COUNT(*) > 1)
  UNION ALL SELECT 'foreign_keys', COUNT(*) = 0, 'error', CAST(COUNT(*) AS VARCHAR) FROM (
      SELECT 1 FROM bad f WHERE NOT EXISTS (SELECT 1 FROM dim_store s WHERE s.store_id = f.store_id)
      UNION ALL SELECT 1 FROM bad f WHERE NOT EXISTS (SELECT 1 FROM dim_dept d WHERE d.dept_id = f.dept_id))
  UNION ALL SELECT 'date_range', TRUE, 'warning', CAST(MIN(week_date) AS VARCHAR) || ' .. ' || CAST(MAX(week_date) AS VARCHAR) FROM bad
  UNION ALL SELECT 'negative_values', TRUE, 'warning', CAST(COUNT(*) FILTER (WHERE weekly_sales < 0) AS VARCHAR) FROM bad
)"""


@register("j1_validation_suite", with_base(SUITE_SQL_CTES, "SELECT * FROM checks"))
def q_suite(spark, sf):
    return suite(spark, sf)


@register("j1_suite_summary", with_base(SUITE_SQL_CTES, """
SELECT COUNT(*) FILTER (WHERE passed) AS n_passed, COUNT(*) AS n_checks,
  BOOL_AND(passed OR severity = 'warning') AS all_passed FROM checks"""))
def q_suite_summary(spark, sf):
    return ck.suite_summary(suite(spark, sf))


@register("j2_c3_orphans", with_base(fx.DEFECT_CTES, """
SELECT 'store_id' AS key, COUNT(*) AS n_orphans FROM bad f WHERE NOT EXISTS (SELECT 1 FROM dim_store s WHERE s.store_id = f.store_id)
UNION ALL SELECT 'dept_id', COUNT(*) FROM bad f WHERE NOT EXISTS (SELECT 1 FROM dim_dept d WHERE d.dept_id = f.dept_id)"""))
def q_orphans(spark, sf):
    fact, ds, dd = star(spark, sf)
    fact = fx.defective(fact)
    a = ck.orphans(fact, ds, "store_id").agg(F.lit("store_id").alias("key"), F.count(F.lit(1)).alias("n_orphans"))
    b = ck.orphans(fact, dd, "dept_id").agg(F.lit("dept_id").alias("key"), F.count(F.lit(1)).alias("n_orphans"))
    return a.unionByName(b)


@register("d1_row_counts", with_base("", """
SELECT 'dim_store' AS table_name, COUNT(*) AS n_rows FROM dim_store
UNION ALL SELECT 'dim_dept', COUNT(*) FROM dim_dept UNION ALL SELECT 'fact', COUNT(*) FROM fact"""))
def q_counts(spark, sf):
    fact, ds, dd = star(spark, sf)
    parts = [(n, d) for n, d in (("dim_store", ds), ("dim_dept", dd), ("fact", fact))]
    out = None
    for n, d in parts:
        c = d.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        out = c if out is None else out.unionByName(c)
    return out


@register("d2_null_counts", with_base("", "SELECT " + ", ".join(
    f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in ["store_id", "dept_id", "week_date", "weekly_sales", "isholiday"])
    + " FROM fact"))
def q_nulls(spark, sf):
    fact = fx.fact_sales(spark, sf)
    cols = ["store_id", "dept_id", "week_date", "weekly_sales", "isholiday"]
    return fact.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


# Faults that depend on the keys alone, planted in a batch of feature rows: (column, modulus, rest, value)
CONTRACT_FAULTS = [("store_size", 97, 1, "NULL"), ("week_of_year", 89, 2, "54"), ("isholiday", 83, 3, "NULL"), ("has_markdown", 79, 4, "2"),
                   ("fuel_price", 73, 5, "NULL"), ("store_type", 71, 6, "NULL"), ("month", 67, 7, "0"), ("cpi", 61, 8, "NULL")]
ABSENT = ["isholiday", "store_type", "year", "day_of_year", "is_holiday_next1", "markdown3"]


def _contract_sql() -> str:
    rules = [(f"{c} required", f"{c} IS NULL") for c in CONTRACT_INT_REQUIRED]
    rules.append(("store_type required", "store_type IS NULL"))
    rules.append(("isholiday required", "isholiday IS NULL"))
    rules += [(f"{c} outside {lo}-{hi}", f"({c} IS NULL OR {c} < {lo} OR {c} > {hi})") for c, (lo, hi) in CONTRACT_RANGES.items()]
    rules += [(f"{c} not 0/1", f"({c} IS NULL OR {c} NOT IN (0, 1))") for c in CONTRACT_FLAGS]
    rules += [(f"{c} required", f"{c} IS NULL") for c in CONTRACT_DOUBLE_REQUIRED]
    any_bad = " OR ".join(cond for _, cond in rules)
    faults = ", ".join(f"CASE WHEN h % {m} = {r} THEN {v} ELSE {c} END AS {c}" for c, m, r, v in CONTRACT_FAULTS)
    ctes = FEATURE_CTES + f""",
hashed AS (SELECT *, store_id * 31 + dept_id * 17 + datediff('day', DATE '1992-01-01', week_date) AS h FROM features),
planted AS (SELECT * REPLACE ({faults}) FROM hashed),
short AS (SELECT * REPLACE ({', '.join(f'NULL AS {c}' for c in ABSENT)}) FROM features)"""
    parts = []
    for batch, table in (("planted", "planted"), ("absent columns", "short")):
        parts.append(f"SELECT '{batch}' AS batch, 'valid' AS reason, COUNT(*) AS n_rows FROM {table} WHERE NOT ({any_bad})")
        parts += [f"SELECT '{batch}', '{name}', COUNT(*) FROM {table} WHERE {cond}" for name, cond in rules]
    return with_base(ctes, "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE n_rows > 0")


@register("j3_scoring_contract", _contract_sql())
def q_contract(spark, sf):
    """J3 as batch quarantine over the feature table: valid rows, and rejected rows per reason, of a
    batch with planted faults and of one without six required columns."""
    rows = durable(features(spark, sf))
    h = F.col("store_id") * 31 + F.col("dept_id") * 17 + F.datediff("week_date", F.lit("1992-01-01").cast("date"))
    planted = rows.withColumns({c: F.when(h % m == r, F.expr(v)).otherwise(F.col(c)) for c, m, r, v in CONTRACT_FAULTS})
    out = None
    for batch, frame in (("planted", planted), ("absent columns", rows.drop(*ABSENT))):
        judged = frame.select(ck.contract_reasons(frame).alias("reasons"))
        found = judged.select(F.explode(F.when(F.size("reasons") == 0, F.array(F.lit("valid"))).otherwise(F.col("reasons"))).alias("reason"))
        one = found.groupBy(F.lit(batch).alias("batch"), "reason").agg(F.count(F.lit(1)).alias("n_rows"))
        out = one if out is None else out.unionByName(one)
    return out


@register("j4_non_empty_batch", with_base(FEATURE_CTES, "SELECT COUNT(*) AS n_rows FROM features WHERE split = 'test'"))
def q_non_empty(spark, sf):
    """Raises on an empty batch; otherwise the batch's row count (rows-only check)."""
    f = ck.require_non_empty(shared_features(spark, sf).where(F.col("split") == "test"), "scoring batch")
    return f.agg(F.count(F.lit(1)).alias("n_rows"))


RAW_FEATURE_CTES = """
pf AS (SELECT store_id, week_date, isholiday, MIN(temperature) AS temperature, MIN(fuel_price) AS fuel_price,
  MIN(markdown1) AS markdown1, MIN(markdown2) AS markdown2, MIN(markdown3) AS markdown3,
  MIN(markdown4) AS markdown4, MIN(markdown5) AS markdown5, MIN(cpi) AS cpi, MIN(unemployment) AS unemployment
  FROM v GROUP BY store_id, week_date, isholiday),
stg AS (SELECT t.store_id, t.dept_id, t.week_date, CAST(t.weekly_sales AS DOUBLE) AS weekly_sales, t.isholiday,
  """ + ", ".join(f"CAST(pf.{c} AS DOUBLE) AS {c}" for c in ig.FEATURE_NUMERIC) + """
  FROM v t LEFT JOIN pf ON t.store_id = pf.store_id AND t.week_date = pf.week_date AND t.isholiday = pf.isholiday)"""


@register("b1_b8_c1_ingest_fact_rows", with_base(RAW_FEATURE_CTES, "SELECT * FROM stg"))
def q_ingest(spark, sf):
    """Raw all-string tables (derived from the view: 'NA' nulls, four flag spellings) typed with
    try-casts and left-joined on (store, week, flag): the staging fact rows."""
    _, _, fact_stg = staged(spark, sf)
    return fact_stg


# Lines with faults that depend on the keys alone: (modulus, rest, SQL of the line, what is said of it)
LINE = "concat_ws(',', store, dept, date, weekly_sales, isholiday)"
LINE_FAULTS = [(97, 1, "concat_ws(',', store, dept, date, weekly_sales)", "wrong number of fields"), (89, 2, LINE + " || ',more'", "wrong number of fields"),
               (83, 3, "concat_ws(',', store, dept, '2001-13-45', weekly_sales, isholiday)", "date unreadable"),
               (79, 4, "concat_ws(',', store, 'x' || dept, date, weekly_sales, isholiday)", "dept unreadable"), (73, 5, "'   '", "blank line"),
               (71, 6, "concat_ws(',', '', dept, date, weekly_sales, isholiday)", "store missing"),
               (67, 7, """concat_ws(',', store, dept, date, '"1,234"', isholiday)""", "accepted")]
LINE_HASH = "store_id * 31 + dept_id * 17 + datediff({})"


def _lines_sql() -> str:
    case = " ".join(f"WHEN h % {m} = {r} THEN '{why}'" for m, r, _, why in LINE_FAULTS)
    unread = next(f"h % {m} = {r}" for m, r, line, _ in LINE_FAULTS if '"' in line)
    return with_base("", f"""SELECT reason, COUNT(*) AS n_lines,
      CAST(SUM(CASE WHEN reason = 'accepted' AND NOT ({unread}) THEN CAST(ROUND(weekly_sales * 100) AS BIGINT) END) AS BIGINT) AS cents
    FROM (SELECT *, CASE {case} ELSE 'accepted' END AS reason FROM (SELECT *, {LINE_HASH.format("'day', DATE '1992-01-01', week_date")} AS h FROM v))
    GROUP BY reason""")


@register("a1_refused_lines", _lines_sql())
def q_refused_lines(spark, sf):
    """A1 / B8 on text: the train table as CSV lines with planted faults; lines refused by reason, and
    what the accepted ones hold."""
    v = shared_view(spark, sf)
    h = F.expr(LINE_HASH.format("week_date, DATE '1992-01-01'"))
    train = raw_from_view(v)[2].withColumn("isholiday", F.coalesce("isholiday", F.lit("")))
    keyed = train.withColumns({"store_id": F.col("store").cast("int"), "dept_id": F.col("dept").cast("int"), "week_date": F.col("date").cast("date")})
    line = F.expr(LINE)
    for m, r, text, _ in reversed(LINE_FAULTS):
        line = F.when(F.col("h") % m == r, F.expr(text)).otherwise(line)
    lines = durable(keyed.withColumn("h", h).select(line.alias("value")))
    rows, refused = ig.accepted_and_refused(lines, RAW_TRAIN, FACT, KEYS)
    cents = F.rint(F.col("weekly_sales") * 100).cast("long")
    good = ig.typed_train(rows).agg(F.lit("accepted").alias("reason"), F.count(F.lit(1)).alias("n_lines"), F.sum(cents).alias("cents"))
    bad = refused.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"))
    return good.unionByName(bad.withColumn("cents", F.lit(None).cast("long")))


@register("d25_staged_dimensions", with_base("", """
SELECT 'store' AS dim, COUNT(*) AS n_rows, CAST(SUM(store_size) AS BIGINT) AS size_total FROM dim_store
UNION ALL SELECT 'dept', COUNT(*), NULL FROM (SELECT DISTINCT dept_id FROM v)"""))
def q_staged_dims(spark, sf):
    st, dp, _ = staged(spark, sf)
    a = st.agg(F.lit("store").alias("dim"), F.count(F.lit(1)).alias("n_rows"),
               F.sum("store_size").cast("bigint").alias("size_total"))
    b = dp.agg(F.lit("dept").alias("dim"), F.count(F.lit(1)).alias("n_rows"),
               F.lit(None).cast("bigint").alias("size_total"))
    return a.unionByName(b)


@register("j5_staging_violations", with_base(fx.DEFECT_CTES, """
SELECT 'null key' AS reason, COUNT(*) AS n_violations FROM bad WHERE store_id IS NULL OR dept_id IS NULL OR week_date IS NULL
UNION ALL SELECT 'cpi out of range', COUNT(*) FROM bad WHERE ABS(cpi) >= 1e3"""))
def q_violations(spark, sf):
    v = ck.staging_range_violations(fx.defective(fx.fact_sales(spark, sf)))
    return v.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n_violations"))


# -- merges: target = rows up to mid-2000, staging = restated rows from 2000 on --------------
# Fixed values of the merge scenario
TARGET_END = "2000-06-30"
STAGING_START = "2000-01-01"
FACT_COLS = ["store_id", "dept_id", "week_date", "weekly_sales", "isholiday", "temperature",
             "fuel_price", *MARKDOWNS, "cpi", "unemployment"]


def merge_inputs(spark, sf):
    fact = durable(fx.fact_sales(spark, sf))
    target = fact.where(F.col("week_date") <= F.lit(TARGET_END).cast("date"))
    staging = (fact.where(F.col("week_date") >= F.lit(STAGING_START).cast("date"))
               .withColumn("weekly_sales", (F.col("weekly_sales") + F.lit(1)).cast("decimal(18,2)"))
               .withColumn("markdown1", F.when(~F.col("isholiday"), F.col("markdown1")).cast("decimal(18,4)")))
    return target, staging


MERGE_CTES = f"""
tgt AS (SELECT * FROM fact WHERE week_date <= DATE '{TARGET_END}'),
stgm AS (SELECT store_id, dept_id, week_date, CAST(weekly_sales + 1 AS DECIMAL(18,2)) AS weekly_sales, isholiday,
    temperature, fuel_price, CAST(CASE WHEN NOT isholiday THEN markdown1 END AS DECIMAL(18,4)) AS markdown1,
    markdown2, markdown3, markdown4, markdown5, cpi, unemployment
  FROM fact WHERE week_date >= DATE '{STAGING_START}'),
merged AS (
  SELECT t.* FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM stgm s WHERE s.store_id = t.store_id
      AND s.dept_id = t.dept_id AND s.week_date = t.week_date)
  UNION ALL SELECT * FROM stgm)"""


@register("k3_upsert_fact", with_base(MERGE_CTES, "SELECT " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" if c in ("weekly_sales", *MARKDOWNS, "temperature", "fuel_price", "cpi", "unemployment")
    else c for c in FACT_COLS) + " FROM merged"))
def q_upsert_fact(spark, sf):
    """K3 (+K4): staged row wins whole, staged nulls overwrite, new keys inserted."""
    target, staging = merge_inputs(spark, sf)
    m = mg.upsert_fact(target, staging, FACT_COLS)
    return m.select(*[F.col(c).cast("double").alias(c) if c in ("weekly_sales", *MARKDOWNS, "temperature",
                      "fuel_price", "cpi", "unemployment") else F.col(c) for c in FACT_COLS])


@register("k4_staging_duplicate_keys", with_base(fx.DEFECT_CTES, f"""
SELECT store_id, dept_id, week_date, COUNT(*) AS n_rows FROM bad WHERE week_date >= DATE '{STAGING_START}'
GROUP BY store_id, dept_id, week_date HAVING COUNT(*) > 1"""))
def q_stage_dups(spark, sf):
    """K4: the duplicate keys for which an update merge of this staging is refused."""
    from tillcast.operators.eda import duplicate_groups
    staging = fx.defective(fx.fact_sales(spark, sf)).where(F.col("week_date") >= F.lit(STAGING_START).cast("date"))
    return duplicate_groups(staging)


@register("k1_upsert_store", with_base("""
tgt_s AS (SELECT store_id, store_type, store_size - 1000 AS store_size FROM dim_store WHERE store_id <= 4)""", """
SELECT t.* FROM tgt_s t WHERE NOT EXISTS (SELECT 1 FROM dim_store s WHERE s.store_id = t.store_id)
UNION ALL SELECT DISTINCT store_id, store_type, store_size FROM dim_store"""))
def q_upsert_store(spark, sf):
    """K1: stale sizes of stores 1-4 overwritten, store 5 inserted."""
    ds = fx.dim_store(spark, sf)
    target = ds.where(F.col("store_id") <= 4).withColumn("store_size", F.col("store_size") - 1000)
    return mg.upsert_store(target, ds)


@register("k2_insert_depts", with_base("", """
SELECT dept_id FROM dim_dept WHERE dept_id <= 20
UNION ALL SELECT dept_id FROM dim_dept d WHERE NOT EXISTS (SELECT 1 FROM dim_dept t WHERE t.dept_id = d.dept_id AND t.dept_id <= 20)"""))
def q_insert_depts(spark, sf):
    """K2: departments 1-20 known, the rest inserted, none duplicated."""
    dd = fx.dim_dept(spark, sf)
    return mg.insert_missing_depts(dd.where(F.col("dept_id") <= 20), dd)


FP_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
           "l_returnflag", "l_linestatus", "l_shipdate"]
# Renderings that both engines write alike: money in hundredths, dates in days
FP_SQL = {c: f"CAST(CAST(ROUND({c} * 100) AS BIGINT) AS VARCHAR)" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")}
FP_SQL |= {"l_shipdate": "CAST(datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS VARCHAR)"}
FP_LINE = "concat_ws('|', " + ", ".join(FP_SQL.get(c, f"CAST({c} AS VARCHAR)") for c in FP_COLS) + ")"


def fingerprint_rows(spark, sf):
    """Every column of every line item, as text lines."""
    li = fx.table(spark, sf, "lineitem")
    li = li.withColumns({c: F.rint(F.col(c) * 100).cast("long") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")})
    return table_lines(li.withColumn("l_shipdate", F.unix_date(F.to_date("l_shipdate"))), FP_COLS)


@register("a9_source_fingerprint", with_base("", f"""
SELECT COUNT(*) AS n_lines,
  concat_ws('-', {', '.join(f"CAST(SUM(CAST(('0x' || substr(md5(line), {i}, 8)) AS BIGINT)) AS VARCHAR)" for i in (1, 9, 17, 25))}) AS digest
FROM (SELECT {FP_LINE} AS line FROM lineitem)"""))
def q_fingerprint(spark, sf):
    """Line count and order-free digest of a text rendering of lineitem."""
    return fingerprint_lines(fingerprint_rows(spark, sf))


LINE_ORDER = ["l_orderkey", "l_linenumber", "value"]


def _lane_sql(k: int, base: int) -> str:
    power = (f"list_reduce([CAST(1 AS BIGINT)] || list_transform(range(0, {PLACE_BITS}), lambda b: CASE WHEN (at_ >> b) % 2 = 1 "
             f"THEN {squares(base)}[b + 1] ELSE 1 END), lambda x, y: x * y % {PRIME})")
    return f"CAST(SUM(CAST(('0x' || substr(md5(line), {8 * k + 1}, 8)) AS BIGINT) % {PRIME} * {power} % {PRIME}) % {PRIME} AS VARCHAR)"


@register("a9_ordered_fingerprint", with_base("", f"""
SELECT COUNT(*) AS n_lines, concat_ws('-', {', '.join(_lane_sql(k, b) for k, b in enumerate(BASES))}) AS digest
FROM (SELECT line, ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber, line) - 1 AS at_ FROM (SELECT l_orderkey, l_linenumber, {FP_LINE} AS line FROM lineitem))"""))
def q_ordered_fingerprint(spark, sf):
    """Digest of the line items as text lines in their order; two lines swapped change it."""
    lines = fingerprint_rows(spark, sf).withColumns({"l_orderkey": F.split("value", r"\|")[0].cast("long"), "l_linenumber": F.split("value", r"\|")[3].cast("int")})
    return ordered_fingerprint(lines, LINE_ORDER)


@register("b21_safe_model_names", with_base("""
sv AS (SELECT 1)""", """
SELECT model, regexp_replace(regexp_replace(model, '[ +/]', '_', 'g'), '[()]', '', 'g') AS model_dir FROM (VALUES """ + ", ".join(
    f"('{n}')" for n in ["Naive", "Seasonal Naive", "Moving Average (4 weeks)", "Seasonal Average (k=3)", "Hybrid Fallback"])
    + ") t(model)"))
def q_safe_names(spark, sf):
    """File-safe names of the models that produced validation forecasts."""
    from tillcast.functions.scalars import safe_name
    from tillcast.plans.forecast_plans import all_val_predictions
    preds, _ = all_val_predictions(spark, sf)
    return preds.select("model").distinct().select("model", safe_name(F.col("model")).alias("model_dir"))


__all__ = ["KEYS"]


@register("h10_line_sha256", with_base("", f"""
SELECT COUNT(*) AS n_lines, MIN(sha256(line)) AS first_digest, MAX(sha256(line)) AS last_digest
FROM (SELECT {FP_LINE} AS line FROM lineitem)"""))
def q_sha(spark, sf):
    """sha256 per line of the same rendering; the smallest and largest digest (no shuffle of rows)."""
    from tillcast.functions.scalars import line_digest
    d = fingerprint_rows(spark, sf).select(line_digest(F.col("value")).alias("h"))
    return d.agg(F.count(F.lit(1)).alias("n_lines"), F.min("h").alias("first_digest"), F.max("h").alias("last_digest"))
