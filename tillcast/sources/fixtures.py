"""Weekly star schema derived from the driver's TPC-H-like tables.

The test data has no weekly sales series, so the fact is built from
``lineitem`` (one row per line) joined to ``part`` (department = brand),
``supplier`` and ``nation`` (store = region).  It is one large map-side
partially-aggregated group-by: the shuffle carries at most one row per
(store, dept, week) per task, however large ``lineitem`` grows.

No broadcast hint is placed on ``part`` or ``supplier``: they grow with the
data, so Spark's size threshold (on estimated statistics) and AQE (on real
shuffle sizes) choose broadcast when they are small and sort-merge beyond.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.schemas import MARKDOWNS, VIEW_COLUMNS
from tillcast.session import broadcast_if_small

# Fixed values of the stand-in mapping
HOLIDAY_WEEKS = (6, 36, 47, 52)
MARKDOWN_START = "1998-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def friday_of_week(ts) -> F.Column:
    """Friday of the Monday-started week holding ``ts`` (integer date arithmetic)."""
    d = F.to_date(ts)
    return F.date_add(F.date_sub(d, (F.dayofweek(d) + 5) % 7), 4)


def store_of_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", (F.col("n_regionkey") + 1).alias("store_id")))


def _hundredths(c: str) -> F.Column:
    """A two-decimal double as an exact integer count of hundredths."""
    return F.rint(F.col(c) * 100).cast("long")


def _scaled(total: str, places: int, dtype: str) -> F.Column:
    """Exact decimal from an integer count of 10^-places units (one multiply per group)."""
    unit = F.lit(Decimal(1).scaleb(-places))
    return (F.col(total).cast("decimal(20,0)") * unit).cast(dtype)


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_sales_weekly: one row per (store_id, dept_id, week_date), decimals as stored.

    Per-row arithmetic is on longs (cents, percent points), so the aggregation
    buffers are primitive; the exact decimals are formed once per group."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.regexp_extract("p_brand", r"Brand#(\d+)", 1).cast("int").alias("dept_id"))
    rows = (li.join(part, F.col("l_partkey") == F.col("p_partkey"))
            .join(store_of_supplier(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
            .withColumn("week_date", friday_of_week(F.col("l_shipdate"))))
    cents = _hundredths("l_extendedprice")
    disc = _hundredths("l_discount")
    signed = F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") >= 6), -cents).otherwise(cents)
    aggs = [F.sum(signed).alias("_sales")]
    aggs += [F.sum(F.when(F.col("l_linenumber") == i, cents * disc)).alias(f"_md{i}")
             for i in range(1, len(MARKDOWNS) + 1)]
    aggs += [
        F.sum(_hundredths("l_quantity")).alias("_q100"),
        F.sum(_hundredths("l_tax")).alias("_t100"),
        F.sum(disc).alias("_d100"),
        F.sum("l_linenumber").cast("bigint").alias("_line"),
        F.count(F.lit(1)).alias("_n"),
    ]
    g = rows.groupBy("store_id", "dept_id", "week_date").agg(*aggs)
    md_on = F.col("week_date") >= F.lit(MARKDOWN_START).cast("date")
    return g.select(
        "store_id", "dept_id", "week_date",
        _scaled("_sales", 2, "decimal(18,2)").alias("weekly_sales"),
        F.weekofyear("week_date").isin(*HOLIDAY_WEEKS).alias("isholiday"),
        _ratio("_q100", 10, 2, "decimal(6,2)").alias("temperature"),
        _ratio("_t100", 1, 3, "decimal(6,3)").alias("fuel_price"),
        *[F.when(md_on, _scaled(f"_md{i}", 4, "decimal(18,4)")).alias(m)
          for i, m in enumerate(MARKDOWNS, start=1)],
        _ratio("_d100", 1, 7, "decimal(10,7)").alias("cpi"),
        _ratio("_line", 1, 3, "decimal(6,3)").alias("unemployment"),
    )


def _ratio(total: str, divisor: int, places: int, dtype: str) -> F.Column:
    """total / (divisor * n) rounded half-up to ``places`` with integer arithmetic,
    so that every engine stores the same exact decimal."""
    scale = 10 ** places
    units = F.expr(f"({total} * {2 * scale} + _n * {divisor}) div (2 * {divisor} * _n)")
    return _scaled_col(units, places, dtype)


def _scaled_col(units: F.Column, places: int, dtype: str) -> F.Column:
    return (units.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-places))).cast(dtype)


def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per region: type by region number, size = 1000 x suppliers of the region."""
    sizes = (store_of_supplier(spark, sf_dir).groupBy("store_id")
             .agg((F.count(F.lit(1)) * 1000).cast("int").alias("store_size")))
    regions = table(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 1).alias("store_id"),
        F.when(F.col("r_regionkey") % 3 == 0, "A")
         .when(F.col("r_regionkey") % 3 == 1, "B").otherwise("C").alias("store_type"))
    return regions.join(sizes, "store_id", "left").select("store_id", "store_type", "store_size")


def dim_dept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Department dimension: the distinct brand numbers of ``part``."""
    return (table(spark, sf_dir, "part")
            .select(F.regexp_extract("p_brand", r"Brand#(\d+)", 1).cast("int").alias("dept_id"))
            .distinct())


# dimension joins broadcast only below this size (checked each time), sort-merge beyond
DIM_BROADCAST_ROWS = 100_000


def analytics_view(spark: SparkSession, sf_dir: str, fact: DataFrame | None = None) -> DataFrame:
    """Fact inner dim_store inner dim_dept; money and covariates keep their exact decimals.
    The fact keeps its own partitioning: the dimensions are broadcast after a size check, so
    no exchange on a dimension key (e.g. dept alone) is imposed on later series windows."""
    fact = fact if fact is not None else fact_sales(spark, sf_dir)
    stores = broadcast_if_small(dim_store(spark, sf_dir), DIM_BROADCAST_ROWS)
    depts = broadcast_if_small(dim_dept(spark, sf_dir), DIM_BROADCAST_ROWS)
    v = fact.join(stores, "store_id").join(depts, "dept_id")
    return v.select(*VIEW_COLUMNS)


# The same mapping in DuckDB SQL, shared by every oracle query.
ORACLE_BASE_CTES = """
store_of_supplier AS (
  SELECT s.s_suppkey, n.n_regionkey + 1 AS store_id
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
),
li AS (
  SELECT l.*, CAST(regexp_extract(p.p_brand, 'Brand#(\\d+)', 1) AS INTEGER) AS dept_id, ss.store_id,
         CAST(CAST(date_trunc('week', l.l_shipdate) AS DATE) + 4 AS DATE) AS week_date,
         CAST(ROUND(l.l_extendedprice * 100) AS BIGINT) AS cents,
         CAST(ROUND(l.l_discount * 100) AS BIGINT) AS disc
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN store_of_supplier ss ON l.l_suppkey = ss.s_suppkey
),
fact_agg AS (
  SELECT store_id, dept_id, week_date,
    SUM(CASE WHEN l_returnflag = 'R' AND l_linenumber >= 6 THEN -cents ELSE cents END) AS sales,
    SUM(CASE WHEN l_linenumber = 1 THEN cents * disc END) AS md1,
    SUM(CASE WHEN l_linenumber = 2 THEN cents * disc END) AS md2,
    SUM(CASE WHEN l_linenumber = 3 THEN cents * disc END) AS md3,
    SUM(CASE WHEN l_linenumber = 4 THEN cents * disc END) AS md4,
    SUM(CASE WHEN l_linenumber = 5 THEN cents * disc END) AS md5,
    SUM(CAST(ROUND(l_quantity * 100) AS BIGINT)) AS q100,
    SUM(CAST(ROUND(l_tax * 100) AS BIGINT)) AS t100,
    SUM(disc) AS d100,
    CAST(SUM(l_linenumber) AS BIGINT) AS line,
    COUNT(*) AS n
  FROM li GROUP BY store_id, dept_id, week_date
),
fact AS (
  SELECT store_id, dept_id, week_date, CAST(CAST(sales AS DECIMAL(20,0)) * 0.01 AS DECIMAL(18,2)) AS weekly_sales,
    weekofyear(week_date) IN (6, 36, 47, 52) AS isholiday,
    CAST(CAST((q100 * 200 + n * 10) // (20 * n) AS DECIMAL(20,0)) * 0.01 AS DECIMAL(6,2)) AS temperature,
    CAST(CAST((t100 * 2000 + n) // (2 * n) AS DECIMAL(20,0)) * 0.001 AS DECIMAL(6,3)) AS fuel_price,
    CASE WHEN week_date >= DATE '1998-01-01' THEN CAST(CAST(md1 AS DECIMAL(20,0)) * 0.0001 AS DECIMAL(18,4)) END AS markdown1,
    CASE WHEN week_date >= DATE '1998-01-01' THEN CAST(CAST(md2 AS DECIMAL(20,0)) * 0.0001 AS DECIMAL(18,4)) END AS markdown2,
    CASE WHEN week_date >= DATE '1998-01-01' THEN CAST(CAST(md3 AS DECIMAL(20,0)) * 0.0001 AS DECIMAL(18,4)) END AS markdown3,
    CASE WHEN week_date >= DATE '1998-01-01' THEN CAST(CAST(md4 AS DECIMAL(20,0)) * 0.0001 AS DECIMAL(18,4)) END AS markdown4,
    CASE WHEN week_date >= DATE '1998-01-01' THEN CAST(CAST(md5 AS DECIMAL(20,0)) * 0.0001 AS DECIMAL(18,4)) END AS markdown5,
    CAST(CAST((d100 * 20000000 + n) // (2 * n) AS DECIMAL(20,0)) * 0.0000001 AS DECIMAL(10,7)) AS cpi,
    CAST(CAST((line * 2000 + n) // (2 * n) AS DECIMAL(20,0)) * 0.001 AS DECIMAL(6,3)) AS unemployment
  FROM fact_agg
),
dim_store AS (
  SELECT r.r_regionkey + 1 AS store_id,
    CASE WHEN r.r_regionkey % 3 = 0 THEN 'A' WHEN r.r_regionkey % 3 = 1 THEN 'B' ELSE 'C' END AS store_type,
    CAST(sz.cnt * 1000 AS INTEGER) AS store_size
  FROM region r LEFT JOIN (SELECT store_id, COUNT(*) AS cnt FROM store_of_supplier GROUP BY store_id) sz
    ON r.r_regionkey + 1 = sz.store_id
),
dim_dept AS (SELECT DISTINCT CAST(regexp_extract(p_brand, 'Brand#(\\d+)', 1) AS INTEGER) AS dept_id FROM part),
v AS (
  SELECT f.store_id, s.store_type, s.store_size, f.dept_id, f.week_date, f.weekly_sales,
    f.isholiday, f.temperature, f.fuel_price, f.markdown1, f.markdown2, f.markdown3,
    f.markdown4, f.markdown5, f.cpi, f.unemployment
  FROM fact f JOIN dim_store s ON f.store_id = s.store_id JOIN dim_dept d ON f.dept_id = d.dept_id
)"""


def defective(fact: DataFrame) -> DataFrame:
    """The fact with faults that depend on the keys alone, for the checks to find: unknown and null
    stores, unknown departments (which are also short series), null sales, cpi beyond its precision,
    repeated rows."""
    h = F.col("store_id") * 31 + F.col("dept_id") * 17 + F.datediff("week_date", F.lit("1992-01-01").cast("date"))
    rows = fact.withColumn("_h", h).withColumns({
        "store_id": F.when(F.col("_h") % 113 == 4, 99).when(F.col("_h") % 101 != 0, F.col("store_id")),
        "dept_id": F.when(F.col("_h") % 109 == 3, F.col("dept_id") + 900).otherwise(F.col("dept_id")),
        "weekly_sales": F.when(F.col("_h") % 103 != 1, F.col("weekly_sales")),
        "cpi": (F.when(F.col("_h") % 107 == 2, F.col("cpi") + 2000).otherwise(F.col("cpi"))).cast("decimal(12,7)")})
    return rows.unionByName(rows.where(F.col("_h") % 127 == 5)).drop("_h")


DEFECT_CTES = """
marked AS (SELECT *, store_id * 31 + dept_id * 17 + datediff('day', DATE '1992-01-01', week_date) AS h FROM fact),
faulty AS (
  SELECT CASE WHEN h % 113 = 4 THEN 99 WHEN h % 101 <> 0 THEN store_id END AS store_id,
    CASE WHEN h % 109 = 3 THEN dept_id + 900 ELSE dept_id END AS dept_id, week_date,
    CASE WHEN h % 103 <> 1 THEN weekly_sales END AS weekly_sales,
    CASE WHEN h % 107 = 2 THEN cpi + 2000 ELSE cpi END AS cpi, h FROM marked),
bad AS (SELECT * FROM faulty UNION ALL SELECT * FROM faulty WHERE h % 127 = 5)"""
