"""Registered queries: baselines, metrics, segments and reports (C4-C11, D26-D27, D30, D32,
E11-E13, F4, F7, F9, I1-I19, B18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.config import DEFAULT
from tillcast.functions.metrics import rounded
from tillcast.operators import baselines as bl
from tillcast.operators import evaluate as ev
from tillcast.operators import segments as sg
from tillcast.operators.split import take_split
from tillcast.plans.feature_plans import SPLIT_SQL, split_view
from tillcast.session import durable
from tillcast.plans.registry import register, with_base
from tillcast.schemas import KEYS, SERIES

P = DEFAULT
SEGMENT_COLS = ["store_type", "isholiday", "volume_quartile", "is_top_dept"]
ONE_SERIES = (1, 1)


def train_val(spark, sf):
    """Baselines are fit on train and scored on val, with raw (unclipped) sales."""
    sv = split_view(spark, sf, shared=True)
    return take_split(sv, "train").drop("split"), take_split(sv, "val").drop("split")


def train_val_test(spark, sf):
    sv = split_view(spark, sf, shared=True)
    return [take_split(sv, s).drop("split") for s in ("train", "val", "test")]


def grid(spark, sf):
    train, val = train_val(spark, sf)
    return bl.forecast_grid(train, val, P), val


# -- DuckDB text of the same plans -------------------------------------------------------

def _mean(expr):
    return f"CASE WHEN COUNT({expr}) > 0 THEN CAST(SUM({expr}) AS DOUBLE) / COUNT({expr}) END"


def baseline_ctes(train_where: str, actual_where: str, tag: str = "") -> str:
    """CTEs ending in ``predsn{tag}``: (model, keys, predicted_sales) of the five baselines."""
    t = tag
    k = P.seasonal_k
    n = P.moving_average_window
    hybrid = (f"COALESCE(CASE WHEN n_rows >= 52 AND sn_rows IS NOT NULL THEN CAST(sn_value AS DOUBLE) END, "
              f"CASE WHEN n_match >= 2 THEN mean_match_all END, CASE WHEN n_rows >= 4 THEN mean_last_4 END, "
              f"series_mean)")
    return f"""
tr{t} AS (SELECT store_id, dept_id, week_date, weekly_sales FROM sv WHERE {train_where}),
va{t} AS (SELECT * FROM sv WHERE {actual_where}),
dts{t} AS (SELECT DISTINCT week_date FROM va{t}),
rk{t} AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY store_id, dept_id ORDER BY week_date DESC) AS rn,
            ROW_NUMBER() OVER (PARTITION BY store_id, dept_id ORDER BY (weekly_sales IS NULL), week_date DESC) AS rn_nn
          FROM tr{t}),
summ{t} AS (SELECT store_id, dept_id,
    MAX(CASE WHEN rn_nn = 1 AND weekly_sales IS NOT NULL THEN weekly_sales END) AS last_nonnull,
    MAX(CASE WHEN rn = 1 THEN weekly_sales END) AS last_any,
    COUNT(*) AS n_rows, {_mean('weekly_sales')} AS series_mean,
    {_mean('CASE WHEN rn <= 4 THEN weekly_sales END')} AS mean_last_4,
    {_mean(f'CASE WHEN rn <= {n} THEN weekly_sales END')} AS mean_last_n
  FROM rk{t} GROUP BY store_id, dept_id),
grid{t} AS (SELECT s.*, d.week_date, year(d.week_date) AS fyear, weekofyear(d.week_date) AS fweek
           FROM summ{t} s CROSS JOIN dts{t} d),
fwk{t} AS (SELECT store_id, dept_id, y, w, weekly_sales AS sn_value, cnt AS sn_rows FROM (
    SELECT store_id, dept_id, year(week_date) AS y, weekofyear(week_date) AS w, weekly_sales,
      ROW_NUMBER() OVER (PARTITION BY store_id, dept_id, year(week_date), weekofyear(week_date) ORDER BY week_date) AS r,
      COUNT(*) OVER (PARTITION BY store_id, dept_id, year(week_date), weekofyear(week_date)) AS cnt
    FROM tr{t}) WHERE r = 1),
prs{t} AS (SELECT DISTINCT weekofyear(week_date) AS fweek, year(week_date) AS fyear FROM va{t}),
mt{t} AS (SELECT x.store_id, x.dept_id, p.fweek, p.fyear, x.week_date, x.weekly_sales,
    ROW_NUMBER() OVER (PARTITION BY x.store_id, x.dept_id, p.fweek, p.fyear ORDER BY x.week_date DESC) AS r
  FROM tr{t} x JOIN prs{t} p ON weekofyear(x.week_date) = p.fweek AND year(x.week_date) < p.fyear),
sm{t} AS (SELECT store_id, dept_id, fweek, fyear, COUNT(*) AS n_match, {_mean('weekly_sales')} AS mean_match_all,
    {_mean(f'CASE WHEN r <= {k} THEN weekly_sales END')} AS mean_match_k
  FROM mt{t} GROUP BY store_id, dept_id, fweek, fyear),
g2{t} AS (SELECT g.*, f.sn_value, f.sn_rows, m.n_match, m.mean_match_all, m.mean_match_k
  FROM grid{t} g
  LEFT JOIN fwk{t} f ON g.store_id = f.store_id AND g.dept_id = f.dept_id AND f.y = g.fyear - 1 AND f.w = g.fweek
  LEFT JOIN sm{t} m ON g.store_id = m.store_id AND g.dept_id = m.dept_id AND m.fweek = g.fweek AND m.fyear = g.fyear),
preds{t} AS (
  SELECT '{bl.NAIVE}' AS model, store_id, dept_id, week_date, CAST(last_nonnull AS DOUBLE) AS predicted_sales FROM g2{t}
  UNION ALL SELECT '{bl.SEASONAL_NAIVE}', store_id, dept_id, week_date,
    CAST(CASE WHEN sn_rows IS NOT NULL THEN sn_value ELSE last_any END AS DOUBLE) FROM g2{t}
  UNION ALL SELECT '{bl.MOVING_AVERAGE}', store_id, dept_id, week_date, mean_last_n FROM g2{t}
  UNION ALL SELECT '{bl.SEASONAL_AVERAGE}', store_id, dept_id, week_date,
    CASE WHEN n_match IS NOT NULL THEN mean_match_k ELSE CAST(last_any AS DOUBLE) END FROM g2{t}
  UNION ALL SELECT '{bl.HYBRID}', store_id, dept_id, week_date, {hybrid} FROM g2{t}),
predsn{t} AS (SELECT * FROM preds{t} WHERE predicted_sales IS NOT NULL)"""


SV_CTE = f"sv AS (SELECT v.*, {SPLIT_SQL} AS split FROM v)"
VAL_CTES = SV_CTE + "," + baseline_ctes("split = 'train'", "split = 'val'")


def metric_sql(a="CAST(weekly_sales AS DOUBLE)", p="predicted_sales", wmae=True) -> str:
    d = f"({a} - {p})"
    w = f"CASE WHEN isholiday THEN {P.holiday_weight} ELSE 1.0 END"
    cols = [f"ROUND(SQRT(AVG({d} * {d})), 4) AS rmse", f"ROUND(AVG(ABS({d})), 4) AS mae"]
    if wmae:
        cols.append(f"ROUND(SUM({w} * ABS({d})) / SUM({w}), 4) AS wmae")
    cols += [f"ROUND(AVG(CASE WHEN {a} >= {P.mape_threshold} THEN ABS({d} / {a}) * 100 END), 4) AS mape",
             f"ROUND(CASE WHEN VAR_POP({a}) * COUNT({a}) > 0 THEN 1 - SUM({d} * {d}) / (VAR_POP({a}) * COUNT({a})) END, 6) AS r_squared",
             "COUNT(*) FILTER (WHERE weekly_sales IS NOT NULL AND predicted_sales IS NOT NULL) AS n_samples"]
    return ", ".join(cols)


def _pred_sql(model: str) -> str:
    return with_base(VAL_CTES, f"SELECT store_id, dept_id, week_date, predicted_sales FROM predsn WHERE model = '{model}'")


def _pred_query(name):
    def q(spark, sf):
        g, _ = grid(spark, sf)
        return bl.predictions(g, name, P)
    q.__doc__ = f"{name} forecast for every validation date"
    return q


register("i1_naive_forecast", _pred_sql(bl.NAIVE))(_pred_query(bl.NAIVE))
register("i2_seasonal_naive_forecast", _pred_sql(bl.SEASONAL_NAIVE))(_pred_query(bl.SEASONAL_NAIVE))
register("i3_moving_average_forecast", _pred_sql(bl.MOVING_AVERAGE))(_pred_query(bl.MOVING_AVERAGE))
register("i4_seasonal_average_forecast", _pred_sql(bl.SEASONAL_AVERAGE))(_pred_query(bl.SEASONAL_AVERAGE))
register("i5_hybrid_forecast", _pred_sql(bl.HYBRID))(_pred_query(bl.HYBRID))


@register("d26_forecast_dates", with_base(SV_CTE, "SELECT DISTINCT week_date FROM sv WHERE split = 'val'"))
def q_dates(spark, sf):
    _, val = train_val(spark, sf)
    return val.select("week_date").distinct()


@register("c5_forecast_grid_size", with_base(VAL_CTES, "SELECT COUNT(*) AS n_rows, COUNT(DISTINCT week_date) AS n_dates FROM grid"))
def q_grid(spark, sf):
    """Series x dates expanded in place."""
    train, val = train_val(spark, sf)
    g = bl.expand_dates(bl.series_summary(train), bl.forecast_dates(val))
    return g.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("week_date").alias("n_dates"))


@register("e11_e12_series_summary", with_base(VAL_CTES, """
SELECT store_id, dept_id, CAST(last_nonnull AS DOUBLE) AS last_nonnull, CAST(last_any AS DOUBLE) AS last_any,
  n_rows, series_mean, mean_last_4 FROM summ"""))
def q_summary(spark, sf):
    """E11 (last value, two null rules) and E12 (mean of the last N rows) per series."""
    train, _ = train_val(spark, sf)
    s = bl.series_summary(train, (4,))
    return s.select(*SERIES, F.col("last_nonnull").cast("double"), F.col("last_any").cast("double"),
                    "n_rows", "series_mean", "mean_last_4")


@register("c6_first_in_week_lookup", with_base(VAL_CTES, """
SELECT store_id, dept_id, CAST(y AS INTEGER) AS year, CAST(w AS INTEGER) AS week_of_year,
  CAST(sn_value AS DOUBLE) AS first_value, sn_rows AS n_rows FROM fwk"""))
def q_first_week(spark, sf):
    train, _ = train_val(spark, sf)
    f = bl.first_in_week(train)
    return f.select(*SERIES, F.col("_ly").alias("year"), F.col("_lw").alias("week_of_year"),
                    F.col("sn_value").cast("double").alias("first_value"), F.col("sn_rows").alias("n_rows"))


@register("c7_e13_seasonal_matches", with_base(VAL_CTES, """
SELECT store_id, dept_id, CAST(fweek AS INTEGER) AS forecast_week, CAST(fyear AS INTEGER) AS forecast_year,
  n_match, mean_match_all, mean_match_k FROM sm"""))
def q_matches(spark, sf):
    train, val = train_val(spark, sf)
    m = bl.seasonal_matches(train, val, P.seasonal_k)
    return m.select(*SERIES, F.col("_fweek").alias("forecast_week"), F.col("_fyear").alias("forecast_year"),
                    "n_match", "mean_match_all", "mean_match_k")


def all_val_predictions(spark, sf):
    g, val = grid(spark, sf)
    return bl.all_predictions(g, P), val


@register("i6_i12_baseline_metrics", with_base(VAL_CTES + """,
m AS (SELECT p.model, a.weekly_sales, a.isholiday, p.predicted_sales FROM va a JOIN predsn p USING (store_id, dept_id, week_date))""",
f"SELECT model, {metric_sql()} FROM m GROUP BY model"))
def q_metrics(spark, sf):
    """I15 overall: RMSE, MAE, WMAE, MAPE, R squared, n of the five baselines, one join, one group-by."""
    preds, val = all_val_predictions(spark, sf)
    return rounded(ev.evaluate_predictions(val, preds, by=["model"], with_wmae=True, params=P))


@register("i11_metrics_without_wmae", with_base(VAL_CTES + """,
m AS (SELECT p.model, a.weekly_sales, a.isholiday, p.predicted_sales FROM va a JOIN predsn p USING (store_id, dept_id, week_date))""",
f"SELECT {metric_sql(wmae=False)} FROM m WHERE model = '{bl.SEASONAL_NAIVE}'"))
def q_metrics_plain(spark, sf):
    """evaluate_predictions of one forecast."""
    g, val = grid(spark, sf)
    return rounded(ev.evaluate_predictions(val, bl.predictions(g, bl.SEASONAL_NAIVE, P), with_wmae=False))


SEG_CTES = VAL_CTES + f""",
smean AS (SELECT store_id, dept_id, {_mean('weekly_sales')} AS series_mean FROM va GROUP BY store_id, dept_id),
qv AS (SELECT quantile_cont(series_mean, 0.25) AS p25, quantile_cont(series_mean, 0.5) AS p50,
              quantile_cont(series_mean, 0.75) AS p75 FROM smean),
vq AS (SELECT s.store_id, s.dept_id, s.series_mean,
  CASE WHEN s.series_mean <= qv.p25 THEN '{sg.QUARTILE_LABELS[0]}' WHEN s.series_mean <= qv.p50 THEN '{sg.QUARTILE_LABELS[1]}'
       WHEN s.series_mean <= qv.p75 THEN '{sg.QUARTILE_LABELS[2]}' ELSE '{sg.QUARTILE_LABELS[3]}' END AS volume_quartile
  FROM smean s, qv),
topd AS (SELECT dept_id FROM (SELECT dept_id, ROW_NUMBER() OVER (ORDER BY COALESCE(SUM(weekly_sales), 0) DESC, dept_id) AS r
         FROM va GROUP BY dept_id) WHERE r <= {P.top_segment_depts}),
vseg AS (SELECT a.*, q.volume_quartile,
    CASE WHEN a.dept_id IN (SELECT dept_id FROM topd) THEN '{sg.TOP_LABEL}' ELSE '{sg.OTHER_LABEL}' END AS is_top_dept
  FROM va a LEFT JOIN vq q USING (store_id, dept_id))"""


@register("d27_volume_quartiles", with_base(SEG_CTES, "SELECT store_id, dept_id, series_mean, volume_quartile FROM vq"))
def q_quartiles(spark, sf):
    _, val = train_val(spark, sf)
    return sg.volume_quartiles(val)


@register("f4_top_departments", with_base(SEG_CTES, "SELECT dept_id FROM topd"))
def q_top_depts(spark, sf):
    _, val = train_val(spark, sf)
    return sg.top_departments(val, P.top_segment_depts)


@register("i14_create_segments", with_base(SEG_CTES, """
SELECT store_id, dept_id, week_date, volume_quartile, is_top_dept FROM vseg"""))
def q_segments(spark, sf):
    _, val = train_val(spark, sf)
    return sg.create_segments(val, P.top_segment_depts).select(*KEYS, "volume_quartile", "is_top_dept")


@register("i13_i15_baseline_segments", with_base(SEG_CTES + """,
m AS (SELECT p.model, a.*, p.predicted_sales FROM vseg a JOIN predsn p USING (store_id, dept_id, week_date)),
st AS (SELECT model, 'store_type' AS segment_type, CAST(store_type AS VARCHAR) AS segment, weekly_sales, isholiday, predicted_sales FROM m
  UNION ALL SELECT model, 'isholiday', CAST(isholiday AS VARCHAR), weekly_sales, isholiday, predicted_sales FROM m
  UNION ALL SELECT model, 'volume_quartile', volume_quartile, weekly_sales, isholiday, predicted_sales FROM m
  UNION ALL SELECT model, 'is_top_dept', is_top_dept, weekly_sales, isholiday, predicted_sales FROM m)""",
f"SELECT model, segment_type, segment, {metric_sql()} FROM st WHERE segment IS NOT NULL GROUP BY model, segment_type, segment"))
def q_seg_metrics(spark, sf):
    """I13 for four segment families and five baselines: one join, one group-by."""
    g, val = grid(spark, sf)
    vs = sg.create_segments(val, P.top_segment_depts)
    preds = bl.all_predictions(g, P)
    return rounded(ev.evaluate_by_segments(vs, preds, SEGMENT_COLS, by=["model"], params=P))


@register("f7_best_baseline", with_base(VAL_CTES + """,
m AS (SELECT p.model, a.weekly_sales, a.isholiday, p.predicted_sales FROM va a JOIN predsn p USING (store_id, dept_id, week_date)),
r AS (SELECT model, """ + metric_sql() + """ FROM m GROUP BY model)""",
"SELECT arg_min(model, (rmse, model)) AS best_rmse, arg_min(model, (wmae, model)) AS best_wmae FROM r"))
def q_best(spark, sf):
    preds, val = all_val_predictions(spark, sf)
    r = rounded(ev.evaluate_predictions(val, preds, by=["model"], with_wmae=True, params=P))
    return r.agg(F.min_by("model", F.struct("rmse", "model")).alias("best_rmse"),
                 F.min_by("model", F.struct("wmae", "model")).alias("best_wmae"))


REPORT_CTES = (SV_CTE + "," + baseline_ctes("split = 'train'", "split = 'val'")
               + "," + baseline_ctes("split IN ('train', 'val')", "split = 'test'", "_t"))


@register("i16_evaluation_report", with_base(REPORT_CTES + """,
mv AS (SELECT p.model, a.weekly_sales, a.isholiday, p.predicted_sales FROM va a JOIN predsn p USING (store_id, dept_id, week_date)),
rv AS (SELECT model, """ + metric_sql() + """ FROM mv GROUP BY model),
mt2 AS (SELECT p.model, a.weekly_sales, a.isholiday, p.predicted_sales FROM va_t a JOIN predsn_t p USING (store_id, dept_id, week_date)),
rt AS (SELECT model, """ + metric_sql() + """ FROM mt2 GROUP BY model)""", """
SELECT rt.model AS model_name, ROUND(rt.rmse, 4) AS test_rmse, ROUND(rt.mae, 4) AS test_mae, ROUND(rt.wmae, 4) AS test_wmae,
  ROUND(rt.mape, 4) AS test_mape, ROUND(rt.r_squared, 4) AS test_r_squared, rt.n_samples,
  rv.rmse AS val_rmse, rv.wmae AS val_wmae
FROM rt LEFT JOIN rv ON rt.model = rv.model"""))
def q_report(spark, sf):
    """I16: baselines refit on train+val and scored on test, beside their validation scores."""
    train, val, test = train_val_test(spark, sf)
    gv = bl.forecast_grid(train, val, P)
    rv = rounded(ev.evaluate_predictions(val, bl.all_predictions(gv, P), by=["model"], with_wmae=True, params=P))
    tv = train.unionByName(val)
    gt = bl.forecast_grid(tv, test, P)
    rt = rounded(ev.evaluate_predictions(test, bl.all_predictions(gt, P), by=["model"], with_wmae=True, params=P))
    return ev.evaluation_report(rt, rv)


def _one_series_where():
    s, d = ONE_SERIES
    return f"store_id = {s} AND dept_id = {d}"


@register("b18_one_series", with_base("", f"""
SELECT store_id, dept_id, week_date, CAST(weekly_sales AS DOUBLE) AS weekly_sales FROM v WHERE {_one_series_where()}"""))
def q_one_series(spark, sf):
    """One series, sorted by week (the filter reaches the scan of the derived table)."""
    from tillcast.plans.feature_plans import view
    s, d = ONE_SERIES
    return (view(spark, sf).where((F.col("store_id") == s) & (F.col("dept_id") == d))
            .select(*KEYS, F.col("weekly_sales").cast("double")).orderBy("week_date"))


@register("d32_series_key_summary", with_base("", f"""
SELECT COUNT(*) AS n_rows, MIN(week_date) AS first_date, MAX(week_date) AS last_date FROM v WHERE {_one_series_where()}"""))
def q_key_summary(spark, sf):
    from tillcast.plans.feature_plans import view
    return ev.series_key_summary(view(spark, sf), *ONE_SERIES)


@register("f9_series_tail", with_base("", f"""
SELECT week_date, CAST(weekly_sales AS DOUBLE) AS weekly_sales FROM v WHERE {_one_series_where()}
ORDER BY week_date DESC LIMIT 3"""))
def q_tail(spark, sf):
    from tillcast.plans.feature_plans import view
    s, d = ONE_SERIES
    one = view(spark, sf).where((F.col("store_id") == s) & (F.col("dept_id") == d))
    return ev.tail_rows(one.select("week_date", F.col("weekly_sales").cast("double")), 3)


CMP = {"naive": bl.NAIVE, "seasonal": bl.SEASONAL_NAIVE, "moving_avg": bl.MOVING_AVERAGE}


def _cmp_sql_ctes():
    joins = []
    cols = []
    for short, name in CMP.items():
        joins.append(f"LEFT JOIN (SELECT store_id, dept_id, week_date, predicted_sales AS pred_{short} FROM predsn "
                     f"WHERE model = '{name}') p_{short} USING (store_id, dept_id, week_date)")
        cols.append(f"pred_{short}, CAST(a.weekly_sales AS DOUBLE) - pred_{short} AS err_{short}")
    return VAL_CTES + f""",
cmp AS (SELECT store_id, dept_id, week_date, CAST(a.weekly_sales AS DOUBLE) AS actual, {', '.join(cols)}
  FROM (SELECT * FROM va WHERE {_one_series_where()}) a {' '.join(joins)})"""


def _comparison(spark, sf):
    g, val = grid(spark, sf)
    s, d = ONE_SERIES
    here = (F.col("store_id") == s) & (F.col("dept_id") == d)
    one, g = val.where(here), durable(g.where(here))      # the grid of one series, planned once
    fc = {short: bl.predictions(g, name, P) for short, name in CMP.items()}
    return ev.compare_forecasts(one, fc)


@register("i17_c11_series_comparison", with_base(_cmp_sql_ctes(), "SELECT * FROM cmp"))
def q_compare(spark, sf):
    """One series, three forecasts side by side by key, with signed errors."""
    return _comparison(spark, sf)


@register("d30_error_summary", with_base(_cmp_sql_ctes(), "SELECT " + ", ".join(
    f"AVG(err_{s}) AS mean_err_{s}, ROUND(STDDEV_SAMP(err_{s}), 4) AS std_err_{s}" for s in CMP) + " FROM cmp"))
def q_err_summary(spark, sf):
    e = ev.error_summary(_comparison(spark, sf), list(CMP))
    return e.withColumns({f"std_err_{s}": F.round(f"std_err_{s}", 4) for s in CMP})


@register("i18_actual_vs_predicted", with_base(VAL_CTES + f"""
, m AS (SELECT a.store_id, a.dept_id, a.week_date, CAST(a.weekly_sales AS DOUBLE) AS actual, p.predicted_sales
  FROM va a JOIN (SELECT * FROM predsn WHERE model = '{bl.HYBRID}') p USING (store_id, dept_id, week_date))""",
"SELECT m.*, (SELECT GREATEST(MAX(actual), MAX(predicted_sales)) FROM m) AS axis_max FROM m"))
def q_avp(spark, sf):
    g, val = grid(spark, sf)
    return ev.actual_vs_predicted(val, bl.predictions(g, bl.HYBRID, P))


@register("i19_pick_predictions", with_base(VAL_CTES, f"""
SELECT * FROM predsn WHERE model = COALESCE((SELECT MAX(model) FROM predsn WHERE model = '{bl.HYBRID}'),
                                            (SELECT MIN(model) FROM predsn))"""))
def q_pick(spark, sf):
    preds, _ = all_val_predictions(spark, sf)
    return ev.pick_predictions(durable(preds), bl.HYBRID)
