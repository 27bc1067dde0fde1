"""The queries of the library's own operators, each with the same result in SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crestline.functions import calendar as cal
from crestline.operators import backtest as bat
from crestline.operators import calibration as con
from crestline.operators import dependence as dep
from crestline.operators import diagnostics as dia
from crestline.operators import evaluation as eva
from crestline.operators import horizon as hor
from crestline.operators import ingest as ing
from crestline.operators import model as mod
from crestline.operators import quantile as qua
from crestline.operators import serving as srv
from crestline.operators import simulation as sim
from crestline.sources import lake, panels, synthetic

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

TAUS = [0.1, 0.5, 0.9]

#: Panels in SQL.
P1 = """p1 AS (SELECT event_type AS app_id, 'P' || (user_id % 2) AS lpar, CAST(ts AS DATE) AS business_date, CAST(hour(ts) - 8 AS INT) AS interval_idx,
  CAST(year(ts) + (month(ts) >= 11)::INT AS INT) AS fiscal_year, sum(value) AS mips FROM events WHERE isodow(ts) <= 5 AND hour(ts) BETWEEN 8 AND 16 GROUP BY ALL)"""
P2 = """p2 AS (SELECT l_returnflag || l_linestatus AS app_id, l_linestatus AS lpar, CAST(l_shipdate AS DATE) AS business_date, 0 AS interval_idx,
  CAST(year(l_shipdate) + (month(l_shipdate) >= 11)::INT AS INT) AS fiscal_year, sum(l_extendedprice) AS mips FROM lineitem WHERE isodow(l_shipdate) <= 5 GROUP BY ALL)"""
P3 = """p3 AS (SELECT l_returnflag AS app_id, 'P' AS lpar, CAST(l_shipdate AS DATE) AS business_date, CAST((l_linenumber - 1) % 3 AS INT) AS interval_idx,
  CAST(year(l_shipdate) + (month(l_shipdate) >= 11)::INT AS INT) AS fiscal_year, sum(l_extendedprice) AS mips FROM lineitem WHERE isodow(l_shipdate) <= 5 GROUP BY ALL)"""
WIN = """win AS (SELECT r::INT AS event_seq, CASE r % 3 WHEN 0 THEN 'DR' WHEN 1 THEN 'IST' ELSE 'GCC_SDF' END AS kind, CASE WHEN r % 2 = 0 THEN '*' ELSE 'P0' END AS w_lpar,
  date_trunc('hour', ts) AS s, date_trunc('hour', ts) + INTERVAL 2 HOUR AS e FROM (SELECT ts, row_number() OVER (ORDER BY value DESC, event_id) - 1 AS r FROM events
  WHERE event_type = 'error' AND isodow(ts) <= 5 AND hour(ts) BETWEEN 8 AND 16 ORDER BY r LIMIT 6))"""
COIN = """apps AS (SELECT lpar, business_date, fiscal_year, sum(peak) AS sum_app_peaks, count(*) AS n_apps FROM (SELECT lpar, business_date, fiscal_year, app_id, max(mips) AS peak FROM p1 GROUP BY ALL) GROUP BY ALL),
whole AS (SELECT lpar, business_date, max(v) AS peak_of_sum, arg_max(interval_idx, (v, -interval_idx)) AS peak_interval_idx FROM (SELECT lpar, business_date, interval_idx, sum(mips) AS v FROM p1 GROUP BY ALL) GROUP BY ALL),
coin AS (SELECT lpar, business_date, fiscal_year, sum_app_peaks, n_apps, peak_of_sum, peak_interval_idx, peak_of_sum / nullif(sum_app_peaks, 0) AS coincidence, peak_of_sum > sum_app_peaks AS unattributed FROM apps JOIN whole USING (lpar, business_date))"""
SUBS = """subs AS (SELECT app_id, fiscal_year + 1 AS fiscal_year, max(mips) * (0.8 + 0.1 * (ascii(app_id) % 5)) AS submitted_peak_mips FROM p2 GROUP BY app_id, fiscal_year),
bias AS (SELECT app_id, fiscal_year, realised, submitted_peak_mips, submitted_peak_mips / realised AS ratio, submitted_peak_mips - realised AS difference, ln(submitted_peak_mips / realised) AS log_ratio
  FROM (SELECT app_id, fiscal_year, max(mips) AS realised FROM p2 GROUP BY ALL) JOIN subs USING (app_id, fiscal_year))"""
DAILY = "daily AS (SELECT lpar, fiscal_year, business_date, sum(mips) AS daily_peak, avg(mips) AS daily_mean FROM p2 GROUP BY ALL)"
DENSE = """dense AS (SELECT app_id, business_date, 0 AS interval_idx, mips FROM (SELECT DISTINCT app_id FROM p2) CROSS JOIN (SELECT DISTINCT business_date FROM p2)
  LEFT JOIN (SELECT app_id, business_date, sum(mips) AS mips FROM p2 GROUP BY ALL) USING (app_id, business_date))"""


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, so that the order of additions doesn't show."""
    return df.select(*[F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def _r(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


@query(f"WITH {P1}, {COIN} SELECT lpar, business_date, fiscal_year, n_apps, peak_interval_idx, unattributed, {_r('sum_app_peaks', 'peak_of_sum', 'coincidence')} FROM coin")
def dia1_coincidence(spark, sf_dir):
    return dia.coincidence(panels.hourly(spark, sf_dir))


@query(f"""WITH {P1}, {COIN} SELECT lpar, fiscal_year, count(*) AS n_days, round(avg(coincidence), 6) AS mean_c, round(median(coincidence), 6) AS median_c, round(quantile_cont(coincidence, .05), 6) AS p05_c,
  round(quantile_cont(coincidence, .95), 6) AS p95_c, round(min(coincidence), 6) AS min_c, round(max(coincidence), 6) AS max_c, count(*) FILTER (unattributed) AS n_unattributed FROM coin GROUP BY ALL""")
def dia2_coincidence_summary(spark, sf_dir):
    return dia.coincidence_summary(dia.coincidence(panels.hourly(spark, sf_dir)))


@query(f"""WITH {P1}, {COIN} SELECT count(*) AS n_days, round(avg(coincidence), 6) AS mean_c, round(quantile_cont(coincidence, .05), 6) AS p05_c, round(quantile_cont(coincidence, .95), 6) AS p95_c,
  round(avg(sum_app_peaks - peak_of_sum), 6) AS mean_over, round(avg((sum_app_peaks - peak_of_sum) / nullif(peak_of_sum, 0) * 100), 6) AS mean_over_pct, count(*) FILTER (unattributed) AS n_unattributed FROM coin""")
def dia7_headline(spark, sf_dir):
    return dia.headline(dia.coincidence(panels.hourly(spark, sf_dir)))


@query(f"""WITH {P1} SELECT app_id, lpar, count(*) AS n_rows, count(DISTINCT business_date) AS n_days, count(*) FILTER (mips IS NULL) AS n_null, count(*) FILTER (mips = 0) AS n_zero, round(avg(mips), 6) AS mean_mips,
  round(max(mips), 6) AS max_mips, round(quantile_cont(mips, .99), 6) AS p99_mips, round(max(mips) / nullif(avg(mips), 0), 6) AS peak_to_mean FROM p1 GROUP BY ALL""")
def dia3_profile(spark, sf_dir):
    return dia.profile(panels.hourly(spark, sf_dir))


@query(f"""WITH {P1}, a AS (SELECT app_id, business_date, arg_max(interval_idx, (mips, -interval_idx)) AS interval_idx FROM p1 GROUP BY ALL)
  SELECT app_id, interval_idx, n_days, round(n_days / sum(n_days) OVER (PARTITION BY app_id), 6) AS share FROM (SELECT app_id, interval_idx, count(*) AS n_days FROM a GROUP BY ALL)""")
def dia4_peak_spread(spark, sf_dir):
    return dia.peak_spread(panels.hourly(spark, sf_dir))


def _submissions(p2: DataFrame) -> DataFrame:
    factor = F.lit(0.8) + F.lit(0.1) * (F.ascii("app_id") % 5)
    return p2.groupBy("app_id", "fiscal_year").agg((F.max("mips") * F.first(factor)).alias("submitted_peak_mips")).withColumn("fiscal_year", F.col("fiscal_year") + 1)


@query(f"WITH {P2}, {SUBS} SELECT app_id, fiscal_year, {_r('realised', 'submitted_peak_mips', 'ratio', 'difference', 'log_ratio')} FROM bias")
def dia5_submission_bias(spark, sf_dir):
    p2 = panels.daily(spark, sf_dir)
    return dia.submission_bias(p2, _submissions(p2))


@query(f"""WITH {P2}, {SUBS} SELECT app_id, count(*) AS n_cycles, round(avg(ratio), 6) AS mean_ratio, round(exp(avg(log_ratio)), 6) AS geo_ratio, round(stddev_samp(log_ratio), 6) AS sd_log, count(*) FILTER (ratio > 1) AS n_over,
  count(*) FILTER (ratio < 1) AS n_under, round(greatest(count(*) FILTER (ratio > 1), count(*) FILTER (ratio < 1)) / count(*), 6) AS sign_consistency FROM bias GROUP BY app_id""")
def dia6_bias_summary(spark, sf_dir):
    p2 = panels.daily(spark, sf_dir)
    return dia.bias_summary(dia.submission_bias(p2, _submissions(p2)))


@query("""WITH d AS (SELECT CAST(d AS DATE) AS d FROM generate_series(DATE '2024-01-01', DATE '2026-12-31', INTERVAL 1 DAY) g(d) WHERE isodow(d) <= 5),
m AS (SELECT d, CAST(year(d) + (month(d) >= 11)::INT AS INT) AS fy, count(*) OVER (PARTITION BY year(d), month(d) ORDER BY d ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) < 2 AS month_end FROM d)
SELECT d AS business_date, fy AS fiscal_year, month_end, month_end AND month(d) % 3 = 0 AS quarter_end,
  round((d - make_date(fy - 1, 11, 1)) / (make_date(fy, 11, 1) - 1 - make_date(fy - 1, 11, 1)), 6) AS fy_position FROM m""")
def cal_days(spark, sf_dir):
    return cal.days(spark, date(2024, 1, 1), date(2026, 12, 31))


@query("""SELECT event_id, CASE WHEN hour(ts) BETWEEN 8 AND 16 AND minute(ts) % 15 = 0 THEN ((hour(ts) * 60 + minute(ts) - 480) // 15)::INT ELSE -1 END AS interval_idx,
  CAST(year(ts) + (month(ts) >= 11)::INT AS INT) AS fiscal_year, isodow(ts) <= 5 AS is_business FROM events""")
def cal_interval_index(spark, sf_dir):
    grid, ts = cal.Grid(minutes=15), F.col("ts")
    return panels.table(spark, sf_dir, "events").select("event_id", cal.interval_index(ts, grid).alias("interval_idx"), cal.fiscal_year(F.to_date(ts)).alias("fiscal_year"), cal.business_day(F.to_date(ts)).alias("is_business"))


def _raw(spark, sf_dir) -> DataFrame:
    env = F.when(F.col("user_id") % 7 == 0, "TEST").otherwise("PROD")
    return panels.table(spark, sf_dir, "events").select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), F.col("event_type").alias("app_id"), F.concat(F.lit("P"), F.col("user_id") % 2).alias("lpar"), env.alias("environment"), F.col("value").alias("msu")
    )


@query("""WITH r AS (SELECT date_trunc('hour', ts) AS ts, user_id % 7 <> 0 AS env, hour(ts) BETWEEN 8 AND 16 AND isodow(ts) <= 5 AS prime FROM events)
SELECT count(*) AS rows_in, count(*) FILTER (NOT env) AS dropped_non_prod, count(*) FILTER (env AND NOT prime) AS dropped_off_prime, count(*) FILTER (env AND prime) AS rows_out,
  min(CAST(ts AS DATE)) FILTER (env AND prime) AS first_date, max(CAST(ts AS DATE)) FILTER (env AND prime) AS last_date FROM r""")
def ing_scope_report(spark, sf_dir):
    return ing.scope_report(_raw(spark, sf_dir), ["PROD"])


@query("""WITH r AS (SELECT 'P' || (user_id % 2) AS lpar, value AS msu, CASE WHEN user_id % 2 = 0 THEN .8 ELSE 1.0 END::DOUBLE AS ratio FROM events WHERE user_id % 7 <> 0 AND hour(ts) BETWEEN 8 AND 16 AND isodow(ts) <= 5)
SELECT lpar, round(ratio, 6) AS capture_ratio, 6.0::DOUBLE AS mips_per_msu, count(*) AS n_rows, round(avg(msu * 6 / ratio), 6) AS mean_mips, round(max(msu * 6 / ratio), 6) AS max_mips FROM r GROUP BY ALL""")
def ing_normalise_audit(spark, sf_dir):
    return ing.audit(ing.normalise(ing.scope(_raw(spark, sf_dir), ["PROD"]), {"P0": 0.8}, 1.0, 6.0))


@query(f"""WITH {P1}, t AS (SELECT app_id FROM p1 GROUP BY app_id ORDER BY avg(mips) DESC, app_id LIMIT 4)
SELECT app_id, lpar, business_date, interval_idx, fiscal_year, round(mips, 6) AS mips FROM p1 WHERE app_id IN (SELECT app_id FROM t)""")
def ing_top_apps(spark, sf_dir):
    return ing.top_apps(panels.hourly(spark, sf_dir), 4)


@query(f"""WITH {P2}, {DENSE}, o AS (SELECT *, row_number() OVER w AS pos FROM dense WINDOW w AS (PARTITION BY app_id, interval_idx ORDER BY business_date)),
k AS (SELECT *, last_value(CASE WHEN mips IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY app_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS pa, last_value(mips IGNORE NULLS) OVER (PARTITION BY app_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS a,
  first_value(CASE WHEN mips IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY app_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS pb, first_value(mips IGNORE NULLS) OVER (PARTITION BY app_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b FROM o)
SELECT app_id, business_date, interval_idx, round(coalesce(mips, a + (b - a) * (pos - pa) / nullif(pb - pa, 0), a, b), 6) AS mips, mips IS NULL AS is_filled FROM k""")
def ing_fill(spark, sf_dir):
    return ing.fill(panels.daily(spark, sf_dir))


_LABELLED = f"""{P1}, {WIN}, lab AS (SELECT app_id, lpar, business_date, interval_idx, arg_min(kind, event_seq) AS event_label FROM p1 LEFT JOIN win
  ON business_date + to_hours(interval_idx + 8) >= s AND business_date + to_hours(interval_idx + 8) < e AND (w_lpar = '*' OR w_lpar = lpar) GROUP BY ALL)"""


def _labelled(spark, sf_dir) -> DataFrame:
    at = F.col("business_date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("interval_idx") + 8)
    return ing.label(panels.hourly(spark, sf_dir).withColumn("ts", at), panels.windows(spark, sf_dir))


@query(f"WITH {_LABELLED} SELECT app_id, lpar, business_date, interval_idx, event_label, event_label IS NOT NULL AS is_anomaly FROM lab")
def evt_labels(spark, sf_dir):
    return _labelled(spark, sf_dir).select("app_id", "lpar", "business_date", "interval_idx", "event_label", "is_anomaly")


@query(f"WITH {_LABELLED} SELECT business_date FROM lab GROUP BY 1 HAVING count(event_label) = 0")
def evt_clean_days(spark, sf_dir):
    return ing.clean_days(_labelled(spark, sf_dir))


@query(f"""WITH {P2}, n AS (SELECT *, count(*) OVER (PARTITION BY app_id) AS n, CASE WHEN count(mips) OVER w >= 5 THEN quantile_cont(mips, .5) OVER w END AS m0 FROM p2 WINDOW w AS (PARTITION BY app_id ORDER BY business_date ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING)),
m AS (SELECT *, coalesce(m0, first_value(m0 IGNORE NULLS) OVER (PARTITION BY app_id ORDER BY business_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(m0 IGNORE NULLS) OVER (PARTITION BY app_id ORDER BY business_date ROWS UNBOUNDED PRECEDING)) AS m FROM n),
d AS (SELECT *, abs(mips - m) AS d FROM m), s0 AS (SELECT *, CASE WHEN count(d) OVER w >= 5 THEN quantile_cont(d, .5) OVER w END AS s0 FROM d WINDOW w AS (PARTITION BY app_id ORDER BY business_date ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING)),
s AS (SELECT *, 1.4826 * coalesce(s0, first_value(s0 IGNORE NULLS) OVER (PARTITION BY app_id ORDER BY business_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(s0 IGNORE NULLS) OVER (PARTITION BY app_id ORDER BY business_date ROWS UNBOUNDED PRECEDING)) AS s FROM s0)
SELECT app_id, business_date, round(coalesce(CASE WHEN n >= 10 THEN (mips - m) / nullif(s, 0) END, 0), 6) AS z, coalesce(CASE WHEN n >= 10 THEN (mips - m) / nullif(s, 0) END, 0) > 6 AS is_spike FROM s""")
def evt_spikes(spark, sf_dir):
    return ing.spikes(panels.daily(spark, sf_dir)).select("app_id", "business_date", "z", "is_spike")


@query(f"WITH {P2}, {DENSE} SELECT app_id, business_date, interval_idx, round(mips, 6) AS mips, " + ", ".join(f"round(lag(mips, {k}) OVER w, 6) AS lag_{k}" for k in mod.LAGS) + ", "
       + ", ".join(f"round(avg(mips) OVER w{w}, 6) AS mean_{w}, round(stddev_pop(mips) OVER w{w}, 6) AS std_{w}" for w in mod.ROLLS)
       + " FROM dense WINDOW w AS (PARTITION BY app_id, interval_idx ORDER BY business_date), " + ", ".join(f"w{w} AS (PARTITION BY app_id, interval_idx ORDER BY business_date ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)" for w in mod.ROLLS))
def fea_lags_rolling(spark, sf_dir):
    return mod.lag_features(ing.densify(panels.daily(spark, sf_dir)))


@query(f"WITH {P2} SELECT app_id, round(greatest(coalesce(median(mips), 1), 1), 6) AS scale FROM p2 GROUP BY app_id")
def fea_scales(spark, sf_dir):
    return mod.scales(panels.daily(spark, sf_dir))


@query(f"""WITH {P2}, d AS (SELECT app_id, business_date, median(mips) AS m FROM p2 GROUP BY ALL HAVING median(mips) > 0), x AS (SELECT *, (business_date - min(business_date) OVER (PARTITION BY app_id)) / 365.25 AS x FROM d)
SELECT app_id, round(greatest(-.15, least(.4, CASE WHEN count(*) >= 30 THEN regr_slope(ln(m), x) ELSE 0 END)), 6) AS growth, count(*) AS n_days FROM x GROUP BY app_id""")
def mod_growth(spark, sf_dir):
    return mod.growth(panels.daily(spark, sf_dir))


@query(f"WITH {P3} SELECT app_id, interval_idx, round(coalesce(greatest(.8, least(1.6, avg(mips) / nullif(median(mips), 0))), 1), 6) AS feed FROM p3 GROUP BY ALL")
def mod_feed_correction(spark, sf_dir):
    return mod.feed_correction(panels.thirds(spark, sf_dir))


_LAST = "(SELECT DISTINCT business_date FROM {} ORDER BY business_date DESC LIMIT 250)"


@query(f"""WITH {P3} SELECT app_id, interval_idx, CAST(isodow(business_date) - 1 AS INT) AS dow, tau, round(quantile_cont(mips, [.1, .5, .9])[i], 6) AS value
FROM p3, (VALUES (.1::DOUBLE, 1), (.5::DOUBLE, 2), (.9::DOUBLE, 3)) t(tau, i) WHERE business_date IN {_LAST.format('p3')} GROUP BY app_id, interval_idx, dow, tau, i""")
def bas_climatology(spark, sf_dir):
    return mod.climatology(panels.thirds(spark, sf_dir), TAUS)


@query(f"""WITH {P3}, l AS (SELECT *, CAST(isodow(business_date) - 1 AS INT) AS dow, lag(mips) OVER (PARTITION BY app_id, interval_idx, isodow(business_date) ORDER BY business_date) AS prev FROM p3),
b AS (SELECT app_id, interval_idx, dow, arg_max(mips, business_date) AS base FROM l GROUP BY ALL),
r AS (SELECT app_id, interval_idx, quantile_cont(mips / prev, [.1, .5, .9]) AS q FROM l WHERE prev > 0 AND business_date IN {_LAST.format('p3')} GROUP BY ALL)
SELECT app_id, interval_idx, dow, tau, round(base * coalesce(q[i], 1), 6) AS value FROM b JOIN r USING (app_id, interval_idx), (VALUES (.1::DOUBLE, 1), (.5::DOUBLE, 2), (.9::DOUBLE, 3)) t(tau, i)""")
def bas_seasonal_naive(spark, sf_dir):
    return mod.seasonal_naive(panels.thirds(spark, sf_dir), TAUS)


_SCORED = f"""{P3}, taus AS (SELECT * FROM (VALUES (.1::DOUBLE, 1), (.5::DOUBLE, 2), (.9::DOUBLE, 3)) t(tau, i)), fit AS (SELECT app_id, interval_idx, quantile_cont(mips, [.1, .5, .9]) AS q FROM p3 WHERE year(business_date) < 2000 GROUP BY ALL),
scored AS (SELECT app_id, tau, mips AS y, q[i] AS q FROM p3 JOIN fit USING (app_id, interval_idx), taus WHERE year(business_date) >= 2000)"""


def _scored(spark, sf_dir) -> DataFrame:
    rows = panels.thirds(spark, sf_dir)
    fit = rows.where(F.year("business_date") < 2000).groupBy("app_id", "interval_idx").agg(F.percentile("mips", F.array(*map(F.lit, TAUS))).alias("q"))
    fit = fit.select("app_id", "interval_idx", F.inline(F.arrays_zip(F.array(*map(F.lit, TAUS)).alias("tau"), F.col("q"))))
    fit = fit.toDF("app_id", "interval_idx", "tau", "q")
    return rows.where(F.year("business_date") >= 2000).join(fit, ["app_id", "interval_idx"]).select("app_id", "tau", F.col("mips").alias("y"), "q")


@query(f"""WITH {_SCORED} SELECT *, round(error_ / sqrt(tau * (1 - tau) / n), 6) AS z, round(error_, 6) AS error FROM (SELECT tau, round(avg((y <= q)::INT), 6) AS empirical, count(*) AS n, round(avg(greatest(tau * (y - q), (tau - 1) * (y - q))), 6) AS pinball,
  avg((y <= q)::INT) - tau AS error_ FROM scored GROUP BY tau)""".replace("SELECT *, round(error_ /", "SELECT tau, empirical, n, pinball, round(error_ /"))
def eva_coverage(spark, sf_dir):
    return mod.coverage(_scored(spark, sf_dir))


@query(f"""WITH {_SCORED}, s AS (SELECT app_id, tau, y - q AS s FROM scored),
o AS (SELECT app_id, tau, list(s ORDER BY s) AS l, count(*) AS n FROM s GROUP BY ALL), p AS (SELECT tau, list(s ORDER BY s) AS l, count(*) AS n FROM s GROUP BY ALL)
SELECT o.app_id, o.tau, round(CASE WHEN o.n < 200 THEN p.l[ceil(round(least(1, ceil((p.n + 1) * p.tau) / p.n) * (p.n - 1), 9))::INT + 1] ELSE o.l[ceil(round(least(1, ceil((o.n + 1) * o.tau) / o.n) * (o.n - 1), 9))::INT + 1] END, 6) AS adj, o.n < 200 AS used_pooled, o.n AS n_scores FROM o JOIN p USING (tau)""")
def con_conformal(spark, sf_dir):
    return con.one_sided(_scored(spark, sf_dir))


@query(f"""WITH {P2}, {DAILY}, x AS (SELECT *, max(daily_peak) OVER m AS mp, row_number() OVER (PARTITION BY lpar, fiscal_year, year(business_date), month(business_date) ORDER BY business_date) = 1 AS mf,
  row_number() OVER (PARTITION BY lpar, fiscal_year ORDER BY daily_peak DESC, business_date) AS dr FROM daily WINDOW m AS (PARTITION BY lpar, fiscal_year, year(business_date), month(business_date)))
SELECT lpar, fiscal_year, round(max(daily_peak), 6) AS annual_max, round(quantile_cont(daily_peak, .95), 6) AS p95_of_daily_peaks, round(quantile_cont(daily_peak, .99), 6) AS p99_of_daily_peaks, round(avg(daily_peak), 6) AS mean_of_daily_peaks,
  round(avg(daily_mean), 6) AS mean_daily_mean, round(avg(mp) FILTER (mf), 6) AS mean_of_monthly_peaks, round(max(mp), 6) AS max_of_monthly_peaks, round(avg(daily_peak) FILTER (dr <= 4), 6) AS top4_mean_of_daily_peaks FROM x GROUP BY ALL""")
def red_reducers(spark, sf_dir):
    daily = panels.daily(spark, sf_dir).groupBy("lpar", "fiscal_year", "business_date").agg(F.sum("mips").alias("daily_peak"), F.avg("mips").alias("daily_mean"))
    return mod.reduced(daily, ["lpar", "fiscal_year"])


@query(f"""WITH {P1}, s AS (SELECT lpar, business_date, interval_idx, sum(mips) AS mips FROM p1 GROUP BY ALL), w AS (SELECT *, avg(mips) OVER o AS a, count(*) OVER o AS c FROM s WINDOW o AS (PARTITION BY lpar ORDER BY business_date, interval_idx ROWS 3 PRECEDING))
SELECT lpar, business_date, round(coalesce(max(a) FILTER (c = 4), 0), 6) AS r4ha FROM w GROUP BY ALL""")
def sim_r4ha(spark, sf_dir):
    rows = panels.hourly(spark, sf_dir).groupBy("lpar", "business_date", "interval_idx").agg(F.sum("mips").alias("mips"))
    return mod.r4ha(rows, ["lpar"], 4)


_RES = f"""{P3}, fit AS (SELECT app_id, interval_idx, median(mips) AS med, quantile_cont(mips, .1) AS q10, quantile_cont(mips, .9) AS q90 FROM p3 GROUP BY ALL),
fit2 AS (SELECT *, greatest((q90 - q10) / 2, greatest(abs(med) * .02, .1)) AS half FROM fit),
res AS (SELECT app_id, business_date, interval_idx, med, half, greatest(-8, least(8, (mips - med) / half)) AS r FROM p3 JOIN fit2 USING (app_id, interval_idx)),
good AS (SELECT business_date, row_number() OVER (ORDER BY business_date) - 1 AS pool_idx FROM res GROUP BY business_date HAVING count(r) = (SELECT count(DISTINCT (app_id, interval_idx)) FROM res)),
cells AS (SELECT pool_idx, app_id, interval_idx, greatest(0, med + r * half) AS x FROM res JOIN good USING (business_date))"""


def _residuals(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = panels.thirds(spark, sf_dir)
    q = F.percentile("mips", F.array(*map(F.lit, TAUS)))
    fit = rows.groupBy("app_id", "interval_idx").agg(q.alias("q")).select("app_id", "interval_idx", F.col("q")[1].alias("med"), F.col("q")[0].alias("q10"), F.col("q")[2].alias("q90"))
    half = F.greatest((F.col("q90") - F.col("q10")) / 2, F.greatest(F.abs("med") * 0.02, F.lit(0.1)))
    return sim.residuals(rows, fit), fit.withColumn("half", half)


@query(f"WITH {_RES} SELECT app_id, business_date, interval_idx, round(r, 6) AS r, CAST(pool_idx AS INT) AS pool_idx FROM res JOIN good USING (business_date)")
def dep_pool(spark, sf_dir):
    return sim.pool(_residuals(spark, sf_dir)[0])


@query(f"WITH {_RES} SELECT x.app_id AS a, y.app_id AS b, round(corr(x.r, y.r), 6) AS corr, count(*) AS n FROM res x JOIN res y USING (business_date, interval_idx) WHERE x.app_id < y.app_id GROUP BY ALL")
def dep_correlation(spark, sf_dir):
    return sim.correlation(_residuals(spark, sf_dir)[0])


@query(f"""WITH {P3}, s AS (SELECT business_date, max(s) AS num FROM (SELECT business_date, interval_idx, sum(mips) AS s FROM p3 GROUP BY ALL) GROUP BY 1), a AS (SELECT business_date, sum(m) AS den FROM (SELECT business_date, app_id, max(mips) AS m FROM p3 GROUP BY ALL) GROUP BY 1)
SELECT business_date, CAST(isodow(business_date) - 1 AS INT) AS dow, round(num / den, 6) AS factor FROM s JOIN a USING (business_date) WHERE den > 0""")
def dep_factor(spark, sf_dir):
    return sim.factor(panels.thirds(spark, sf_dir))


@query(f"""WITH {_RES}, n AS (SELECT count(*) AS n FROM good), dr AS (SELECT p AS path_id, CAST(d AS INT) AS day_idx, (p * 1103515245 + d * 12345 + 20260101) % n AS pool_idx FROM range(200) a(p), range(30) b(d), n),
su AS (SELECT pool_idx, max(s) AS peak, avg(s) AS mean FROM (SELECT pool_idx, interval_idx, sum(x) AS s FROM cells GROUP BY ALL) GROUP BY 1), ap AS (SELECT pool_idx, sum(m) AS sum_app_peaks FROM (SELECT pool_idx, app_id, max(x) AS m FROM cells GROUP BY ALL) GROUP BY 1)
SELECT path_id, day_idx, {_r('peak', 'mean', 'sum_app_peaks')} FROM dr JOIN su USING (pool_idx) JOIN ap USING (pool_idx)""")
def sim_paths(spark, sf_dir):
    res, fit = _residuals(spark, sf_dir)
    pooled = sim.pool(res)
    n = pooled.agg(F.max("pool_idx")).first()[0]
    if n is None:
        n = -1
    pick = (F.col("path_id") * 1103515245 + F.col("day_idx") * 12345 + 20260101) % F.lit(max(1, n + 1))
    return sim.simulate(sim.draws(spark, 200, 30, pick), pooled, fit.select("app_id", "interval_idx", "med", "half"))


@query()
def sim_paths_hashed(spark, sf_dir):
    """1,000 paths of 60 days with the production draw; SQL has no such hash."""
    res, fit = _residuals(spark, sf_dir)
    pooled = sim.pool(res)
    n = (pooled.agg(F.max("pool_idx")).first()[0] or 0) + 1
    drawn = sim.draws(spark, 1000, 60, sim.hashed(20260101, n))
    daily = sim.simulate(drawn, pooled, fit.select("app_id", "interval_idx", "med", "half"))
    return daily.groupBy("path_id").agg(F.max("peak").alias("annual_max"), F.percentile("peak", 0.95).alias("p95"), F.avg("mean").alias("mean"), F.avg(F.col("peak") / F.col("sum_app_peaks")).alias("coincidence"))


@query(f"""WITH {P3}, f AS (SELECT app_id, business_date, interval_idx, mips AS value FROM p3)
SELECT app_id, business_date, interval_idx, round(value * CASE WHEN app_id = 'A' THEN 1.3 ELSE 1 END * CASE WHEN app_id = 'N' AND business_date >= DATE '1999-01-01' THEN .5 ELSE 1 END, 6) AS value FROM f""")
def scn_scenario(spark, sf_dir):
    f = panels.thirds(spark, sf_dir).select("app_id", "business_date", "interval_idx", F.col("mips").alias("value"))
    return mod.scenario(f, {"A": 1.3}, {"N": ("1999-01-01", 0.5)}, ["A", "N", "R"])


_WIDE = f"""{P3}, fit AS (SELECT app_id, interval_idx, quantile_cont(mips, [.1, .5, .9]) AS q FROM p3 WHERE year(business_date) < 2000 GROUP BY ALL),
wide AS (SELECT app_id, business_date, interval_idx, mips AS y, q FROM p3 JOIN fit USING (app_id, interval_idx) WHERE year(business_date) >= 2000),
pits AS (SELECT app_id, business_date, interval_idx, y, q, CASE WHEN y < q[1] THEN 0 WHEN y < q[2] THEN .1 + .4 * (y - q[1]) / (q[2] - q[1]) WHEN y < q[3] THEN .5 + .4 * (y - q[2]) / (q[3] - q[2]) WHEN y = q[3] THEN .9 ELSE 1 END::DOUBLE AS pit FROM wide)"""


def _wide(spark, sf_dir) -> DataFrame:
    rows = panels.thirds(spark, sf_dir)
    fit = rows.where(F.year("business_date") < 2000).groupBy("app_id", "interval_idx").agg(F.percentile("mips", F.array(*map(F.lit, TAUS))).alias("q"))
    rows = rows.where(F.year("business_date") >= 2000).join(fit, ["app_id", "interval_idx"]).withColumn("pit", eva.pit(F.col("mips"), F.col("q"), TAUS))
    return rows.select("app_id", "business_date", "interval_idx", F.col("mips").alias("y"), "q", "pit")


@query(f"WITH {_WIDE} SELECT app_id, business_date, interval_idx, round(pit, 6) AS pit FROM pits")
def eva_pit(spark, sf_dir):
    return _wide(spark, sf_dir).drop("y", "q")


@query(f"""WITH {_WIDE}, r AS (SELECT pit, row_number() OVER (ORDER BY pit) AS i, count(*) OVER () AS n FROM pits)
SELECT round(max(greatest(i / n - pit, pit - (i - 1) / n)), 6) AS ks_stat, count(*) AS n, round(avg(pit), 6) AS pit_mean, round(var_pop(pit), 6) AS pit_var, CASE WHEN var_pop(pit) > 1 / 12 THEN 'under' ELSE 'over' END AS dispersion FROM r""")
def eva_pit_uniformity(spark, sf_dir):
    return eva.pit_uniformity(_wide(spark, sf_dir))


@query(f"WITH {_WIDE} SELECT app_id, count(*) AS n, round(avg((q[3] - q[1]) + 10 * greatest(q[1] - y, y - q[3], 0)), 6) AS interval_score FROM wide GROUP BY app_id")
def eva_interval_score(spark, sf_dir):
    q = F.col("q")
    return _wide(spark, sf_dir).groupBy("app_id").agg(F.count("*").alias("n"), F.avg(eva.interval_score(F.col("y"), q[0], q[2], 0.8)).alias("interval_score"))


_HELD = f"{P3}, held AS (SELECT DISTINCT business_date FROM p3 ORDER BY business_date DESC LIMIT 60)"


@query(f"WITH {_HELD} SELECT app_id, business_date, interval_idx, business_date IN (SELECT business_date FROM held) AS held_out FROM p3")
def con_split(spark, sf_dir):
    train, held = con.split_holdout(panels.thirds(spark, sf_dir), 60)
    both = train.withColumn("held_out", F.lit(False)).unionByName(held.withColumn("held_out", F.lit(True)))
    return both.select("app_id", "business_date", "interval_idx", "held_out")


@query(f"WITH {_LABELLED} SELECT app_id, business_date, interval_idx, round(sum(mips), 6) AS y FROM lab JOIN p1 USING (app_id, lpar, business_date, interval_idx) WHERE event_label IS NULL GROUP BY ALL")
def con_observed(spark, sf_dir):
    return con.observed(_labelled(spark, sf_dir))


@query(f"WITH {_WIDE} SELECT app_id, business_date, interval_idx, round(greatest(q[1] - y, y - q[3]), 6) AS score FROM wide")
def con_scores(spark, sf_dir):
    q = F.col("q")
    return _wide(spark, sf_dir).select("app_id", "business_date", "interval_idx", con.outside(F.col("y"), q[0], q[2]).alias("score"))


#: The element of a list of n scores, ascending, that a level picks.
_PICK = "{0}.l[ceil(round(least(1, ceil(({0}.n + 1) * {1}) / {0}.n) * ({0}.n - 1), 9))::INT + 1]"


@query(f"""WITH {_WIDE}, s AS (SELECT app_id, greatest(q[1] - y, y - q[3]) AS s FROM wide), o AS (SELECT app_id, list(s ORDER BY s) AS l, count(*) AS n FROM s GROUP BY ALL), p AS (SELECT list(s ORDER BY s) AS l, count(*) AS n FROM s)
SELECT app_id, tau, round(side * CASE WHEN o.n < 200 THEN {_PICK.format('p', '.8')} ELSE {_PICK.format('o', '.8')} END, 6) + 0 AS adj, o.n < 200 AS used_pooled, o.n AS n_scores FROM o, p, (VALUES (.1::DOUBLE, -1), (.5::DOUBLE, 0), (.9::DOUBLE, 1)) t(tau, side)""")
def con_symmetric(spark, sf_dir):
    return con.symmetric(_wide(spark, sf_dir), TAUS)


@query(f"""WITH {_WIDE}, long AS (SELECT app_id, tau, y - q[i] AS s FROM wide, (VALUES (.1::DOUBLE, 1), (.5::DOUBLE, 2), (.9::DOUBLE, 3)) t(tau, i)),
o AS (SELECT app_id, tau, list(s ORDER BY s) AS l, count(*) AS n FROM long GROUP BY ALL), p AS (SELECT tau, list(s ORDER BY s) AS l, count(*) AS n FROM long GROUP BY ALL),
a AS (SELECT o.app_id, list(CASE WHEN o.n < 200 THEN {_PICK.format('p', 'p.tau')} ELSE {_PICK.format('o', 'o.tau')} END ORDER BY o.tau) AS a FROM o JOIN p ON o.tau = p.tau GROUP BY ALL),
z AS (SELECT app_id, business_date, interval_idx, list_sort([greatest(q[1] + a[1], 0), greatest(q[2] + a[2], 0), greatest(q[3] + a[3], 0)]) AS q FROM wide JOIN a USING (app_id))
SELECT app_id, business_date, interval_idx, tau, round(q[i], 6) AS value FROM z, (VALUES (.1::DOUBLE, 1), (.5::DOUBLE, 2), (.9::DOUBLE, 3)) t(tau, i)""")
def con_shifted(spark, sf_dir):
    wide = _wide(spark, sf_dir)
    shifts = con.one_sided(qua.to_long(wide, TAUS, keep=["y"]).withColumnRenamed("value", "q"))
    return qua.to_long(con.shifted(wide, shifts, TAUS), TAUS)


def _by_weekday(train: DataFrame, ahead: list[date]) -> DataFrame:
    """A cube of the quantiles by app, interval and weekday of the last 250 dates."""
    q = F.percentile("mips", F.array(*map(F.lit, TAUS))).alias("q")
    lanes = mod.recent(train, 250).groupBy("app_id", "interval_idx", F.weekday("business_date").alias("dow")).agg(q)
    days = train.sparkSession.createDataFrame([(d,) for d in ahead], "business_date date").withColumn("dow", F.weekday("business_date"))
    return lanes.join(F.broadcast(days), "dow").drop("dow")


@query(f"""WITH {_HELD}, tr AS (SELECT * FROM p3 WHERE business_date NOT IN (SELECT business_date FROM held)),
m AS (SELECT app_id, interval_idx, isodow(business_date) AS dow, quantile_cont(mips, [.1, .5, .9]) AS q FROM tr WHERE business_date IN {_LAST.format('tr')} GROUP BY ALL),
te AS (SELECT p3.app_id, p3.mips AS y, q FROM p3 JOIN m ON m.app_id = p3.app_id AND m.interval_idx = p3.interval_idx AND m.dow = isodow(business_date) WHERE business_date IN (SELECT business_date FROM held)),
long AS (SELECT app_id, tau, y - q[i] AS s FROM te, (VALUES (.1::DOUBLE, 1), (.5::DOUBLE, 2), (.9::DOUBLE, 3)) t(tau, i)),
o AS (SELECT app_id, tau, list(s ORDER BY s) AS l, count(*) AS n FROM long GROUP BY ALL), p AS (SELECT tau, list(s ORDER BY s) AS l, count(*) AS n FROM long GROUP BY ALL),
a AS (SELECT o.app_id, list(CASE WHEN o.n < 200 THEN {_PICK.format('p', 'p.tau')} ELSE {_PICK.format('o', 'o.tau')} END ORDER BY o.tau) AS a FROM o JOIN p ON o.tau = p.tau GROUP BY ALL),
z AS (SELECT y, q AS raw, list_sort([greatest(q[1] + a[1], 0), greatest(q[2] + a[2], 0), greatest(q[3] + a[3], 0)]) AS q FROM te JOIN a USING (app_id))
SELECT tau, count(*) AS n, round(avg((y <= raw[i])::INT), 6) AS before, round(avg((y <= q[i])::INT), 6) AS after FROM z, (VALUES (.1::DOUBLE, 1), (.5::DOUBLE, 2), (.9::DOUBLE, 3)) t(tau, i) GROUP BY tau""")
def con_calibrate(spark, sf_dir):
    return con.calibrate(panels.thirds(spark, sf_dir), 60, _by_weekday, TAUS).coverage()


@query(f"""WITH {_LABELLED}, r AS (SELECT * FROM lab JOIN p1 USING (app_id, lpar, business_date, interval_idx)), k AS (SELECT *, event_label IS NULL AND mips > 2 * avg(mips) OVER (PARTITION BY app_id) AS is_spike FROM r)
SELECT app_id, event_label AS label, count(*) AS intervals, count(DISTINCT business_date) AS days, round(max(mips), 6) AS max_mips FROM k WHERE event_label IS NOT NULL GROUP BY ALL
UNION ALL SELECT app_id, 'UNEXPLAINED_SPIKE', count(*), count(DISTINCT business_date), round(max(mips), 6) FROM k WHERE is_spike GROUP BY ALL""")
def evt_report(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    high = F.col("mips") > 2 * F.avg("mips").over(Window.partitionBy("app_id"))
    return ing.anomaly_report(rows.withColumn("is_spike", ~F.col("is_anomaly") & high))


@query(f"""WITH {P1}, s AS (SELECT min(business_date) AS a, max(business_date) AS b, count(DISTINCT app_id) AS apps, count(*) AS present FROM p1),
d AS (SELECT count(*) AS n FROM (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS d FROM s) WHERE isodow(d) <= 5) SELECT n * apps * 9 AS expected, present, n * apps * 9 - present AS missing FROM s, d""")
def ing_missing(spark, sf_dir):
    return ing.missing(panels.hourly(spark, sf_dir))


@query(f"""WITH {P3}, d AS (SELECT app_id, business_date, median(mips) AS m FROM p3 GROUP BY ALL HAVING median(mips) > 0), x AS (SELECT *, (business_date - min(business_date) OVER (PARTITION BY app_id)) / 365.25 AS x FROM d),
g AS (SELECT app_id, greatest(-.15, least(.4, CASE WHEN count(*) >= 30 THEN regr_slope(ln(m), x) ELSE 0 END)) AS growth FROM x GROUP BY app_id), r AS (SELECT * FROM (VALUES ('A', .1::DOUBLE), ('R', -.05::DOUBLE)) t(app_id, rate))
SELECT app_id, business_date, interval_idx, round(mips * CASE WHEN rate IS NULL THEN 1 ELSE exp((rate - growth) * (business_date - DATE '1997-12-31') / 365.25) END * CASE WHEN app_id = 'A' THEN 1.3 ELSE 1 END, 6) AS value FROM p3 JOIN g USING (app_id) LEFT JOIN r USING (app_id)""")
def scn_growth(spark, sf_dir):
    rows = panels.thirds(spark, sf_dir)
    f = rows.select("app_id", "business_date", "interval_idx", F.col("mips").alias("value"))
    return mod.scenario(f, {"A": 1.3}, {}, ["A", "N", "R"], {"A": 0.1, "R": -0.05}, mod.growth(rows), date(1997, 12, 31))


_ROLLING = f"""{P3}, d AS (SELECT business_date, row_number() OVER (ORDER BY business_date) - 1 AS pos, count(*) OVER () AS n FROM (SELECT DISTINCT business_date FROM p3)),
f AS (SELECT row_number() OVER (ORDER BY o.pos) - 1 AS fold, o.business_date AS origin, e.business_date AS until FROM d o JOIN d e ON e.pos = o.pos + 60 WHERE o.pos IN (o.n - 61, o.n - 121, o.n - 181) AND o.pos >= 250),
tr AS (SELECT fold, app_id, interval_idx, business_date, isodow(business_date) AS dow, mips, lag(mips) OVER (PARTITION BY fold, app_id, interval_idx, isodow(business_date) ORDER BY business_date) AS prev FROM p3 JOIN f ON business_date <= origin),
ld AS (SELECT fold, business_date FROM (SELECT DISTINCT fold, business_date FROM tr) QUALIFY row_number() OVER (PARTITION BY fold ORDER BY business_date DESC) <= 250),
nr AS (SELECT tr.* FROM tr JOIN ld USING (fold, business_date)),
m AS (SELECT fold, app_id, interval_idx, dow, 'interval_climatology' AS model, quantile_cont(mips, [.1, .5, .9]) AS q FROM nr GROUP BY ALL UNION ALL
  SELECT b.fold, b.app_id, b.interval_idx, b.dow, 'seasonal_naive', list_transform(coalesce(r.r, [1, 1, 1]), lambda v: v * b.base) FROM (SELECT fold, app_id, interval_idx, dow, arg_max(mips, business_date) AS base FROM tr GROUP BY ALL) b
  JOIN (SELECT fold, app_id, interval_idx, quantile_cont(mips / prev, [.1, .5, .9]) FILTER (prev > 0) AS r FROM nr GROUP BY ALL) r USING (fold, app_id, interval_idx)),
te AS (SELECT fold, model, mips AS y, q FROM p3 JOIN f ON business_date > origin AND business_date <= until JOIN m USING (fold, app_id, interval_idx) WHERE m.dow = isodow(business_date)),
sc AS (SELECT CAST(fold AS INT) AS fold, model, count(*) AS n, avg((greatest(.1 * (y - q[1]), -.9 * (y - q[1])) + greatest(.5 * (y - q[2]), -.5 * (y - q[2])) + greatest(.9 * (y - q[3]), -.1 * (y - q[3]))) / 3) AS pinball_mean,
  avg((q[3] - q[1]) + 10 * greatest(q[1] - y, y - q[3], 0)) AS interval_score FROM te GROUP BY ALL)"""


def _rolling(spark, sf_dir) -> DataFrame:
    rows = panels.thirds(spark, sf_dir)
    return eva.rolling_origin(rows, eva.folds(rows, 3, 60, 60, 250), TAUS)


@query(f"WITH {_ROLLING} SELECT fold, model, n, round(pinball_mean, 6) AS pinball_mean, round(interval_score, 6) AS interval_score FROM sc")
def eva_rolling_origin(spark, sf_dir):
    return _rolling(spark, sf_dir)


@query(f"""WITH {_ROLLING} SELECT model, n_folds, round(p, 6) AS pinball_mean, round(s, 6) AS interval_score, CAST(row_number() OVER (ORDER BY p, model) AS INT) AS place
FROM (SELECT model, count(*) AS n_folds, avg(pinball_mean) AS p, avg(interval_score) AS s FROM sc GROUP BY model)""")
def eva_leaderboard(spark, sf_dir):
    return eva.leaderboard(_rolling(spark, sf_dir))


#: Realised peaks, submissions of earlier peaks, and the mean of the year as a model.
_VERSUS = f"""{P2}, re AS (SELECT app_id, fiscal_year, max(mips) AS realised_peak_mips, avg(mips) * 2 AS model_peak_mips FROM p2 GROUP BY ALL),
su AS (SELECT app_id, fiscal_year + 1 AS fiscal_year, max(mips) * (.8 + .1 * (ascii(app_id) % 5)) AS submitted_peak_mips FROM p2 GROUP BY app_id, fiscal_year),
cmp AS (SELECT app_id, fiscal_year, realised_peak_mips, submitted_peak_mips, model_peak_mips, submitted_peak_mips - realised_peak_mips AS submission_error, 100 * abs(submitted_peak_mips - realised_peak_mips) / realised_peak_mips AS submission_abs_pct,
  model_peak_mips - realised_peak_mips AS model_error, 100 * abs(model_peak_mips - realised_peak_mips) / realised_peak_mips AS model_abs_pct FROM re JOIN su USING (app_id, fiscal_year)),
vs AS (SELECT *, model_abs_pct < submission_abs_pct AS model_better FROM cmp)"""


def _versus(spark, sf_dir) -> DataFrame:
    p2 = panels.daily(spark, sf_dir)
    real = p2.groupBy("app_id", "fiscal_year").agg(F.max("mips").alias("realised_peak_mips"), (F.avg("mips") * 2).alias("model_peak_mips"))
    return eva.compare_to_submissions(real.drop("realised_peak_mips"), _submissions(p2), real.drop("model_peak_mips"))


@query(f"WITH {_VERSUS} SELECT app_id, fiscal_year, {_r('realised_peak_mips', 'submitted_peak_mips', 'model_peak_mips', 'submission_error', 'submission_abs_pct', 'model_error', 'model_abs_pct')}, model_better FROM vs")
def eva_submissions(spark, sf_dir):
    return _versus(spark, sf_dir)


@query(f"""WITH {_VERSUS}, t AS (SELECT model_better FROM vs ORDER BY realised_peak_mips DESC, app_id, fiscal_year LIMIT (SELECT greatest(1, count(*) // 5) FROM vs))
SELECT count(*) AS n_comparisons, round(avg(model_better::INT), 6) AS model_better_share, (SELECT round(avg(model_better::INT), 6) FROM t) AS model_better_share_top,
  """ + ", ".join(f"round(avg({s}_abs_pct), 6) AS {s}_mape, round(sum(realised_peak_mips * {s}_abs_pct) / sum(realised_peak_mips), 6) AS {s}_mape_weighted, round(100 * avg({s}_error / realised_peak_mips), 6) AS {s}_bias_pct" for s in ("submission", "model")) + " FROM vs")
def eva_submission_summary(spark, sf_dir):
    return eva.summarise(_versus(spark, sf_dir))


@query(f"""WITH {_VERSUS}, b AS (SELECT app_id, avg(submitted_peak_mips / realised_peak_mips) AS ratio, count(*) AS n_cycles FROM vs GROUP BY app_id),
o AS (SELECT su.app_id, fiscal_year, submitted_peak_mips, n_cycles, CASE WHEN coalesce(n_cycles, 0) < 2 THEN 1 ELSE coalesce(ratio, 1) END AS bias_ratio FROM su LEFT JOIN b USING (app_id))
SELECT app_id, fiscal_year, n_cycles, {_r('submitted_peak_mips', 'bias_ratio')}, round(submitted_peak_mips / bias_ratio, 6) AS debiased_peak_mips FROM o""")
def eva_debiased(spark, sf_dir):
    bias = _versus(spark, sf_dir).groupBy("app_id").agg(F.avg(F.col("submitted_peak_mips") / F.col("realised_peak_mips")).alias("bias_ratio"), F.count("*").alias("n_cycles"))
    return eva.debiased_submissions(_submissions(panels.daily(spark, sf_dir)), bias)


@query(f"""WITH {_LABELLED}, t AS (SELECT lpar, business_date, max(v) AS peak FROM (SELECT lpar, business_date, interval_idx, sum(mips) AS v FROM p1 GROUP BY ALL) GROUP BY ALL),
x AS (SELECT DISTINCT business_date FROM lab WHERE event_label IS NOT NULL)
SELECT lpar, round(max(peak), 6) AS all_days, round(max(peak) FILTER (x.business_date IS NULL), 6) AS clean_days, count(x.business_date) AS n_excluded FROM t LEFT JOIN x USING (business_date) GROUP BY lpar""")
def eva_realised(spark, sf_dir):
    return eva.realised(panels.hourly(spark, sf_dir), _labelled(spark, sf_dir).where("event_label is not null"))


@query(f"""WITH {_RES} SELECT round(avg(r), 6) AS mean, round(stddev_pop(r), 6) AS sd, round(quantile_cont(r, .01), 6) AS p01, round(quantile_cont(r, .99), 6) AS p99, count(r) AS n_cells,
  count(DISTINCT business_date) AS n_days, count(DISTINCT app_id) AS n_apps FROM res""")
def dep_summary(spark, sf_dir):
    return dep.summary(_residuals(spark, sf_dir)[0])


_ACF = "acf AS (SELECT y.interval_idx - x.interval_idx AS lag, corr(x.r, y.r) AS corr, count(*) AS n FROM res x JOIN res y USING (app_id, business_date) WHERE y.interval_idx > x.interval_idx GROUP BY ALL)"


@query(f"WITH {_RES}, {_ACF} SELECT CAST(lag AS INT) AS lag, round(corr, 6) AS corr, n FROM acf")
def dep_autocorrelation(spark, sf_dir):
    return dep.autocorrelation(_residuals(spark, sf_dir)[0])


@query(f"""WITH {_RES}, {_ACF}, c AS (SELECT corr(x.r, y.r) AS corr FROM res x JOIN res y USING (business_date, interval_idx) WHERE x.app_id < y.app_id GROUP BY x.app_id, y.app_id)
SELECT round(avg(corr), 6) AS mean_corr, round(max(corr), 6) AS max_corr, round(quantile_cont(corr, .95), 6) AS p95_corr, (SELECT round(max(corr) FILTER (lag = 1), 6) FROM acf) AS acf1, (SELECT round(max(corr) FILTER (lag = 4), 6) FROM acf) AS acf4 FROM c""")
def dep_report(spark, sf_dir):
    res = _residuals(spark, sf_dir)[0]
    return dep.report(sim.correlation(res), dep.autocorrelation(res))


@query(f"""WITH {_RES}, g AS (SELECT res.* FROM res JOIN good USING (business_date)),
u AS (SELECT app_id, business_date, interval_idx, (rank() OVER (PARTITION BY app_id ORDER BY r) + (count(*) OVER (PARTITION BY app_id, r) - 1) / 2 - .5) / count(*) OVER (PARTITION BY app_id) > .9 AS o FROM g)
SELECT x.app_id AS a, y.app_id AS b, count(*) FILTER (x.o) AS n_over, round(count(*) FILTER (x.o AND y.o) / nullif(count(*) FILTER (x.o), 0), 6) AS observed FROM u x JOIN u y USING (business_date, interval_idx) WHERE x.app_id < y.app_id GROUP BY ALL""")
def dep_tail(spark, sf_dir):
    return dep.tail_dependence(sim.pool(_residuals(spark, sf_dir)[0]))


@query(f"""WITH {P3}, s AS (SELECT business_date, max(s) AS num FROM (SELECT business_date, interval_idx, sum(mips) AS s FROM p3 GROUP BY ALL) GROUP BY 1), a AS (SELECT business_date, sum(m) AS den FROM (SELECT business_date, app_id, max(mips) AS m FROM p3 GROUP BY ALL) GROUP BY 1),
f AS (SELECT num / den AS f FROM s JOIN a USING (business_date) WHERE den > 0)
SELECT count(*) AS n, round(avg(f), 6) AS mean, round(coalesce(stddev_samp(f), 0), 6) AS sd, round(quantile_cont(f, .05), 6) AS p05, round(quantile_cont(f, .5), 6) AS p50, round(quantile_cont(f, .95), 6) AS p95 FROM f""")
def dep_factor_summary(spark, sf_dir):
    return dep.factor_summary(sim.factor(panels.thirds(spark, sf_dir)))


@query()
def dep_adequacy(spark, sf_dir):
    """Bootstrap by hash draws; SQL has no such hash."""
    return dep.adequacy(sim.factor(panels.thirds(spark, sf_dir)))


@query()
def sim_copula(spark, sf_dir):
    """500 paths of 60 days from the copula; its draws are numpy's."""
    res, fit = _residuals(spark, sf_dir)
    copula = dep.fit_copula(sim.pool(res))
    daily = dep.simulate_copula(spark, copula, fit.select("app_id", "interval_idx", "med", "half"), 500, 60)
    return daily.groupBy("path_id").agg(F.max("peak").alias("annual_max"), F.percentile("peak", 0.95).alias("p95"), F.avg("mean").alias("mean"), F.avg(F.col("peak") / F.col("sum_app_peaks")).alias("coincidence"))


def _stage1(spark, sf_dir):
    """The model on the daily panel; all dates of one app and a day dimension with a horizon of 100 weekdays."""
    dense = ing.densify(panels.daily(spark, sf_dir)).select("app_id", "business_date", "interval_idx", "mips").persist()
    first, last = dense.agg(F.min("business_date"), F.max("business_date")).first()
    grid = cal.Grid()
    known = cal.days(spark, first, last, grid)
    spec = qua.Spec(first, (last - first).days / 365.25, 0.5, 1)
    model, rows, scales = qua.trained(dense, known, spec, TAUS)
    return dense, last, spec, model, rows, scales


@query()
def mod_fitted(spark, sf_dir):
    """In-sample quantiles of the fitted regression; an iterative fit."""
    _, _, _, model, rows, scales = _stage1(spark, sf_dir)
    return qua.fitted(rows, model, scales)


@query()
def mod_forecast(spark, sf_dir):
    """Quantiles of the next 140 days by the recursion; one loop an app."""
    dense, last, spec, model, _, scales = _stage1(spark, sf_dir)
    future = cal.days(spark, last + timedelta(days=1), last + timedelta(days=140))
    cube = qua.forecast(dense, future, scales, mod.growth(dense.where("mips is not null")), mod.feed_correction(dense), model, spec)
    return qua.to_long(cube, TAUS)


@query(r"""SELECT event_id, ts, trim(event_type) AS app_id, 'P' || (user_id % 2) AS lpar, 'PROD' AS environment, false AS is_anomaly, CAST(NULL AS VARCHAR) AS event_label, CAST(ts AS DATE) AS business_date,
CAST(year(ts) + (month(ts) >= 11)::INT AS INT) AS fiscal_year, round(value, 6) AS value FROM events WHERE ts >= DATE '2024-01-05' AND ts < DATE '2024-01-13'""")
def src_conform(spark, sf_dir):
    rows = panels.table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("TS"), F.concat(F.col("event_type"), F.lit(" ")).alias("KIND"), F.concat(F.lit("P"), F.col("user_id") % 2).alias("LPAR"), "value")
    rows = lake.normalised(rows, "intervals", {"KIND": "app_id"})
    return lake.conform(lake.clipped(rows, "intervals", date(2024, 1, 5), date(2024, 1, 12)), "intervals")


def _paths(spark, sf_dir) -> DataFrame:
    """Line items by flag as paths of daily figures."""
    rows = panels.daily(spark, sf_dir)
    return rows.groupBy(F.ascii("app_id").cast("long").alias("path_id"), "fiscal_year", "business_date").agg(F.sum("mips").alias("daily_peak"), F.avg("mips").alias("daily_mean"))


_LEVELS = "(VALUES (.5::DOUBLE, 1), (.9::DOUBLE, 2), (.95::DOUBLE, 3), (.99::DOUBLE, 4)) t(level, i)"
_PATHS = f"{P2}, paths AS (SELECT ascii(app_id)::BIGINT AS path_id, fiscal_year, business_date, sum(mips) AS daily_peak, avg(mips) AS daily_mean FROM p2 GROUP BY ALL)"
_FIGS = f"""{_PATHS}, fg AS (SELECT path_id, fiscal_year, max(daily_peak) AS annual_max, quantile_cont(daily_peak, .95) AS p95_of_daily_peaks FROM paths GROUP BY ALL), figs AS (UNPIVOT fg ON annual_max, p95_of_daily_peaks INTO NAME reducer VALUE value)"""


@query(f"WITH {_FIGS} SELECT fiscal_year, reducer, level, round(quantile_cont(value, [.5, .9, .95, .99])[i], 6) AS value, round(avg(value), 6) AS mean FROM figs, {_LEVELS} GROUP BY fiscal_year, reducer, level, i")
def srv_fy_summary(spark, sf_dir):
    return srv.fy_summary(srv.path_figures(_paths(spark, sf_dir), ["annual_max", "p95_of_daily_peaks"]))


@query(f"WITH {_PATHS} SELECT business_date, level, round(quantile_cont(daily_peak, [.5, .9, .95, .99])[i], 6) AS value, round(avg(daily_peak), 6) AS mean FROM paths, {_LEVELS} GROUP BY business_date, level, i")
def srv_daily_profile(spark, sf_dir):
    return srv.daily_profile(_paths(spark, sf_dir))


@query(f"WITH {P3}, m AS (SELECT fiscal_year::BIGINT AS path_id, app_id, max(mips) AS peak FROM p3 GROUP BY ALL) SELECT app_id, level, round(quantile_cont(peak, [.5, .9, .95, .99])[i], 6) AS value, round(avg(peak), 6) AS mean, true AS do_not_sum FROM m, {_LEVELS} GROUP BY app_id, level, i")
def srv_app_peaks(spark, sf_dir):
    return srv.app_peaks(panels.thirds(spark, sf_dir).groupBy(F.col("fiscal_year").cast("long").alias("path_id"), "app_id").agg(F.max("mips").alias("peak")))


@query(f"""WITH {_FIGS}, a AS (SELECT fiscal_year, reducer, median(value) AS p50, quantile_cont(value, .95) AS p95 FROM figs GROUP BY ALL),
w AS (SELECT NULL::INT AS fiscal_year, 'annual_max' AS reducer, median(v) AS p50, quantile_cont(v, .95) AS p95 FROM (SELECT max(daily_peak) AS v FROM paths GROUP BY path_id)),
x AS (SELECT NULL::INT AS fiscal_year, 'p95_of_daily_peaks' AS reducer, median(v) AS p50, quantile_cont(v, .95) AS p95 FROM (SELECT quantile_cont(daily_peak, .95) AS v FROM paths GROUP BY path_id)),
y AS (SELECT * FROM a UNION ALL SELECT * FROM w UNION ALL SELECT * FROM x)
SELECT fiscal_year, reducer, round(p50, 6) AS base_p50, round(p95, 6) AS base_p95, round(p50 * 1.2, 6) AS other_p50, round(p95 * 1.2, 6) AS other_p95, round(100 * (p50 * 1.2 / p50 - 1), 6) AS delta_p50_pct, round(100 * (p95 * 1.2 / p95 - 1), 6) AS delta_p95_pct FROM y""")
def scn_compare(spark, sf_dir):
    base = srv.path_figures(_paths(spark, sf_dir), ["annual_max", "p95_of_daily_peaks"])
    return srv.compare(base, base.withColumn("value", F.col("value") * 1.2))


_HOR = f"""{_RES}, n AS (SELECT count(*) AS n FROM good), dr AS (SELECT p AS path_id, CAST(d AS INT) AS day_idx, (p * 1103515245 + d * 12345 + 20260101) % n AS pool_idx FROM range(40) a(p), range(30) b(d), n),
hx AS (SELECT path_id, day_idx, app_id, interval_idx, greatest(0, med * (1 + .01 * day_idx) + r * half) AS x FROM dr JOIN good USING (pool_idx) JOIN res USING (business_date)),
hs AS (SELECT path_id, day_idx, interval_idx, sum(x) AS s FROM hx GROUP BY ALL),
hw AS (SELECT *, avg(s) OVER o AS a, count(*) OVER o AS c FROM hs WINDOW o AS (PARTITION BY path_id ORDER BY day_idx, interval_idx ROWS 3 PRECEDING)),
hd AS (SELECT path_id, day_idx, max(s) AS peak, avg(s) AS mean, coalesce(max(a) FILTER (c = 4), 0) AS r4ha FROM hw GROUP BY ALL),
ha AS (SELECT path_id, day_idx, app_id, max(x) AS m FROM hx GROUP BY ALL), hp AS (SELECT path_id, day_idx, sum(m) AS sum_app_peaks FROM ha GROUP BY ALL),
hr AS (SELECT path_id, day_idx, sum(r) AS sum_app_r4ha FROM (SELECT path_id, day_idx, app_id, coalesce(max(a) FILTER (c = 4), 0) AS r FROM (SELECT *, avg(x) OVER o AS a, count(*) OVER o AS c FROM hx
  WINDOW o AS (PARTITION BY path_id, app_id ORDER BY day_idx, interval_idx ROWS 3 PRECEDING)) GROUP BY ALL) GROUP BY ALL),
h AS (SELECT * FROM hd JOIN hp USING (path_id, day_idx) JOIN hr USING (path_id, day_idx))"""


def _horizon(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Draws of 40 paths of 30 days, the cells they need, and the paths' days: a forecast that grows 1 % of the first day a day."""
    res, fit = _residuals(spark, sf_dir)
    pooled = sim.pool(res)
    n = (pooled.agg(F.max("pool_idx")).first()[0] or 0) + 1
    drawn = sim.draws(spark, 40, 30, (F.col("path_id") * 1103515245 + F.col("day_idx") * 12345 + 20260101) % F.lit(n))
    days = F.explode(F.sequence(F.lit(0), F.lit(29))).alias("day_idx")
    forecast = fit.select("app_id", "interval_idx", "med", "half", days).withColumn("med", F.col("med") * (1 + F.lit(0.01) * F.col("day_idx")))
    cells = hor.cells(drawn, pooled, forecast)
    return drawn, cells, hor.daily(drawn, hor.totals(cells, 3))


def _horizon_rolled(spark, sf_dir) -> DataFrame:
    drawn, cells, daily = _horizon(spark, sf_dir)
    return hor.rolling(daily, ["path_id"], "total", 4, 3).join(hor.sum_app_r4ha(drawn, cells, 4, 3), ["path_id", "day_idx"]).drop("total")


@query(f"WITH {_HOR} SELECT path_id, day_idx, {_r('peak', 'mean', 'r4ha', 'sum_app_peaks', 'sum_app_r4ha')} FROM h")
def sim_horizon(spark, sf_dir):
    return _horizon_rolled(spark, sf_dir)


@query(f"WITH {_HOR} SELECT path_id, app_id, round(max(m), 6) AS peak FROM ha GROUP BY ALL")
def sim_app_peaks(spark, sf_dir):
    drawn, cells, _ = _horizon(spark, sf_dir)
    return hor.app_peaks(drawn, cells)


@query(f"""WITH {_HOR}, e AS (SELECT avg(peak / sum_app_peaks) AS daily_mean, quantile_cont(peak / sum_app_peaks, .05) AS daily_p05, quantile_cont(peak / sum_app_peaks, .95) AS daily_p95 FROM h),
w AS (SELECT avg(most / apps) AS horizon_mean, avg(most) AS mean_peak_of_sum, avg(apps) AS mean_sum_of_app_peaks FROM (SELECT path_id, max(peak) AS most FROM h GROUP BY 1)
  JOIN (SELECT path_id, sum(m) AS apps FROM (SELECT path_id, app_id, max(m) AS m FROM ha GROUP BY ALL) GROUP BY 1) USING (path_id))
SELECT {_r('daily_mean', 'daily_p05', 'daily_p95', 'horizon_mean', 'mean_peak_of_sum', 'mean_sum_of_app_peaks')} FROM e, w""")
def sim_coincidence(spark, sf_dir):
    drawn, cells, daily = _horizon(spark, sf_dir)
    return hor.coincidence(daily, hor.app_peaks(drawn, cells))


@query(f"""WITH {_HOR} SELECT round(avg(peak / sum_app_peaks), 6) AS interval_peak, round(avg(r4ha / greatest(sum_app_r4ha, 1e-9)), 6) AS r4ha, round(avg(r4ha / peak), 6) AS r4ha_to_peak,
  round(avg(r4ha / greatest(sum_app_r4ha, 1e-9)) - avg(peak / sum_app_peaks), 6) AS gain FROM h""")
def sim_coincidence_by_target(spark, sf_dir):
    return hor.coincidence_by_target(_horizon_rolled(spark, sf_dir))


@query(f"WITH {_HOR} SELECT path_id, count(*) FILTER (s > c) AS intervals_above_p99 FROM hs JOIN (SELECT path_id, quantile_cont(s, .99) AS c FROM hs GROUP BY 1) USING (path_id) GROUP BY ALL")
def red_above_p99(spark, sf_dir):
    return hor.above_p99(_horizon(spark, sf_dir)[2], ["path_id"])


@query(f"""WITH {_HOR}, d AS (SELECT *, DATE '2026-01-01' + day_idx AS business_date FROM h), x AS (SELECT *, max(r4ha) OVER m AS mr, row_number() OVER (PARTITION BY path_id, year(business_date), month(business_date) ORDER BY business_date) = 1 AS mf
  FROM d WINDOW m AS (PARTITION BY path_id, year(business_date), month(business_date)))
SELECT path_id, round(avg(mr) FILTER (mf), 6) AS monthly_peak_r4ha, round(max(r4ha), 6) AS annual_peak_r4ha, round(quantile_cont(r4ha, .95), 6) AS p95_of_daily_r4ha, round(avg(r4ha), 6) AS mean_of_daily_r4ha FROM x GROUP BY ALL""")
def red_r4ha(spark, sf_dir):
    day = F.date_add(F.lit("2026-01-01").cast("date"), F.col("day_idx"))
    daily = _horizon_rolled(spark, sf_dir).select("path_id", day.alias("business_date"), F.col("peak").alias("daily_peak"), F.col("mean").alias("daily_mean"), F.col("r4ha").alias("daily_r4ha"))
    return mod.reduced(daily, ["path_id"], mod.FAMILIES["software_cost"])


@query()
def sim_with_factor(spark, sf_dir):
    """Daily figures scaled by drawn coincidence factors; SQL has no such hash."""
    rows = panels.thirds(spark, sf_dir)
    days = rows.groupBy("business_date").agg(F.sum("mips").alias("peak")).withColumn("dow", F.weekday("business_date"))
    daily = days.select(F.xxhash64("dow").alias("path_id"), F.datediff("business_date", F.lit("1992-01-01").cast("date")).alias("day_idx"), "dow", "peak", F.col("peak").alias("mean"), F.array("peak").alias("total"))
    return hor.with_factor(daily, sim.factor(rows), 1).drop("total")


@query()
def eva_backtest(spark, sf_dir):
    """Two folds of the simulation against what came; draws are hashes."""
    return bat.backtest(panels.thirds(spark, sf_dir), 60, folds=2, paths=200, per_day=3)


@query()
def src_synthetic(spark, sf_dir):
    """The generator's panel per app and fiscal year; it reads no table."""
    rows = synthetic.generate(spark, synthetic.Spec(apps=8))["intervals"]
    return rows.groupBy("app_id", "fiscal_year").agg(F.count("*").alias("n"), F.max("mips").alias("peak"), F.count_if("is_anomaly").alias("n_anomalies"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
