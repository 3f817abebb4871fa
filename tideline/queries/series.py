"""Cleaning, daily derivations, features, windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions import features as ft
from tideline.functions import scalers
from tideline.operators import clean, gaps, merge, windows
from tideline.operators import daily as dl
from tideline.operators.days import normalize_dst, with_local
from tideline.plans import jobs
from tideline.registry import DAILY, HOURLY, THIN, TYPES, WIDE, daily, hourly, query, table, wide
from tideline.specs import PivotSpec, WindowSpec

V5 = "view:d, click:d, purchase:d, signup:d, error:d"


def thin(spark, sf):
    return wide(spark, sf, thin=True)


# ---- cleaning ----


@query("ts:t, view:d, click:d", f"WITH {THIN} SELECT ts, coalesce(view, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN 0.0 END) AS view, coalesce(click, CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 0.0 END) AS click FROM thin")
def D01_zero_by_time(spark, sf):
    df = clean.fill_zero(thin(spark, sf), ["view"], F.col("ts") >= F.lit("2024-01-20").cast("timestamp"))
    return clean.fill_zero(df, ["click"], F.col("ts") < F.lit("2024-01-10").cast("timestamp"))


CUT = f"{THIN}, cut AS (SELECT ts, CASE WHEN ts < TIMESTAMP '2024-01-25' THEN view END AS view, CASE WHEN ts > TIMESTAMP '2024-01-05' THEN click END AS click, error FROM thin)"


def _cut(spark, sf):
    at = lambda s: F.lit(s).cast("timestamp")
    return thin(spark, sf).select("ts", F.when(F.col("ts") < at("2024-01-25"), F.col("view")).alias("view"), F.when(F.col("ts") > at("2024-01-05"), F.col("click")).alias("click"), "error")


@query("ts:t, view:d, click:d", f"WITH {CUT} SELECT ts, CASE WHEN view IS NULL AND ts > (SELECT max(ts) FILTER (view IS NOT NULL) FROM cut) THEN 0.0 ELSE view END AS view, CASE WHEN click IS NULL AND ts < (SELECT min(ts) FILTER (click IS NOT NULL) FROM cut) THEN 0.0 ELSE click END AS click FROM cut")
def D02_zero_outside(spark, sf):
    return clean.fill_zero_outside(clean.fill_zero_outside(_cut(spark, sf), ["view"], "after"), ["click"], "before")


@query("ts:t, view:d", f"WITH {THIN} SELECT ts, coalesce(view, click - error) AS view FROM thin")
def D03_fill_difference(spark, sf):
    return clean.fill_difference(thin(spark, sf), "view", "click", "error")


@query("ts:t, view:d", f"WITH {THIN} SELECT ts, coalesce(view, click) AS view FROM thin")
def D04_fill_from(spark, sf):
    return clean.fill_from(thin(spark, sf), "view", "click")


TOTAL_SQL = "coalesce(view, click + purchase, CASE WHEN (ts >= (SELECT max(ts) FROM thin) - INTERVAL 5 DAY OR click IS NOT NULL OR purchase IS NOT NULL) AND (signup IS NOT NULL OR error IS NOT NULL) THEN coalesce(signup, 0) + coalesce(error, 0) END)"


@query("ts:t, view:d", f"WITH {THIN} SELECT ts, {TOTAL_SQL} AS view FROM thin")
def D05_fill_total(spark, sf):
    return clean.fill_total(thin(spark, sf), "view", ["click", "purchase"], ["signup", "error"], recent_days=5)


@query("ts:t, net:d", f"WITH {THIN} SELECT ts, CASE WHEN coalesce(view, click, purchase, signup) IS NOT NULL THEN coalesce(view, 0) + coalesce(click, 0) - coalesce(purchase, 0) - coalesce(signup, 0) END AS net FROM thin")
def D06_net_export(spark, sf):
    return clean.net_export(thin(spark, sf), "net", ["view", "click"], ["purchase", "signup"])


@query("ts:t, view:d, click:d")
def D07_spline(spark, sf):
    return gaps.interpolate_gaps(thin(spark, sf).select("ts", "view", "click"), ["view", "click"], 5)


RULES = [("zero_after_last", ["purchase"]), ("zero_from", ["signup"], "2024-01-25"), ("zero_until", ["signup"], "2024-01-05"), ("zero_before_first", ["error"]), ("difference", "click", "view", "error"), ("copy", "view", "click"), ("total", "purchase", ["click", "error"], ["view", "signup"]), ("net", "net", ["view", "click"], ["signup", "error"])]


@query(f"ts:t, {V5}, net:d")
def D08_composite(spark, sf):
    return jobs.handle_missing(thin(spark, sf), RULES, max_gap=5, not_interpolated=["net"])


@query(f"ts:t, {V5}, net:d", f"""WITH {THIN}, edge AS (SELECT max(ts) FILTER (purchase IS NOT NULL) AS last_p, min(ts) FILTER (error IS NOT NULL) AS first_e, max(ts) AS last_ts FROM thin),
 a AS (SELECT ts, view, click, CASE WHEN purchase IS NULL AND ts > last_p THEN 0.0 ELSE purchase END AS purchase, CASE WHEN signup IS NULL AND (ts >= TIMESTAMP '2024-01-25' OR ts < TIMESTAMP '2024-01-05') THEN 0.0 ELSE signup END AS signup, CASE WHEN error IS NULL AND ts < first_e THEN 0.0 ELSE error END AS error, last_ts FROM thin, edge),
 b AS (SELECT * REPLACE (coalesce(click, view - error) AS click) FROM a), c AS (SELECT * REPLACE (coalesce(view, click) AS view) FROM b),
 d AS (SELECT * REPLACE (coalesce(purchase, click + error, CASE WHEN (ts >= last_ts - INTERVAL 30 DAY OR coalesce(click, error) IS NOT NULL) AND coalesce(view, signup) IS NOT NULL THEN coalesce(view, 0) + coalesce(signup, 0) END) AS purchase) FROM c)
 SELECT ts, view, click, purchase, signup, error, CASE WHEN coalesce(view, click, signup, error) IS NOT NULL THEN coalesce(view, 0) + coalesce(click, 0) - coalesce(signup, 0) - coalesce(error, 0) END AS net FROM d""")
def D08_rules(spark, sf):
    """The composite without its splines."""
    return jobs.handle_missing(thin(spark, sf), RULES, max_gap=0)


#: The hourly series moved over both clock changes of 2024.
DST = f"""{HOURLY}, grid AS (SELECT event_type AS k, ts + to_days(d) AS ts, value AS v FROM hourly, (VALUES (65), (280)) m(d)),
 loc AS (SELECT k, ts + CASE WHEN ts >= TIMESTAMP '2024-03-31 01:00:00' AND ts < TIMESTAMP '2024-10-27 01:00:00' THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS l, v FROM grid)"""


@query("k:s, local_date:D, slot:i, v:d", f"""WITH {DST}, g AS (SELECT k, CAST(l AS DATE) AS local_date, date_part('hour', l) AS slot, avg(v) AS v FROM loc GROUP BY ALL)
 SELECT * FROM g UNION ALL SELECT k, DATE '2024-03-31', 2, avg(v) FROM g WHERE local_date = DATE '2024-03-31' AND slot IN (1, 3) GROUP BY k""")
def D09_dst(spark, sf):
    h = hourly(spark, sf).select(F.col("event_type").alias("k"), F.explode(F.array(F.lit(65), F.lit(280))).alias("d"), "ts", F.col("value").alias("v"))
    return normalize_dst(h.withColumn("ts", F.col("ts") + F.make_dt_interval("d")).drop("d"), ["v"], ["k"])


@query("ts:t, view:d, error:d", f"""WITH {CUT} SELECT ts, CASE WHEN ts <= (SELECT max(ts) FILTER (view IS NOT NULL) FROM cut) THEN last_value(view IGNORE NULLS) OVER w END AS view, CASE WHEN ts <= (SELECT max(ts) FILTER (error IS NOT NULL) FROM cut) THEN last_value(error IGNORE NULLS) OVER w END AS error
 FROM cut WINDOW w AS (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def D10_ffill_inside(spark, sf):
    return gaps.ffill(_cut(spark, sf), ["view", "error"], block="day", inside=True)


@query("ts:t, view:d", f"WITH {THIN} SELECT ts, last_value(view IGNORE NULLS) OVER (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS view FROM thin")
def D11_ffill(spark, sf):
    return gaps.ffill(thin(spark, sf), ["view"], block="week")


@query("ts:t, view:d, click:d", f"WITH {THIN}, m AS (SELECT median(view) AS mv, median(click) AS mc FROM thin WHERE ts < TIMESTAMP '2024-01-20') SELECT ts, coalesce(view, mv) AS view, coalesce(click, mc) AS click FROM thin, m WHERE ts >= TIMESTAMP '2024-01-20'")
def D12_median_impute(spark, sf):
    t, cut = thin(spark, sf), F.lit("2024-01-20").cast("timestamp")
    return clean.median_impute(t.where(F.col("ts") < cut), t.where(F.col("ts") >= cut), ["view", "click"])


@query("name:s, low:d, high:d, n_out:i, smallest:d, largest:d", f"WITH {WIDE} " + " UNION ALL ".join(f"SELECT '{t}' AS name, 5.0 AS low, 60.0 AS high, count(*) FILTER ({t} < 5 OR {t} > 60) AS n_out, min({t}) AS smallest, max({t}) AS largest FROM wide" for t in ("view", "click")))
def D13_range_check(spark, sf):
    return clean.range_check(wide(spark, sf), {"view": (5.0, 60.0), "click": (5.0, 60.0)})


@query("ts:t, holiday_score:d", f"WITH {WIDE} SELECT ts, CASE WHEN CAST(ts + INTERVAL 1 HOUR AS DATE) = DATE '2024-01-01' THEN 1.0 WHEN CAST(ts + INTERVAL 1 HOUR AS DATE) = DATE '2024-01-06' THEN (11.1 + 13.2 + 2.2) / (17.9 + 13.2 + 11.1 + 8.0 + 6.3 + 4.1 + 4.1 + 3.7 + 2.9 + 2.5 + 2.2 + 2.1 + 1.9 + 1.6 + 1.0 + 0.7) ELSE 0.0 END AS holiday_score FROM wide")
def D14_holidays(spark, sf):
    return ft.with_holidays(wide(spark, sf))


# ---- daily derivations ----

MONTHLY = f"{DAILY}, monthly AS (SELECT k, date_trunc('month', date)::DATE AS date, avg(price) AS value FROM daily GROUP BY ALL), filled AS (SELECT k, value, date, lead(date) OVER (PARTITION BY k ORDER BY date) AS nxt FROM monthly), days AS (SELECT k, CAST(d AS DATE) AS date, value FROM (SELECT k, value, unnest(generate_series(date, coalesce(nxt - 1, date), INTERVAL 1 DAY)) AS d FROM filled))"


def monthly(spark, sf):
    return daily(spark, sf).groupBy("k", F.trunc("date", "month").alias("date")).agg(F.avg("price").alias("value"))


def fine(spark, sf, flag="A"):
    return table(spark, sf, "lineitem").where(F.col("l_returnflag") == flag).groupBy(F.to_date("l_shipdate").alias("date")).agg(F.avg("l_extendedprice").alias("value"))


FINE = "fine AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_extendedprice) AS value FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL)"
RATES = "rates AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_quantity) AS rate FROM lineitem WHERE l_linenumber = 7 AND date_part('day', l_shipdate) < 20 GROUP BY ALL)"


def rates(spark, sf):
    return table(spark, sf, "lineitem").where("l_linenumber = 7 AND day(l_shipdate) < 20").groupBy(F.to_date("l_shipdate").alias("date")).agg(F.avg("l_quantity").alias("rate"))


@query("k:s, date:D, value:d", f"WITH {MONTHLY} SELECT * FROM days")
def E01_monthly_to_daily(spark, sf):
    return dl.monthly_to_daily(monthly(spark, sf), ["k"])


@query("date:D, value:d", f"WITH {FINE}, {RATES} SELECT f.date, f.value / nullif(r.rate, 0) * 2.5 AS value FROM fine f ASOF LEFT JOIN rates r ON f.date >= r.date")
def E02_convert(spark, sf):
    return dl.convert(fine(spark, sf), rates(spark, sf), factor=2.5)


def _for_each(df):
    """A series without a key stands for every key: a row of it for each."""
    return df.withColumn("k", F.explode(F.array(*map(F.lit, ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")))))


def _direct(spark, sf):
    return daily(spark, sf).where("date >= DATE '1999-01-01'").withColumnRenamed("price", "value")


DIRECT = "direct AS (SELECT k, date, price AS value FROM daily WHERE date >= DATE '1999-01-01')"
KEYS = "ks AS (SELECT DISTINCT k FROM daily)"


@query("k:s, bias:d, corr:d, n:i", f"WITH {DAILY}, {FINE} SELECT k, coalesce(avg(price - value), 0) AS bias, corr(price, value) AS corr, count(*) AS n FROM daily JOIN fine USING (date) WHERE date >= DATE '1998-01-01' GROUP BY k")
def E03_bias(spark, sf):
    return dl.bias(daily(spark, sf).withColumnRenamed("price", "value"), _for_each(fine(spark, sf)), ["k"], since="1998-01-01")


@query("k:s, date:D, price:d", f"WITH {DAILY} SELECT k, date, price - avg(price) OVER (PARTITION BY k, date_trunc('month', date)) AS price FROM daily")
def E04_centre_by_month(spark, sf):
    return dl.centre_by_month(daily(spark, sf), ["k"], value="price")


VARIED = f"{MONTHLY}, {FINE}, {KEYS}, var_ AS (SELECT date, value - avg(value) OVER (PARTITION BY date_trunc('month', date)) AS v FROM fine), dates AS (SELECT k, date FROM days UNION SELECT k, date FROM var_, ks), summed AS (SELECT d.k, d.date, b.value + coalesce(v.v, 0) AS value FROM dates d ASOF LEFT JOIN days b ON d.k = b.k AND d.date >= b.date LEFT JOIN var_ v ON d.date = v.date)"


@query("k:s, date:D, value:d", f"WITH {VARIED} SELECT * FROM summed")
def E05_baseline_variation(spark, sf):
    base = dl.monthly_to_daily(monthly(spark, sf), ["k"])
    return dl.baseline_plus_variation(base, _for_each(dl.centre_by_month(fine(spark, sf))), ["k"])


@query("k:s, date:D, value:d", f"WITH {DAILY}, {FINE}, {DIRECT}, firsts AS (SELECT k, min(date) AS first_ FROM direct GROUP BY k) SELECT k, date, value FROM fine, firsts WHERE date < first_ UNION ALL SELECT * FROM direct")
def E06_splice(spark, sf):
    return dl.splice(_for_each(fine(spark, sf)), _direct(spark, sf), ["k"])


@query("k:s, date:D, value:d", f"""WITH {MONTHLY}, {FINE}, {RATES}, {DIRECT}, {KEYS},
 lev AS (SELECT d.k, d.date, d.value / nullif(r.rate, 0) AS value FROM days d ASOF LEFT JOIN rates r ON d.date >= r.date),
 b AS (SELECT k, coalesce(avg(direct.value - lev.value), 0) AS bias FROM direct JOIN lev USING (k, date) GROUP BY k), cor AS (SELECT k, date, value + coalesce(bias, 0) AS value FROM lev LEFT JOIN b USING (k)),
 fx AS (SELECT f.date, f.value / nullif(r.rate, 0) AS value FROM fine f ASOF LEFT JOIN rates r ON f.date >= r.date), va AS (SELECT date, value - avg(value) OVER (PARTITION BY date_trunc('month', date)) AS v FROM fx),
 ds AS (SELECT k, date FROM cor UNION SELECT k, date FROM va, ks), rec AS (SELECT ds.k, ds.date, c.value + coalesce(v.v, 0) AS value FROM ds ASOF LEFT JOIN cor c ON ds.k = c.k AND ds.date >= c.date LEFT JOIN va v ON v.date = ds.date),
 firsts AS (SELECT k, min(date) AS first_ FROM direct GROUP BY k) SELECT k, date, value FROM rec LEFT JOIN firsts USING (k) WHERE first_ IS NULL OR date < first_ UNION ALL SELECT * FROM direct""")
def E07_reconstruct(spark, sf):
    return dl.reconstruct_gap(monthly(spark, sf), _for_each(fine(spark, sf)), _for_each(rates(spark, sf)), _direct(spark, sf), ["k"])


PAIR = f"{DAILY}, {FINE}, {KEYS}, pair AS (SELECT k, date, price AS a, value AS b FROM (SELECT k, date, price FROM daily WHERE date >= DATE '1997-01-01') FULL JOIN (SELECT k, date, value FROM fine, ks WHERE date < DATE '2000-01-01') USING (k, date))"


def _pair(spark, sf):
    a = daily(spark, sf).where("date >= DATE '1997-01-01'").withColumnRenamed("price", "a")
    return merge.outer_join_daily([a, _for_each(fine(spark, sf).where("date < DATE '2000-01-01'")).withColumnRenamed("value", "b")], ["k", "date"])


UNIFIED = f"{PAIR}, un AS (SELECT k, date, coalesce(a, b + coalesce(avg(a - b) OVER (PARTITION BY k), 0)) AS u, b FROM pair)"


@query("k:s, date:D, u:d", f"WITH {UNIFIED} SELECT k, date, u FROM un")
def E08_unify(spark, sf):
    return dl.unify(_pair(spark, sf), "a", "b", "u", ["k"])


INSIDE = lambda x: f"CASE WHEN date <= max(date) FILTER ({x} IS NOT NULL) OVER (PARTITION BY k) THEN last_value({x} IGNORE NULLS) OVER (PARTITION BY k ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS {x}"


@query("k:s, date:D, u:d, b:d, none:d", f"WITH {UNIFIED} SELECT k, date, {INSIDE('u')}, {INSIDE('b')}, NULL AS none FROM un")
def E09_daily_table(spark, sf):
    return dl.commodity_table({"p": _pair(spark, sf)}, ["u", "b", "none"], {"u": ("a", "b")}, ["k"])


@query("o_orderkey:i, u:d", f"WITH {UNIFIED}, f AS (SELECT * FROM (SELECT k, date, {INSIDE('u')} FROM un) WHERE date < DATE '2001-06-01') SELECT o_orderkey, f.u FROM orders o ASOF LEFT JOIN f ON f.k = o.o_orderpriority AND CAST(o.o_orderdate AS DATE) >= f.date")
def E10_commodity_job(spark, sf):
    t = dl.commodity_table({"p": _pair(spark, sf)}, ["u"], {"u": ("a", "b")}, ["k"])
    return merge.asof(table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("k"), F.col("o_orderdate").alias("ts")), t, ["u"], ["k"], before="2001-06-01")


# ---- features ----


@query("ts:t, spread_click:d, spread_error:d", f"WITH {WIDE} SELECT ts, view - click AS spread_click, view - error AS spread_error FROM wide")
def F01_spreads(spark, sf):
    return ft.spreads(wide(spark, sf), "view", ["click", "error", "absent"])


@query("ts:t, ratio_click:d", f"WITH {WIDE} SELECT ts, view / nullif(click, 0) AS ratio_click FROM wide")
def F02_ratios(spark, sf):
    return ft.ratios(wide(spark, sf), "view", ["click"], drop=True)


@query("ts:t, net_export_a:d, net_export_b:d, net_export_c:d", f"WITH {WIDE} SELECT ts, view - click AS net_export_a, purchase AS net_export_b, -error AS net_export_c FROM wide")
def F03_net_exports(spark, sf):
    return ft.net_exports(wide(spark, sf), [("view", "click", "a"), ("purchase", "x", "b"), ("x", "error", "c"), ("x", "y", "d")])


SHARE = "CASE WHEN coalesce(view, click, purchase) IS NOT NULL THEN coalesce(view, 0) + coalesce(click, 0) + coalesce(purchase, 0) END"


@query("ts:t, total_generation:d, view_pct:d, renewable_pct:d, supply_demand_gap:d", f"WITH {THIN} SELECT ts, {SHARE} AS total_generation, view / nullif({SHARE}, 0) AS view_pct, CASE WHEN coalesce(view, click) IS NOT NULL THEN coalesce(view, 0) + coalesce(click, 0) END / nullif({SHARE}, 0) AS renewable_pct, {SHARE} - error AS supply_demand_gap FROM thin")
def F04_generation_shares(spark, sf):
    return ft.generation_shares(thin(spark, sf), ["view", "click", "purchase"], ["view", "click"], "error")


@query("ts:t, click_pct:d, signup_pct:d", f"WITH {WIDE} SELECT ts, click / nullif(view, 0) AS click_pct, signup / nullif(view, 0) AS signup_pct FROM wide")
def F05_forecast_shares(spark, sf):
    return ft.forecast_shares(wide(spark, sf), "view", ["click", "signup"])


@query("ts:t, hour:i, day_of_week:i, day_of_month:i, month:i, week_of_year:i, is_weekend:i, hour_sin:d, day_of_week_cos:d, month_sin:d", f"""WITH {WIDE}, l AS (SELECT ts, ts + INTERVAL 1 HOUR AS t FROM wide) SELECT ts, date_part('hour', t) AS hour, date_part('isodow', t) - 1 AS day_of_week, date_part('day', t) AS day_of_month, date_part('month', t) AS month, date_part('week', t) AS week_of_year,
 CAST(date_part('isodow', t) >= 6 AS INT) AS is_weekend, sin(2 * pi() * date_part('hour', t) / 24) AS hour_sin, cos(2 * pi() * (date_part('isodow', t) - 1) / 7) AS day_of_week_cos, sin(2 * pi() * (date_part('month', t) - 1) / 12) AS month_sin FROM l""")
def F06_calendar(spark, sf):
    return ft.calendar(wide(spark, sf))


@query("ts:t, total_exports:d, total_imports:d", f"WITH {THIN} SELECT ts, CASE WHEN coalesce(view, click) IS NOT NULL THEN coalesce(view, 0) + coalesce(click, 0) END AS total_exports, CASE WHEN coalesce(signup, error) IS NOT NULL THEN coalesce(signup, 0) + coalesce(error, 0) END AS total_imports FROM thin")
def F08_total_flows(spark, sf):
    return ft.total_flows(thin(spark, sf), ["view", "click"], ["signup", "error"])


LOCAL = f"{WIDE}, loc AS (SELECT *, CAST(ts + INTERVAL 1 HOUR AS DATE) AS d, date_part('hour', ts + INTERVAL 1 HOUR) AS slot FROM wide)"


@query("ts:t, range_7d:d", f"WITH {LOCAL}, days AS (SELECT d, max(view) AS hi, min(view) AS lo FROM loc GROUP BY d), s AS (SELECT a.d, max(b.hi) - min(b.lo) AS r FROM days a LEFT JOIN days b ON b.d BETWEEN a.d - 7 AND a.d - 1 GROUP BY a.d) SELECT ts, r AS range_7d FROM loc JOIN s USING (d)")
def F09_ranges(spark, sf):
    w = windows.rolling(wide(spark, sf), ["view"], [WindowSpec(-7, -1, ("max", "min"))])
    return ft.ranges(w, {"range_7d": ("view_d7_d1_max", "view_d7_d1_min")})


@query("ts:t, day_index:i, year_index:i, view_x_day:d", f"WITH {LOCAL} SELECT ts, d - DATE '2015-01-05' AS day_index, date_part('year', d) - 2015 AS year_index, view * (d - DATE '2015-01-05') AS view_x_day FROM loc")
def F10_interactions(spark, sf):
    return ft.day_interactions(wide(spark, sf), ["view"])


@query("ts:t, view:d, click:d", f"WITH {WIDE}, s AS (SELECT abs(least(min(view), min(click))) + 1 AS s FROM wide) SELECT ts, ln(view + s) AS view, ln(click + s) AS click FROM wide, s")
def F11_log_shift(spark, sf):
    w = wide(spark, sf)
    return scalers.LogShift(["view", "click"]).fit(w).transform(w)


@query("ts:t, view:d, back:d")
def F12_yeo_johnson(spark, sf):
    w = wide(spark, sf).select("ts", "view")
    m = scalers.YeoJohnson(["view"]).fit(w)
    scaled = m.transform(w)
    return scaled.join(m.inverse(scaled).select("ts", F.col("view").alias("back")), "ts")


@query("ts:t, view:d, back:d", f"WITH {WIDE} SELECT ts, (CASE WHEN view >= 0 THEN (pow(view + 1, 0.5) - 1) / 0.5 ELSE (1 - pow(1 - view, 1.5)) / 1.5 END - 10) / 4 AS view, view AS back FROM wide")
def F12_stored_parameters(spark, sf):
    w = wide(spark, sf).select("ts", "view")
    m = scalers.YeoJohnson(["view"], {"view": (0.5, 10.0, 4.0)})
    return m.inverse(m.transform(w).withColumn("scaled", F.col("view"))).select("ts", F.col("scaled").alias("view"), F.col("view").alias("back"))


@query("ts:t, view:d, back:d")
def F13_quantile_normal(spark, sf):
    w = wide(spark, sf).select("ts", "view")
    m = scalers.QuantileNormal(["view"], 100).fit(w)
    scaled = m.transform(w)
    return scaled.join(m.inverse(scaled).select("ts", F.col("view").alias("back")), "ts")


@query("ts:t, view:d, view_raw:d", f"WITH {WIDE} SELECT ts, view, view AS view_raw FROM wide")
def F14_no_op(spark, sf):
    return scalers.no_op(wide(spark, sf), ["view"])


@query("ts:t, weight:d", f"WITH {LOCAL}, i AS (SELECT ts, d - DATE '2015-01-05' AS day_index FROM loc) SELECT ts, exp(ln(2) / 10 * (day_index - (SELECT max(day_index) FROM i))) AS weight FROM i")
def F15_decay_weights(spark, sf):
    return ft.decay_weights(ft.day_interactions(wide(spark, sf), []), half_life=10)


@query("feature_group:s, total:d, n:i, mean:d", "SELECT CASE WHEN regexp_matches(p_name, '^(red|blue)') THEN 'primary' WHEN regexp_matches(p_name, 'ring|bolt') THEN 'metal' ELSE 'other' END AS feature_group, sum(p_retailprice) AS total, count(*) AS n, avg(p_retailprice) AS mean FROM part GROUP BY 1")
def F16_group_importance(spark, sf):
    return ft.group_importance(table(spark, sf, "part"), [("primary", "^(red|blue)"), ("metal", "ring|bolt")], "p_name", "p_retailprice")


@query("p_partkey:i, category:s", "SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'linear' WHEN 'SMALL' THEN 'tree' ELSE 'other' END AS category FROM part")
def F17_model_category(spark, sf):
    return ft.model_category(table(spark, sf, "part"), "p_type", {"ECONOMY": "linear", "SMALL": "tree"})


# ---- windows ----

KDAYS = f"{HOURLY}, loc AS (SELECT event_type AS k, ts, value AS v, CAST(ts + INTERVAL 1 HOUR AS DATE) AS d, date_part('hour', ts + INTERVAL 1 HOUR) AS slot FROM hourly)"


def keyed(spark, sf):
    return hourly(spark, sf).select(F.col("event_type").alias("k"), "ts", F.col("value").alias("v"))


@query("k:s, ts:t, v_d7_d1_mean:d, v_d7_d1_std:d, v_d7_d1_min:d, v_d7_d1_sum:d, v_d2_d1_h8-19_mean:d, v_d1_to10_mean:d, v_d3_d1_to10_max:d", f"""WITH {KDAYS}, ds AS (SELECT DISTINCT k, d FROM loc), s AS (SELECT ds.k, ds.d, avg(x.v) FILTER (x.d >= ds.d - 7) AS m, stddev_pop(x.v) AS sd, min(x.v) AS lo, coalesce(sum(x.v), 0) AS su,
 avg(x.v) FILTER (x.d >= ds.d - 2 AND x.slot BETWEEN 8 AND 19) AS m2, avg(x.v) FILTER (x.d = ds.d - 1 AND x.slot < 10) AS t10, max(x.v) FILTER (x.d >= ds.d - 3 AND (x.d < ds.d - 1 OR x.slot < 10)) AS x3
 FROM ds LEFT JOIN loc x ON x.k = ds.k AND x.d BETWEEN ds.d - 7 AND ds.d - 1 GROUP BY ALL)
 SELECT l.k, l.ts, m AS v_d7_d1_mean, sd AS v_d7_d1_std, lo AS v_d7_d1_min, su AS v_d7_d1_sum, m2 AS "v_d2_d1_h8-19_mean", t10 AS v_d1_to10_mean, x3 AS v_d3_d1_to10_max FROM loc l JOIN s ON l.k = s.k AND l.d = s.d""")
def G01_rolling(spark, sf):
    specs = [WindowSpec(-7, -1, ("mean", "std", "min", "sum")), WindowSpec(-2, -1, hours=tuple(range(8, 20))), WindowSpec(-1, -1, end_hour=10), WindowSpec(-3, -1, ("max",), end_hour=10)]
    return windows.rolling(keyed(spark, sf), ["v"], specs, ["k"])


@query("k:s, ts:t, v:d", f"WITH {KDAYS}, ds AS (SELECT k, d, avg(v) AS m FROM loc GROUP BY ALL) SELECT l.k, l.ts, ds.m AS v FROM loc l LEFT JOIN ds ON ds.k = l.k AND ds.d = l.d - 2")
def G02_overwrite(spark, sf):
    return windows.rolling(keyed(spark, sf), ["v"], [WindowSpec(-2, -2)], ["k"], overwrite=True)


EWMA = """grid AS (SELECT k, t AS ts, h.value AS x FROM (SELECT DISTINCT event_type AS k FROM events), range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 HOUR) r(t) LEFT JOIN hourly h ON h.event_type = k AND h.ts = t),
 num AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts) AS i FROM grid),
 e AS (SELECT k, ts, i, x AS w, CAST(1.0 AS DOUBLE) AS o FROM num WHERE i = 1 UNION ALL
  SELECT n.k, n.ts, n.i, CASE WHEN n.x IS NULL THEN e.w WHEN e.w IS NULL THEN n.x ELSE (e.o * (1 - a.a) * e.w + a.a * n.x) / (e.o * (1 - a.a) + a.a) END, CASE WHEN n.x IS NULL THEN e.o * (1 - a.a) ELSE 1.0 END FROM e JOIN num n ON n.k = e.k AND n.i = e.i + 1, (SELECT CAST(2.0 AS DOUBLE) / 7 AS a) a)"""


def gridded(spark, sf):
    k = keyed(spark, sf)
    grid = k.select("k").distinct().withColumn("ts", F.explode(F.expr("sequence(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)")))
    return grid.join(k, ["k", "ts"], "left")


@query("k:s, ts:t, ewma:d", f"WITH RECURSIVE {HOURLY}, {EWMA} SELECT k, ts, w AS ewma FROM e")
def G04_ewma(spark, sf):
    return windows.ewma(gridded(spark, sf), "v", 6, ["k"], block="week")


@query("k:s, ts:t, v_ewma_6_h10:d", f"WITH RECURSIVE {HOURLY}, {EWMA} SELECT n.k, n.ts, e.w AS v_ewma_6_h10 FROM num n LEFT JOIN e ON e.k = n.k AND e.ts + INTERVAL 1 HOUR = CAST(CAST(n.ts + INTERVAL 1 HOUR AS DATE) - 1 AS TIMESTAMP) + INTERVAL 9 HOUR")
def G04_ewma_cutoff(spark, sf):
    return windows.ewma_features(gridded(spark, sf), ["v"], [6], -1, 10, ["k"], suffix="_h10")


@query("k:s, ts:t, v_lag_1d:d, v_lag_7d:d", f"WITH {KDAYS} SELECT l.k, l.ts, a.v AS v_lag_1d, b.v AS v_lag_7d FROM loc l LEFT JOIN loc a ON a.k = l.k AND a.ts = l.ts - INTERVAL 1 DAY LEFT JOIN loc b ON b.k = l.k AND b.ts = l.ts - INTERVAL 7 DAY")
def G05_same_hour_lag(spark, sf):
    return windows.same_hour_lag(keyed(spark, sf), "v", [1, 7], ["k"])


@query("k:s, ts:t, v_lag_25h:d, v_lag_26h:d", f"WITH {KDAYS} SELECT l.k, l.ts, a.v AS v_lag_25h, b.v AS v_lag_26h FROM loc l LEFT JOIN loc a ON a.k = l.k AND a.ts = l.ts - INTERVAL 25 HOUR LEFT JOIN loc b ON b.k = l.k AND b.ts = l.ts - INTERVAL 26 HOUR")
def G06_hour_lag(spark, sf):
    return windows.hour_lag(keyed(spark, sf), "v", [25, 26], ["k"])


@query("k:s, ts:t, v_daily_sum:d, v_daily_std:d, v_daily_share:d", f"WITH {KDAYS} SELECT k, ts, coalesce(sum(v) OVER w, 0) AS v_daily_sum, stddev_samp(v) OVER w AS v_daily_std, v / nullif(sum(v) OVER w, 0) AS v_daily_share FROM loc WINDOW w AS (PARTITION BY k, d)")
def G07_daily_aggregates(spark, sf):
    return windows.daily_aggregates(keyed(spark, sf), ["v"], ["sum", "std"], ["k"])


@query("local_date:D, y_0:d, y_23:d, lag_5:d, click:d, error:d, purchase:d", f"""WITH {LOCAL}, dd AS (SELECT d, avg(view) FILTER (slot = 0) AS y_0, avg(view) FILTER (slot = 23) AS y_23, avg(signup) FILTER (slot = 5) AS l5, coalesce(sum(click), 0) AS click, arg_max(error, ts) FILTER (error IS NOT NULL) AS error, avg(purchase) AS purchase FROM loc GROUP BY d)
 SELECT a.d AS local_date, a.y_0, a.y_23, b.l5 AS lag_5, a.click, a.error, a.purchase FROM dd a LEFT JOIN dd b ON b.d = a.d - 1""")
def G08_daily_pivot(spark, sf):
    return windows.daily_pivot(wide(spark, sf), [PivotSpec("view", 0, "y"), PivotSpec("signup", -1, "lag")], [("cli*", "sum"), ("error", "last")])


@query("local_date:D, view:d, click:d, purchase:d, signup:d, error:d", f"WITH {LOCAL} SELECT d AS local_date, coalesce(sum(view), 0) AS view, arg_min(click, ts) FILTER (click IS NOT NULL) AS click, arg_max(purchase, ts) FILTER (purchase IS NOT NULL) AS purchase, max(signup) AS signup, avg(error) AS error FROM loc GROUP BY d")
def G09_aggregation_rules(spark, sf):
    return windows.daily_pivot(wide(spark, sf), [], [("view", "sum"), ("click", "first"), ("purchase", "last"), ("sign*", "max")])


@query("ts:t, run_length:i", f"WITH {THIN}, n AS (SELECT ts, view, count(view) OVER (ORDER BY ts) AS g FROM thin) SELECT ts, CASE WHEN view IS NULL THEN count(*) FILTER (view IS NULL) OVER (PARTITION BY g) ELSE 0 END AS run_length FROM n")
def G10_gap_runs(spark, sf):
    return gaps.gap_runs(thin(spark, sf), "view", block="day")


@query("name:s, last:t, middle:t", f"WITH {CUT}, l AS (SELECT max(ts) FILTER (view IS NOT NULL) AS view, max(ts) FILTER (click IS NOT NULL) AS click, max(ts) FILTER (error IS NOT NULL) AS error FROM cut), u AS (UNPIVOT l ON view, click, error INTO NAME name VALUE last) SELECT name, last, (SELECT median(last) FROM u) AS middle FROM u")
def G13_last_valid(spark, sf):
    cut = _cut(spark, sf)
    ends = merge.last_valid(cut, ["view", "click", "error"])
    cells = F.array(*[F.struct(F.lit(x).alias("name"), F.col(x).alias("last")) for x in ("view", "click", "error")])
    return ends.select(F.inline(cells)).join(F.broadcast(merge.reference_time(cut, []).withColumnRenamed("last_", "middle")))
