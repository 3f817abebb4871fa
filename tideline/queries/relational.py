"""Column algebra, reshaping, joins, unions, aggregates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.functions import features as ft
from tideline.operators import clean, days, merge, reshape
from tideline.plans.blends import apply_weights
from tideline.registry import DAILY, HOURLY, THIN, TYPES, WIDE, daily, hourly, query, table, wide

V5 = "view:d, click:d, purchase:d, signup:d, error:d"


@query("ts:t, view:d, click:d", f"WITH {WIDE} SELECT ts, view, click FROM wide")
def B02_drop_columns(spark, sf):
    return ft.drop_columns(wide(spark, sf), ["s*", "e*", "purchase", "view"], include=["view"])


@query("ts:t, y:d", f"WITH {WIDE} SELECT ts, view AS y FROM wide")
def B03_rename_target(spark, sf):
    return ft.rename_target(wide(spark, sf), "view")


@query("p_partkey:i, name:s", r"""SELECT p_partkey, lower(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(p_brand || ' / ' || p_name || ': <' || p_type || '>', ' ', '_'), '/', '_'), ':', '_'), '[<>"|?*]', '', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g')) AS name FROM part""")
def B04_clean_name(spark, sf):
    return table(spark, sf, "part").select("p_partkey", ft.clean_name(F.concat(F.col("p_brand"), F.lit(" / "), F.col("p_name"), F.lit(": <"), F.col("p_type"), F.lit(">"))).alias("name"))


@query("code:i, unique_name:s", "SELECT p_partkey AS code, CASE WHEN count(*) OVER (PARTITION BY p_name) > 1 THEN p_name || '_' || p_partkey ELSE p_name END AS unique_name FROM part")
def B05_unique_names(spark, sf):
    return reshape.name_columns(table(spark, sf, "part").select(F.col("p_partkey").alias("code"), F.col("p_name").alias("column_name")))


@query("n_nationkey:i, n_name:s", "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name LIKE 'A%') AND n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0)")
def B06_semi_anti(spark, sf):
    n, r, s = (table(spark, sf, x) for x in ("nation", "region", "supplier"))
    return n.join(r.where("r_name LIKE 'A%'"), n.n_regionkey == r.r_regionkey, "left_semi").join(s.where("s_acctbal < 0"), n.n_nationkey == s.s_nationkey, "left_anti")


@query("event_id:i, value:d", "SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'")
def B07_time_slice(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet").where("ts >= TIMESTAMP_NTZ '2024-01-10' AND ts < TIMESTAMP_NTZ '2024-01-12'")


@query("ts:t, regime_before_split:i, regime_quarter_hourly:i", f"WITH {WIDE} SELECT ts, CAST(ts < TIMESTAMP '2024-01-10' AS INT) AS regime_before_split, CAST(ts >= TIMESTAMP '2024-01-20' AS INT) AS regime_quarter_hourly FROM wide")
def B08_regime_flags(spark, sf):
    return ft.regime_flags(wide(spark, sf), "2024-01-10", "2024-01-20")


@query("c_custkey:i, c_acctbal:d", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer")
def B09_clip(spark, sf):
    return clean.clip_low(table(spark, sf, "customer"), ["c_acctbal"])


@query("ts:t, click:d, missing:d, view:d", f"WITH {WIDE} SELECT ts, click, CAST(NULL AS DOUBLE) AS missing, view FROM wide")
def B10_align_columns(spark, sf):
    return clean.align_columns(wide(spark, sf), ["ts", "click", "missing", "view"])


@query("l_orderkey:i, l_linenumber:i, price:d", "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 0) AS price FROM lineitem")
def B11_round(spark, sf):
    return table(spark, sf, "lineitem").withColumn("price", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 0))


@query("event_type:s, ts:t, value:d", f"WITH {HOURLY} SELECT event_type, ts, value FROM hourly QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) <= 48")
def B12_tail(spark, sf):
    w = Window.partitionBy("event_type").orderBy(F.desc("ts"))
    return hourly(spark, sf).withColumn("n_", F.row_number().over(w)).where("n_ <= 48")


@query(f"ts:t, {V5}", f"WITH {WIDE} SELECT * FROM wide")
def C01_to_wide(spark, sf):
    return reshape.to_wide(hourly(spark, sf).select("ts", F.col("event_type").alias("column_name"), "value"), list(TYPES))


@query("k:s, date:D, price:d, price2:d", """WITH o AS (SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS price FROM orders GROUP BY ALL),
 l AS (SELECT l_returnflag AS k, CAST(l_shipdate AS DATE) AS date, avg(l_extendedprice) AS price2 FROM lineitem GROUP BY ALL)
 SELECT k, date, price, NULL AS price2 FROM o WHERE date < DATE '1998-01-01' UNION ALL SELECT k, date, NULL, price2 FROM l WHERE date >= DATE '1998-01-01'""")
def C02_regime_merge(spark, sf):
    li = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("k"), F.to_date("l_shipdate").alias("date")).agg(F.avg("l_extendedprice").alias("price2"))
    return merge.regime_merge(daily(spark, sf), li, "1998-01-01", "date")


@query("ts:t, target_price:d", f"WITH {THIN}, {WIDE} SELECT t.ts, coalesce(t.view, t.click, w.error) AS target_price FROM thin t LEFT JOIN wide w ON t.ts = w.ts")
def C03_unified_target(spark, sf):
    return merge.unify_target(wide(spark, sf, thin=True), ["view", "click"], wide(spark, sf).select("ts", F.col("error").alias("value")))


@query("ts:t, view:d, click:d", f"""WITH {WIDE}, base AS (SELECT ts, view, click FROM wide WHERE ts < TIMESTAMP '2024-01-25')
 SELECT * FROM base UNION ALL SELECT date_trunc('hour', ts) AS ts, avg(value), NULL FROM events WHERE event_type = 'view' AND date_trunc('hour', ts) > (SELECT max(ts) FROM base) GROUP BY 1""")
def C04_extend(spark, sf):
    base = wide(spark, sf).where("ts < TIMESTAMP '2024-01-25'").select("ts", "view", "click")
    return merge.extend_with(base, table(spark, sf, "events").where("event_type = 'view'"), "view")


#: Daily prices by priority, none on weekends, for as-of joins.
SPARSE = f"{DAILY}, sparse AS (SELECT k, date, price FROM daily WHERE isodow(date) < 6)"


def _sparse(spark, sf):
    return daily(spark, sf).where("weekday(date) < 5")


def _asked(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("k"), F.col("o_orderdate").alias("ts"))


@query("o_orderkey:i, price:d", f"WITH {SPARSE} SELECT o_orderkey, s.price FROM orders o ASOF LEFT JOIN sparse s ON s.k = o.o_orderpriority AND CAST(o.o_orderdate AS DATE) >= s.date")
def C05_asof(spark, sf):
    return merge.asof(_asked(spark, sf), _sparse(spark, sf), ["price"], ["k"])


@query("o_orderkey:i, price:d", f"WITH {SPARSE}, known AS (SELECT * FROM sparse WHERE date < DATE '2001-01-01') SELECT o_orderkey, s.price FROM orders o ASOF LEFT JOIN known s ON s.k = o.o_orderpriority AND CAST(o.o_orderdate AS DATE) > s.date")
def C06_asof_before(spark, sf):
    return merge.asof(_asked(spark, sf), _sparse(spark, sf), ["price"], ["k"], allow_exact=False, before="2001-01-01")


@query("ts:t, view:d, click:d, purchase:d, forecast_source:i, is_true_forecast:i", f"""WITH {WIDE}, {THIN}, ext AS (SELECT ts, view, click FROM thin WHERE date_part('hour', ts) < 12)
 SELECT w.ts, CASE WHEN e.ts IS NOT NULL THEN e.view ELSE w.view END AS view, CASE WHEN e.ts IS NOT NULL THEN e.click ELSE w.click END AS click, w.purchase,
 CAST(e.ts IS NOT NULL AS INT) AS forecast_source, CASE WHEN e.ts IS NOT NULL THEN 1 ELSE -1 END AS is_true_forecast FROM wide w LEFT JOIN ext e ON w.ts = e.ts""")
def C07_overlay(spark, sf):
    return merge.overlay(wide(spark, sf), wide(spark, sf, thin=True).where("hour(ts) < 12"), ["view", "click"]).withColumn("is_true_forecast", F.coalesce("is_true_forecast", F.lit(-1)))


PRIO = f"""{WIDE}, s AS (SELECT ts, view AS v, 0 AS p FROM wide WHERE date_part('hour', ts) % 4 = 0 UNION ALL SELECT ts, click, 1 FROM wide WHERE date_part('hour', ts) % 2 = 0 UNION ALL SELECT ts, error, 2 FROM wide)"""


def _ranked(spark, sf):
    w = wide(spark, sf)
    return [w.where("hour(ts) % 4 = 0").select("ts", F.col("view").alias("v")), w.where("hour(ts) % 2 = 0").select("ts", F.col("click").alias("v")), w.select("ts", F.col("error").alias("v"))]


@query("ts:t, v:d", f"WITH {PRIO} SELECT ts, v FROM s QUALIFY row_number() OVER (PARTITION BY ts ORDER BY p) = 1")
def C08_source_priority(spark, sf):
    return merge.prefer(_ranked(spark, sf), ["ts"], [F.col("ts")])


SNAP = "snap AS (SELECT date_trunc('hour', ts) AS ts, event_id % 3 AS snapshot, avg(value) FILTER (event_type = 'view') AS view, avg(value) FILTER (event_type = 'click') AS click FROM events GROUP BY ALL)"


def _snapshots(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy(F.date_trunc("hour", "ts").alias("ts"), (F.col("event_id") % 3).alias("snapshot")).agg(*[F.avg(F.when(F.col("event_type") == t, F.col("value"))).alias(t) for t in ("view", "click")])


@query("ts:t, view:d, click:d", f"WITH {SNAP} SELECT ts, arg_max(view, snapshot) FILTER (view IS NOT NULL) AS view, arg_max(click, snapshot) FILTER (click IS NOT NULL) AS click FROM snap GROUP BY ts")
def C09_bitemporal(spark, sf):
    return merge.bitemporal_latest(_snapshots(spark, sf), ["view", "click"], snapshot="snapshot")


@query("ts:t, v:d", f"WITH {PRIO} SELECT ts, v FROM s WHERE p > 0 QUALIFY row_number() OVER (PARTITION BY ts ORDER BY p) = 1")
def C10_prefer_backtest(spark, sf):
    return merge.prefer(_ranked(spark, sf)[1:], ["ts"], [F.col("ts")])


@query("date:D, urgent:d, low:d, high:d", f"WITH {DAILY} SELECT date, max(price) FILTER (k = '1-URGENT') AS urgent, max(price) FILTER (k = '5-LOW') AS low, max(price) FILTER (k = '2-HIGH') AS high FROM daily WHERE k IN ('1-URGENT', '5-LOW', '2-HIGH') GROUP BY date")
def C11_outer_join(spark, sf):
    d = daily(spark, sf)
    return merge.outer_join_daily([d.where(F.col("k") == k).select("date", F.col("price").alias(n)) for k, n in (("1-URGENT", "urgent"), ("5-LOW", "low"), ("2-HIGH", "high"))], ["date"])


@query("event_type:s, ts:t, value:d", f"""WITH {HOURLY}, old AS (SELECT event_type, ts, value FROM hourly WHERE ts < TIMESTAMP '2024-01-20'), ends AS (SELECT event_type, max(ts) AS m FROM old GROUP BY 1),
 new AS (SELECT event_type, ts, value * 2 AS value FROM hourly WHERE ts >= TIMESTAMP '2024-01-08')
 SELECT * FROM new UNION ALL SELECT o.event_type, o.ts, o.value FROM old o JOIN ends e ON o.event_type = e.event_type WHERE o.ts < e.m - INTERVAL 14 DAY AND NOT EXISTS (SELECT 1 FROM new n WHERE n.event_type = o.event_type AND n.ts = o.ts)""")
def C12_upsert(spark, sf):
    h = hourly(spark, sf).select("event_type", "ts", "value")
    return merge.upsert(h.where("ts < TIMESTAMP '2024-01-20'"), h.where("ts >= TIMESTAMP '2024-01-08'").withColumn("value", F.col("value") * 2), ["event_type", "ts"], 14, ["event_type"])


@query(f"ts:t, {V5}", f"""WITH {WIDE}, old AS (SELECT * FROM wide WHERE ts < TIMESTAMP '2024-01-22'), m AS (SELECT max(ts) FILTER (view IS NOT NULL) AS m FROM old),
 new AS (SELECT * FROM wide WHERE ts >= (SELECT m FROM m) - INTERVAL 14 DAY) SELECT * FROM new UNION ALL SELECT * FROM old WHERE ts < (SELECT m FROM m) - INTERVAL 14 DAY""")
def C13_incremental_wide(spark, sf):
    old = wide(spark, sf).where("ts < TIMESTAMP '2024-01-22'")
    last = merge.reference_time(old, ["view"])
    window = table(spark, sf, "events").join(F.broadcast(last)).where("date_trunc('hour', ts) >= last_ - INTERVAL 14 DAYS")
    new = reshape.to_wide(window.select(F.date_trunc("hour", "ts").alias("ts"), F.col("event_type").alias("column_name"), "value"), list(TYPES))
    return merge.upsert(old, new, ["ts"], 14, last=last)


@query("series:s, chunk_start:t", f"""WITH {HOURLY}, c AS (SELECT t.event_type AS series, d AS chunk_start FROM (SELECT DISTINCT event_type FROM events UNION ALL SELECT 'unknown') t, range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-01', INTERVAL 3 DAY) r(d)),
 mark AS (SELECT event_type AS series, min(ts) AS m FROM (SELECT * FROM hourly QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) <= 100) GROUP BY 1),
 f AS (SELECT c.series, max(chunk_start) AS f FROM c JOIN mark ON c.series = mark.series AND chunk_start < m GROUP BY 1)
 SELECT c.series, chunk_start FROM c JOIN f ON c.series = f.series AND chunk_start >= f UNION ALL SELECT series, chunk_start FROM c WHERE series NOT IN (SELECT series FROM mark) AND chunk_start >= TIMESTAMP '2024-01-31' - INTERVAL 20 DAY""")
def C15_chunks(spark, sf):
    h = hourly(spark, sf).select(F.col("event_type").alias("series"), "ts")
    names = h.select("series").distinct().union(spark.range(1).select(F.lit("unknown")))
    chunks = names.withColumn("chunk_start", F.explode(F.expr("sequence(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 3 DAYS)")))
    return merge.chunks_to_read(h, chunks, 100, bootstrap_days=20, as_of="2024-01-31")


@query("ts:t, view:d, click:d, flag:i", f"""WITH {WIDE}, base AS (SELECT ts, view, click, 1 AS flag FROM wide WHERE ts < TIMESTAMP '2024-01-20 10:00:00'),
 g AS (SELECT r.t AS ts FROM range(TIMESTAMP '2024-01-20', TIMESTAMP '2024-01-21', INTERVAL 1 HOUR) r(t)), f AS (SELECT g.ts, w.view * 3 AS view FROM g LEFT JOIN wide w ON w.ts = g.ts - INTERVAL 7 DAY)
 SELECT * FROM base WHERE ts < TIMESTAMP '2024-01-20' UNION ALL SELECT f.ts, f.view, b.click, 1 FROM f LEFT JOIN base b ON b.ts = f.ts""")
def C16_extend_horizon(spark, sf):
    w = wide(spark, sf)
    grid = spark.range(24).select((F.lit("2024-01-20").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("ts"))
    past = w.select((F.col("ts") + F.expr("INTERVAL 7 DAYS")).alias("ts"), (F.col("view") * 3).alias("view"))
    return merge.extend_horizon(w.where("ts < TIMESTAMP '2024-01-20 10:00:00'").select("ts", "view", "click", F.lit(1).alias("flag")), grid.join(past, "ts", "left"), "2024-01-20", ["view"], ["flag"])


DAYS = f"{HOURLY}, days AS (SELECT event_type, CAST(ts AS DATE) AS date, date_part('hour', ts) AS slot, value FROM hourly)"


def _slots(spark, sf):
    return hourly(spark, sf).select("event_type", F.to_date("ts").alias("date"), F.hour("ts").alias("slot"), "value")


@query("event_type:s, ts:t, value:d", f"WITH {DAYS}, ok AS (SELECT event_type, date FROM days GROUP BY ALL HAVING count(*) = 24) SELECT d.event_type, CAST(d.date AS TIMESTAMP) + to_hours(CAST(slot AS INT)) AS ts, value FROM days d JOIN ok USING (event_type, date)")
def C17_arrays_to_hours(spark, sf):
    return reshape.daily_arrays_to_hours(reshape.complete_days(_slots(spark, sf), ["event_type"]), "values")


@query("event_type:s, ts:t, value:d", f"WITH {HOURLY}, ok AS (SELECT ts FROM hourly GROUP BY ts HAVING count(DISTINCT event_type) = 5) SELECT event_type, ts, value FROM hourly WHERE ts IN (SELECT ts FROM ok)")
def C18_align_models(spark, sf):
    return reshape.align_models(hourly(spark, sf), list(TYPES), model="event_type")


@query("ts:t, value:d", f"""WITH {HOURLY}, t AS (SELECT DISTINCT ts FROM hourly WHERE ts < TIMESTAMP '2024-01-03'), hit AS (SELECT h.* FROM hourly h JOIN t USING (ts)), full_ AS (SELECT event_type FROM hit GROUP BY 1 HAVING count(DISTINCT ts) = (SELECT count(*) FROM t)),
 best AS (SELECT h.event_type FROM hourly h JOIN full_ f USING (event_type) GROUP BY 1 ORDER BY count(value) DESC, 1 DESC LIMIT 1)
 SELECT t.ts, coalesce((SELECT avg(value) FROM hit h WHERE h.ts = t.ts AND h.event_type IN (SELECT event_type FROM best)), (SELECT avg(value) FROM hit h WHERE h.ts = t.ts)) AS value FROM t""")
def C19_actuals_lookup(spark, sf):
    h = hourly(spark, sf)
    return merge.actuals_at(h.where("ts < TIMESTAMP '2024-01-03'").select("ts").distinct(), h, source="event_type")


@query("dataset_id:s, models:s", "SELECT p_type AS dataset_id, string_agg(m, ',' ORDER BY m) AS models FROM (SELECT DISTINCT p_type, p_brand AS m FROM part) GROUP BY 1")
def C20_group_models(spark, sf):
    models = table(spark, sf, "part").select(F.col("p_type").alias("dataset_id"), F.col("p_brand").alias("model")).distinct()
    return reshape.group_by_dataset(models).withColumn("models", F.array_join("models", ","))


@query("date:D, price:d", f"WITH {DAILY} SELECT date, coalesce(max(price) FILTER (k = '5-LOW'), max(price) FILTER (k = '1-URGENT')) AS price FROM daily WHERE k IN ('1-URGENT', '5-LOW') GROUP BY date")
def C21_concat_phases(spark, sf):
    d = daily(spark, sf)
    phase = lambda k: d.where(F.col("k") == k).select("date", "price")
    return merge.prefer([phase("5-LOW"), phase("1-URGENT")], ["date"], [F.col("date")])


@query("dimension:s, level:s, avg_price:d, avg_qty:d", """SELECT CASE WHEN grouping(l_returnflag) = 0 THEN 'flag' WHEN grouping(l_linestatus) = 0 THEN 'status' ELSE 'line' END AS dimension,
 coalesce(l_returnflag, l_linestatus, CAST(l_linenumber AS VARCHAR)) AS level, round(avg(l_extendedprice), 3) AS avg_price, round(avg(l_quantity), 3) AS avg_qty FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), (l_linenumber))""")
def H01_grouping_sets(spark, sf):
    table(spark, sf, "lineitem").createOrReplaceTempView("tideline_lineitem")
    return spark.sql("""SELECT CASE WHEN grouping(l_returnflag) = 0 THEN 'flag' WHEN grouping(l_linestatus) = 0 THEN 'status' ELSE 'line' END AS dimension,
      coalesce(l_returnflag, l_linestatus, CAST(l_linenumber AS STRING)) AS level, round(avg(l_extendedprice), 3) AS avg_price, round(avg(l_quantity), 3) AS avg_qty
      FROM tideline_lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), (l_linenumber))""")


@query("event_type:s, date:D, total:d", f"WITH {DAYS}, ok AS (SELECT event_type, date, sum(value) AS total FROM days GROUP BY ALL HAVING count(value) = 24 AND count(*) = 24) SELECT * FROM ok QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY date DESC) <= 7")
def H02_complete_days(spark, sf):
    d = reshape.complete_days(_slots(spark, sf), ["event_type"], last=7)
    return d.withColumn("total", F.aggregate("values", F.lit(0.0), lambda a, x: a + x))


@query("day:D, column_name:s, status:i, last_hour:d", f"""WITH {THIN}, u AS (UNPIVOT (SELECT ts, {', '.join(f'coalesce({t}, -1) AS {t}' for t in TYPES)} FROM thin) ON {', '.join(TYPES)} INTO NAME column_name VALUE v)
 SELECT CAST(ts AS DATE) AS day, column_name, CASE WHEN count(*) FILTER (v >= 0) = 0 THEN 0 WHEN count(*) FILTER (v >= 0) < count(*) THEN 1 ELSE 2 END AS status, max(date_part('hour', ts)) FILTER (v >= 0) AS last_hour FROM u GROUP BY ALL""")
def H03_missing_days(spark, sf):
    u = reshape.to_long(wide(spark, sf, thin=True), ["ts"], list(TYPES))
    n = F.count("value")
    return u.groupBy(F.to_date("ts").alias("day"), "column_name").agg(F.when(n == 0, 0).when(n < F.count("*"), 1).otherwise(2).alias("status"), F.max(F.when(F.col("value").isNotNull(), F.hour("ts"))).alias("last_hour"))


@query("name:s, n_missing:i, pct_missing:d", f"WITH {THIN} " + " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) FILTER ({t} IS NULL) AS n_missing, 100.0 * count(*) FILTER ({t} IS NULL) / count(*) AS pct_missing FROM thin" for t in TYPES))
def H04_missing_counts(spark, sf):
    return clean.missing_counts(wide(spark, sf, thin=True), list(TYPES))


@query("o_custkey:i, o_orderkey:i", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def H05_keep_last(spark, sf):
    return merge.latest_wins(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])


@query("date:D, price:d, origin:s", "SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS price, 'o' AS origin FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE), l_extendedprice, 'l' FROM lineitem")
def H06_union(spark, sf):
    o = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("price"), F.lit("o").alias("origin"))
    return o.unionByName(table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date"), F.col("l_extendedprice").alias("price"), F.lit("l").alias("origin")))


@query("ts:t", f"WITH {HOURLY} SELECT ts FROM hourly WHERE event_type = 'view' INTERSECT SELECT ts FROM hourly WHERE event_type = 'click' EXCEPT SELECT ts FROM hourly WHERE event_type = 'error'")
def H07_common_times(spark, sf):
    h = hourly(spark, sf)
    of = lambda t: h.where(F.col("event_type") == t).select("ts")
    return of("view").intersect(of("click")).exceptAll(of("error"))


@query("c_nationkey:i, c_custkey:i, c_acctbal:d", "SELECT c_nationkey, c_custkey, c_acctbal FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) <= 3")
def H08_top_k(spark, sf):
    return table(spark, sf, "customer").withColumn("n_", F.row_number().over(Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"), "c_custkey"))).where("n_ <= 3")


@query("event_type:s, ts:t, value:d", f"WITH {HOURLY} SELECT event_type, ts, value FROM hourly")
def H09_resample(spark, sf):
    return hourly(spark, sf)
