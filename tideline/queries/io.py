"""Readers, writers, datasets, documents and streams: Spark first lands the driver tables in the form to be read."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators import merge, reshape
from tideline.plans import jobs  # noqa: F401
from tideline.registry import DAILY, HOURLY, THIN, TYPES, WIDE, daily, hourly, query, scratch, table, wide
from tideline.session import pin
from tideline.sources import datasets as ds
from tideline.sources import readers as rd
from tideline.streaming import jobs as st
from tideline.streaming import stateful


@query("region:s, ts:t, value:d, measure:i", f"WITH {HOURLY} SELECT event_type AS region, ts, value, date_part('hour', ts) AS measure FROM hourly")
def A01_long_csv(spark, sf):
    path = f"{scratch(spark)}/long"
    h = hourly(spark, sf)
    # offsets on some rows only
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.hour("ts") % 2 == 0, "+00:00").otherwise(""))
    h.select(F.unix_millis("ts").alias("timestamp"), "value", stamp.alias("time"), F.col("event_type").alias("region"), F.hour("ts").alias("measure"), F.lit("hourly").alias("measure_desc")).write.option("header", True).csv(path)
    return rd.read_long_csv(spark, path)


@query("ts:t, view:d", f"WITH {WIDE} SELECT ts, view FROM wide WHERE date_part('year', ts) = 2024")
def A02_wide_parquet(spark, sf):
    path = f"{scratch(spark)}/wide"
    rd.write_wide(wide(spark, sf), path)
    return rd.read_wide(spark, path).where("year = 2024")


@query("date:D, low:d, urgent:d", f"WITH {DAILY} SELECT date, max(price) FILTER (k = '5-LOW') AS low, max(price) FILTER (k = '1-URGENT') AS urgent FROM daily WHERE k IN ('5-LOW', '1-URGENT') GROUP BY date")
def A04_daily_folder(spark, sf):
    path = scratch(spark)
    for k, name in (("5-LOW", "low"), ("1-URGENT", "urgent")):
        daily(spark, sf).where(F.col("k") == k).select(F.col("date").alias("Date"), F.col("price").alias("Price")).write.option("header", True).csv(f"{path}/{name}.csv")
    frames = rd.read_daily_folder(spark, path, {"low.csv": ("Price", "low"), "urgent.csv": ("Price", "urgent"), "absent.csv": ("Price", "absent")})
    return merge.outer_join_daily(list(frames.values()), ["date"])


@query("date:D, primary:d, secondary:d", f"WITH {DAILY} SELECT date, CASE WHEN date_part('day', date) % 5 <> 0 THEN price END AS \"primary\", price / 2 AS secondary FROM daily WHERE k = '2-HIGH'")
def A05_report_csv(spark, sf):
    path = f"{scratch(spark)}/report"
    d = daily(spark, sf).where("k = '2-HIGH'")
    line = F.concat_ws(",", F.col("date").cast("string"), F.when(F.dayofmonth("date") % 5 != 0, F.col("price").cast("string")).otherwise("n/a"), (F.col("price") / 2).cast("string"), F.lit(""))
    # one report per year, each with its banner and header
    text = d.groupBy(F.year("date").alias("y")).agg(F.concat(F.lit("Market report,,,\n Date , Primary Market,Secondary Market , Unnamed\n"), F.array_join(F.sort_array(F.collect_list(line)), "\n")).alias("value"))
    text.select("value").repartition(8, "value").write.option("maxRecordsPerFile", 1).text(path)
    return rd.read_report_csv(spark, path, {"Primary Market": "primary", "Secondary Market": "secondary"})


@query("region:s, ts:t, value:d", f"WITH {HOURLY} SELECT event_type AS region, ts, value FROM hourly WHERE event_type = 'view'")
def A06_series_json(spark, sf):
    path = f"{scratch(spark)}/series"
    pair = F.array(F.unix_millis("ts").cast("double"), F.col("value"))
    hourly(spark, sf).where("event_type = 'view'").groupBy(F.to_date("ts").alias("day")).agg(F.collect_list(pair).alias("series")).select("series").write.json(path)
    return rd.decode_series(spark.read.schema(rd.SERIES_SCHEMA).json(path), {"region": "view"})


@query("chunk_start:t", f"WITH {HOURLY} SELECT DISTINCT date_trunc('day', ts) AS chunk_start FROM hourly")
def A07_chunk_index(spark, sf):
    path = f"{scratch(spark)}/index"
    hourly(spark, sf).groupBy(F.trunc(F.to_date("ts"), "month")).agg(F.collect_set(F.unix_millis(F.date_trunc("day", "ts"))).alias("timestamps")).select("timestamps").write.json(path)
    return rd.decode_index(spark.read.schema(rd.INDEX_SCHEMA).json(path))


@query("ts:t, value:d", f"WITH {HOURLY} SELECT ts, value FROM hourly WHERE event_type = 'click' AND date_part('hour', ts) <> 5")
def A08_price_arrays(spark, sf):
    path = f"{scratch(spark)}/prices"
    price = F.transform("a", lambda x: F.when(F.hour(F.timestamp_seconds(x["s"])) != 5, x["v"]))
    hourly(spark, sf).where("event_type = 'click'").groupBy(F.to_date("ts").alias("day")).agg(F.collect_list(F.struct(F.unix_seconds("ts").alias("s"), F.col("value").alias("v"))).alias("a")).select(F.col("a.s").alias("unix_seconds"), price.alias("price")).write.option("ignoreNullFields", False).json(path)
    return rd.decode_prices(spark.read.schema(rd.PRICE_SCHEMA).json(path))


@query("ts:t, view:d, click:d", f"WITH {WIDE} SELECT ts, view, click FROM wide")
def A09_forecast_csv(spark, sf):
    path = f"{scratch(spark)}/forecast.csv"
    wide(spark, sf).select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date"), "view", "click").write.option("header", True).csv(path)
    return rd.read_forecast_csv(spark, [f"{path}.absent", path], "date STRING, view DOUBLE, click DOUBLE")


@query("snapshot_date:D, n:i, view:d", f"WITH {WIDE} SELECT CAST(ts AS DATE) AS snapshot_date, count(*) AS n, sum(view) AS view FROM wide GROUP BY 1")
def A10_snapshots(spark, sf):
    base = scratch(spark)
    wide(spark, sf).withColumn("published", F.to_date("ts")).write.partitionBy("published").parquet(base)
    return rd.read_snapshots(spark, base).groupBy("snapshot_date").agg(F.count("*").alias("n"), F.sum("view").alias("view"))


@query("source:s, is_true_forecast:i, n:i", f"WITH {WIDE} SELECT 'backtest_a' AS source, 1 AS is_true_forecast, count(*) AS n FROM wide UNION ALL SELECT 'hindcast_b', 0, count(*) FROM wide WHERE date_part('hour', ts) < 6")
def A11_hindcasts(spark, sf):
    base, w = scratch(spark), wide(spark, sf).select("ts", "view")
    w.write.parquet(f"{base}/backtest_a.parquet")
    w.where("hour(ts) < 6").write.parquet(f"{base}/hindcast_b.parquet")
    files = [f"{base}/{x}.parquet" for x in ("backtest_a", "hindcast_b")] + [f"{base}/per_tso_c.parquet"]
    return rd.read_hindcasts(spark, files, ["ts", "view"]).groupBy("source", "is_true_forecast").agg(F.count("*").alias("n"))


@query("snapshot_date:D, n:i", f"WITH {WIDE} SELECT DATE '2024-01-01' AS snapshot_date, count(*) AS n FROM wide WHERE date_part('hour', ts) < 6 UNION ALL SELECT DATE '2024-01-02', count(*) FROM wide")
def A12_write_snapshot(spark, sf):
    path, w = f"{scratch(spark)}/snapshots", wide(spark, sf)
    ds.write_snapshot(w, path, "2024-01-01")
    ds.write_snapshot(w, path, "2024-01-02")
    ds.write_snapshot(w.where("hour(ts) < 6"), path, "2024-01-01")  # replaces its own date only
    return spark.read.parquet(path).groupBy("snapshot_date").agg(F.count("*").alias("n"))


@query("dataset:s, forecast_date:D, n:i", f"WITH {WIDE} SELECT unnest(['a', 'b']) AS dataset, DATE '2024-02-01' AS forecast_date, count(*) AS n FROM wide")
def A13_append_snapshot(spark, sf):
    path, w = f"{scratch(spark)}/features", wide(spark, sf)
    for name in ("a", "b"):
        ds.append_feature_snapshot(w, path, name, "2024-02-01", "2024-01-31 12:00:00")
    return spark.read.parquet(path).groupBy("dataset", "forecast_date").agg(F.count("*").alias("n"))


@query("k:s, ts:t, value:d", f"WITH {HOURLY}, m AS (SELECT event_type, max(ts) AS m FROM hourly GROUP BY 1) SELECT h.event_type AS k, ts, value FROM hourly h JOIN m ON h.event_type = m.event_type WHERE ts > m - INTERVAL 336 HOUR")
def A14_source_snapshot(spark, sf):
    h = hourly(spark, sf).select(F.col("event_type").alias("k"), "ts", "value")
    path = f"{scratch(spark)}/source"
    for d in ("2024-01-20", "2024-01-30"):
        ds.write_snapshot(ds.source_snapshot(h, 336, ["k"]), path, d)
    return ds.retained(spark.read.parquet(path), "2024-01-31", 7)


DOC = f"{HOURLY}, s AS (SELECT event_type AS m, CAST(ts AS DATE) AS date, date_part('hour', ts) AS slot, value FROM hourly)"


@query("date:D, n_prices:i, total:d, n_models:i", f"WITH {DOC} SELECT date, count(*) FILTER (m = 'view') AS n_prices, sum(value) FILTER (m = 'view') AS total, count(DISTINCT m) FILTER (m IN ('click', 'error')) AS n_models FROM s GROUP BY date")
def A15_documents(spark, sf):
    name = F.when(F.col("event_type") == "view", "blend").otherwise(F.col("event_type"))
    p = hourly(spark, sf).where("event_type IN ('view', 'click', 'error')").select(F.to_date("ts").alias("date"), F.hour("ts").alias("slot"), name.alias("model"), F.col("value").alias("pred"))
    path = f"{scratch(spark)}/documents"
    ds.forecast_documents(p, "2024-02-01 00:00:00", decimals=12).select(F.col("document").alias("value")).write.text(path)
    d = spark.read.schema("date STRING, prices ARRAY<DOUBLE>, model_predictions MAP<STRING, ARRAY<DOUBLE>>").json(path)
    return d.select(F.to_date("date").alias("date"), F.size("prices").alias("n_prices"), F.aggregate("prices", F.lit(0.0), lambda a, x: a + x).alias("total"), F.size("model_predictions").alias("n_models"))


def _datasets(spark, sf):
    store = ds.Datasets(spark, f"{scratch(spark)}/datasets")
    w = wide(spark, sf).select("ts", "click", "error", F.col("view").alias("y"))
    store.save(w, "base", "2024-02-01", spec="v1", tags={"grain": "hour"})
    store.save(w.where("hour(ts) < 12"), "base", "2024-02-02", spec="v2", tags={"grain": "hour"})
    store.save(w, "other", "2024-02-01")
    return store


@query("name:s, version:i, n_rows:i, n_features:i", f"WITH {WIDE} SELECT 'base' AS name, 1 AS version, count(*) AS n_rows, 2 AS n_features FROM wide WHERE view IS NOT NULL UNION ALL SELECT 'base', 2, count(*), 2 FROM wide WHERE view IS NOT NULL AND date_part('hour', ts) < 12 UNION ALL SELECT 'other', 1, count(*), 2 FROM wide WHERE view IS NOT NULL")
def A16_save_dataset(spark, sf):
    return _datasets(spark, sf).list().withColumn("n_features", F.size("features"))


@query("ts:t, click:d, y:d", f"WITH {WIDE} SELECT ts, click, view AS y FROM wide WHERE view IS NOT NULL AND date_part('hour', ts) < 12")
def A17_load_dataset(spark, sf):
    return _datasets(spark, sf).load(name="base")


@query("name:s, version:i, newest_first:i", "SELECT * FROM (VALUES ('base', 1, 2), ('base', 2, 1)) t(name, version, newest_first)")
def A18_list_datasets(spark, sf):
    return _datasets(spark, sf).list({"grain": "hour"})


@query("ts:t, click:d, y:d", f"WITH {WIDE} SELECT ts, click, view AS y FROM wide WHERE view IS NOT NULL")
def A19_select_columns(spark, sf):
    store = _datasets(spark, sf)
    store.select("base/1", "small", ["click"], "2024-02-03")
    return store.load(name="small")


@query("name:s, first:t, last:t, n:i", f"WITH {WIDE} " + " UNION ALL ".join(f"SELECT '{t}' AS name, min(ts) FILTER ({t} IS NOT NULL) AS first, max(ts) FILTER ({t} IS NOT NULL) AS last, count({t}) AS n FROM wide" for t in TYPES))
def A21_availability(spark, sf):
    from tideline.operators.clean import availability

    return availability(wide(spark, sf), list(TYPES))


@query(f"ts:t, {', '.join(f'{t}:d' for t in TYPES)}", f"WITH {WIDE} SELECT * FROM wide")
def C14_incremental_merge(spark, sf):
    """A wide table kept up to date by windows equals one made from everything."""
    full = wide(spark, sf)
    path = f"{scratch(spark)}/merged"
    full.where("ts < TIMESTAMP '2024-01-20'").write.parquet(path)
    existing = spark.read.parquet(path)
    last = merge.reference_time(existing, ["view"])
    window = full.join(F.broadcast(last)).where("ts >= last_ - INTERVAL 14 DAYS").drop("last_")
    return merge.upsert(existing, window, ["ts"], 14, last=last)


# ---- streams ----


@query("event_type:s, ts:t, value:d, n:i", f"WITH {HOURLY} SELECT event_type, ts, value, n FROM hourly WHERE ts + INTERVAL 3 HOUR <= (SELECT max(ts) FROM events)")
def S01_stream_means(spark, sf):
    """Windows come out once the watermark has passed them; rows that arrive behind it change nothing."""
    base, e = scratch(spark), table(spark, sf, "events")

    def run():
        stream = spark.readStream.schema(e.schema).parquet(f"{base}/in")
        st.append_stream(st.hourly_means(stream, ["event_type"], late="2 hours"), f"{base}/out", f"{base}/ck").awaitTermination()

    e.write.parquet(f"{base}/in")
    run()
    first = e.agg(F.min("ts").alias("first"))
    e.join(F.broadcast(first)).where("ts < first + INTERVAL 3 DAYS").withColumn("value", F.col("value") * 100).drop("first").write.mode("append").parquet(f"{base}/in")
    run()
    return spark.read.schema("event_type STRING, ts TIMESTAMP, value DOUBLE, n LONG").parquet(f"{base}/out")


@query("event_type:s, ts:t, n:i, value:d", """WITH w AS (SELECT event_type, value, ts, unnest([0, 1, 2]) AS i FROM events), b AS (SELECT event_type, value, time_bucket(INTERVAL 2 HOUR, ts, TIMESTAMP '2000-01-01') - i * INTERVAL 2 HOUR AS s, ts FROM w)
 SELECT event_type, s AS ts, count(*) AS n, avg(value) AS value FROM b WHERE ts < s + INTERVAL 6 HOUR AND s + INTERVAL 8 HOUR <= (SELECT max(ts) FROM events) GROUP BY event_type, s""")
def S01_sliding(spark, sf):
    base, e = scratch(spark), table(spark, sf, "events")
    e.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(e.schema).parquet(f"{base}/in")
    w = stream.withWatermark("ts", "2 hours").groupBy("event_type", F.window("ts", "6 hours", "2 hours").alias("w")).agg(F.count("*").alias("n"), F.avg("value").alias("value"))
    st.append_stream(w.select("event_type", F.col("w.start").alias("ts"), "n", "value"), f"{base}/out", f"{base}/ck").awaitTermination()
    return spark.read.schema("event_type STRING, ts TIMESTAMP, n LONG, value DOUBLE").parquet(f"{base}/out")


@query("user_id:i, ts:t, last:t, n:i", """WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 12 HOUR THEN 1 ELSE 0 END AS new FROM events), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS i FROM g)
 SELECT user_id, min(ts) AS ts, max(ts) + INTERVAL 12 HOUR AS last, count(*) AS n FROM s GROUP BY user_id, i HAVING max(ts) + INTERVAL 14 HOUR <= (SELECT max(ts) FROM events)""")
def S01_sessions(spark, sf):
    base, e = scratch(spark), table(spark, sf, "events")
    e.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(e.schema).parquet(f"{base}/in")
    w = stream.withWatermark("ts", "2 hours").groupBy("user_id", F.session_window("ts", "12 hours").alias("w")).agg(F.count("*").alias("n"))
    st.append_stream(w.select("user_id", F.col("w.start").alias("ts"), F.col("w.end").alias("last"), "n"), f"{base}/out", f"{base}/ck").awaitTermination()
    return spark.read.schema("user_id LONG, ts TIMESTAMP, last TIMESTAMP, n LONG").parquet(f"{base}/out")


@query("k:s, kind:s, ts:t, until:t, value:d, n:i", f"""WITH RECURSIVE {THIN}, l AS ({' UNION ALL '.join(f"SELECT '{t}' AS k, ts, {t} AS value FROM thin" for t in TYPES)}),
 v AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts) AS r, count(value) OVER (PARTITION BY k ORDER BY ts) AS g FROM l),
 x AS (SELECT k, value, r, row_number() OVER (PARTITION BY k ORDER BY r) AS i, r - lag(r) OVER (PARTITION BY k ORDER BY r) AS step FROM v WHERE value IS NOT NULL),
 e AS (SELECT k, i, r, value AS w FROM x WHERE i = 1 UNION ALL SELECT x.k, x.i, x.r, (pow(5 / 7, x.step) * e.w + 2 / 7 * x.value) / (pow(5 / 7, x.step) + 2 / 7) FROM e JOIN x ON x.k = e.k AND x.i = e.i + 1)
 SELECT v.k, 'row' AS kind, v.ts, CAST(NULL AS TIMESTAMP) AS until, e.w AS value, 1 AS n FROM v ASOF LEFT JOIN e ON v.k = e.k AND v.r >= e.r
 UNION ALL SELECT k, 'gap', min(ts) FILTER (value IS NULL), (SELECT min(n.ts) FROM v n WHERE n.k = v.k AND n.g = v.g + 1), NULL, count(*) FILTER (value IS NULL) FROM v GROUP BY k, g HAVING count(*) FILTER (value IS NULL) > 0 AND (SELECT count(*) FROM v n WHERE n.k = v.k AND n.g = v.g + 1) > 0
 UNION ALL SELECT k, 'late', ts, NULL, value, 1 FROM l WHERE value IS NOT NULL AND ts < TIMESTAMP '2024-01-04'""")
def S01_stateful(spark, sf):
    """A running EWMA and the gaps of each series, stopped in mid-stream and started again; what comes late is told apart."""
    base, schema = scratch(spark), "k string, ts timestamp, value double"
    long = pin(reshape.to_long(wide(spark, sf, thin=True), ["ts"], list(TYPES)).select(F.col("column_name").alias("k"), "ts", "value"))

    def run():
        st.append_stream(stateful.ewma_and_gaps(spark.readStream.schema(schema).parquet(f"{base}/in"), 6), f"{base}/out", f"{base}/ck").awaitTermination()

    long.where("ts < TIMESTAMP '2024-01-16'").write.parquet(f"{base}/in")
    run()
    again = long.where("value IS NOT NULL AND ts < TIMESTAMP '2024-01-04'")
    long.where("ts >= TIMESTAMP '2024-01-16'").unionByName(again).write.mode("append").parquet(f"{base}/in")
    run()
    return spark.read.schema(stateful.OUT).parquet(f"{base}/out")


@query("event_type:s, ts:t, value:d", f"WITH {HOURLY} SELECT event_type, ts, value * 2 AS value FROM hourly WHERE ts >= (SELECT max(ts) FROM hourly) - INTERVAL 14 DAY UNION ALL SELECT event_type, ts, value FROM hourly WHERE ts < (SELECT max(ts) FROM hourly) - INTERVAL 14 DAY")
def S02_stream_upsert(spark, sf):
    base = scratch(spark)
    h = hourly(spark, sf).select("event_type", "ts", "value")
    # corrections of everything come after the first load; only those of the last 14 days are taken
    h.withColumn("version", F.lit(1)).write.parquet(f"{base}/in/a")
    st.upsert_batch(spark.read.parquet(f"{base}/in/a").where("ts IS NOT NULL"), f"{base}/table", f"{base}/late", ["event_type", "ts"], late_days=60)
    h.withColumns({"version": F.lit(2), "value": F.col("value") * 2}).write.parquet(f"{base}/in/b")
    stream = spark.readStream.schema("event_type STRING, ts TIMESTAMP, value DOUBLE, version INT").parquet(f"{base}/in/b")
    st.upsert_stream(stream, f"{base}/table", f"{base}/late", f"{base}/ck", ["event_type", "ts"]).awaitTermination()
    return spark.read.parquet(f"{base}/table")


@query("k:s, date:D, total:d", f"WITH {HOURLY}, d AS (SELECT event_type AS k, CAST(ts AS DATE) AS date, sum(value) AS total FROM hourly GROUP BY ALL) SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY k ORDER BY date DESC) <= 6")
def S03_stream_history(spark, sf):
    base = scratch(spark)
    hourly(spark, sf).groupBy(F.col("event_type").alias("k"), F.to_date("ts").alias("date")).agg(F.sum("value").alias("total")).withColumn("generated_at", F.lit("2024-02-01").cast("timestamp")).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("k STRING, date DATE, total DOUBLE, generated_at TIMESTAMP").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")

    def keep(batch, i):
        path, before = f"{base}/history_{i}", f"{base}/history_{i - 1}"
        old = spark.read.parquet(before) if i else batch.limit(0)
        ds.upsert_history(old, batch, 6, keys=["k"]).write.mode("overwrite").parquet(path)
        batch.sparkSession.createDataFrame([(i,)], "i int").write.mode("overwrite").parquet(f"{base}/last")

    stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/history_{spark.read.parquet(f'{base}/last').first()[0]}")
