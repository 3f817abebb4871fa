"""Mixing sources to target weights by weighted fair queueing.

Sources, in code-point order with null last, weigh ``weights`` in turn and share
the budget (a share of all words). A target stops at ``most`` times its source's
size and what it leaves is shared again by weight, which has a closed form: with
one level L, a target is min(cap, weight * L).

Every document gets a shuffle key. In its source's shuffled order, epoch after
epoch, a document's virtual finish time is the source's cumulative words,
itself included, over the source's target. All copies are range-sorted by that
time and the mix is cut where its words reach the budget. Cumulative sums are
prefix scans over buckets, so a source of any size is dealt over many tasks, and
the global cut adds up range partitions first. What is taken of a source is
always a prefix of its order, so the result is one cut key per source and
epoch; texts are never shuffled.

Defined results: a null or empty text has size 0 and is never taken; rows that
repeat a doc_id and size share one place in the order and are decided together;
a source without words has target 0; an empty table gives an empty table.
Extra columns are ignored by ``mix`` and kept by ``mixed_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import save

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a bucket of the prefix scans, on average.
BUCKET_ROWS = 4096


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), share: float = 1.0, most: int = 3) -> DataFrame:
    """Adds source_no, weight and target to (source, source_size, n_rows): one row per source, so few rows.

    In order of cap per weight the sources that reach their caps come first. The
    level is that of the first source which it leaves within its cap, with the
    words and weights that the ones before leave over.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy("cap_per_weight", "source_no")
    before, everything = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    caps = (
        sizes.withColumn("source_no", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(pattern, (F.col("source_no") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * float(most))
        .withColumn("cap_per_weight", F.col("cap") / F.col("weight"))
    )
    left = caps.withColumn("level", (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    first = F.min(F.when(F.col("cap_per_weight") >= F.col("level"), F.struct("cap_per_weight", "source_no", "level"))).over(everything)["level"]
    return left.withColumn("level", first).select("source", "source_no", "source_size", "n_rows", "weight", F.coalesce(F.least("cap", F.col("weight") * F.col("level")), F.col("cap")).alias("target"))


def _order(seed: int, bucket_rows: int) -> Column:
    """The shuffled order of a source's documents; its buckets are the parts of the prefix scan."""
    key = F.xxhash64(F.lit(seed), "doc_id", "size")
    bucket = F.pmod(F.shiftright(key, 20), F.ceil(F.col("n_rows") / bucket_rows))
    return F.struct(bucket.alias("bucket"), key.alias("key"), "doc_id", "size")


def plan(slim: DataFrame, weights=(1, 2, 3), share: float = 1.0, most: int = 3, seed: int = 7, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per source of (doc_id, source, size): its target, and per epoch the last place of its order that is taken."""
    sources = save(targets(slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows")), weights, share, most), "sources")
    budget = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    shuffled = with_sources(slim.where("size > 0"), sources).where("target > 0")
    # what repeats a document (same id and size) goes with it: one unit
    units = shuffled.groupBy("source_no", "source_size", "target", "n_rows", "doc_id", "size").agg((F.count("*") * F.col("size")).alias("words")).withColumn("place", _order(seed, bucket_rows)).withColumn("bucket", F.col("place.bucket"))

    in_bucket = Window.partitionBy("source_no", "bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = units.groupBy("source_no", "bucket").agg(F.sum("words").alias("w")).select("source_no", "bucket", F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("start"))
    epochs = F.sequence(F.lit(0), F.least(F.lit(most - 1), F.floor(F.col("target") / F.col("source_size")).cast("int")))
    copies = (
        units.withColumn("upto", F.sum("words").over(in_bucket))
        .join(starts, ["source_no", "bucket"])
        .withColumn("epoch", F.explode(epochs))
        .select("source_no", "epoch", "place", "words", ((F.col("epoch") * F.col("source_size") + F.col("start") + F.col("upto")) / F.col("target")).alias("finish"))
    )

    # Global order by finish time: whole ranges first, then inside the one range that the budget cuts.
    order = ["finish", "source_no", "epoch", "place"]
    n_ranges = int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = save(copies.repartitionByRange(n_ranges, *order).withColumn("range", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("range").agg(F.sum("words").alias("w")).withColumn("upto", F.sum("w").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    marked = ranged.join(F.broadcast(sums), "range")  # a row per range: their number is that of the shuffle partitions
    whole = marked.where(F.col("upto") <= budget)
    running = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = marked.where((F.col("upto") > budget) & (F.col("upto") - F.col("w") < budget)).withColumn("total", F.col("upto") - F.col("w") + F.sum("words").over(running)).where(F.col("total") <= budget).drop("total")
    cuts = whole.union(part).groupBy("source_no", "epoch").agg(F.max("place").alias("last")).groupBy("source_no").agg(F.collect_list("last").alias("cuts"))
    return save(sources.join(cuts, "source_no", "left"), "cuts")


def with_sources(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Null-safe join on source; Spark broadcasts the few sources only where their size allows it."""
    right = sources.withColumnRenamed("source", "source_")
    return rows.join(right, F.col("source").eqNullSafe(F.col("source_"))).drop("source_")


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size"))


def _repeats(seed: int, bucket_rows: int) -> Column:
    """How often the mix takes a document: the epochs whose cut its place does not pass."""
    place = _order(seed, bucket_rows)
    return F.when((F.col("size") > 0) & F.col("cuts").isNotNull(), F.size(F.filter("cuts", lambda last: place <= last))).otherwise(0)


def mix(docs: DataFrame, weights=(1, 2, 3), share: float = 1.0, most: int = 3, seed: int = 7, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted) of every row."""
    slim = save(_slim(docs), "slim")
    sources = plan(slim, weights, share, most, seed, bucket_rows)
    return with_sources(slim, sources).select("doc_id", "size", "source_size", "target", (F.col("size") * _repeats(seed, bucket_rows)).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, weights=(1, 2, 3), share: float = 1.0, most: int = 3, seed: int = 7, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The mix itself: the rows of ``docs`` that it takes, each as often as it is taken, all columns kept."""
    sources = plan(save(_slim(docs), "slim"), weights, share, most, seed, bucket_rows)
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    taken = with_sources(whole, sources).withColumn("n", _repeats(seed, bucket_rows)).where("n > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "n"))).select("row.*")
