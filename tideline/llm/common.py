"""Shared helpers: the shared work folder, saved intermediate tables, code shipping.

Intermediate tables are written as Parquet below the folder named by
``spark.checkpoint.dir``, which the driver and all executors share. That cuts
lineage durably: a lost executor costs a re-read, not a recomputation. What no
later step reads again is deleted with ``discard``.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Applications that have the package already.
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, and bound what a Python worker gets at once.

    A batch of rows is held several times (by the JVM, Arrow and Python), so
    batches of long texts are kept to a few MB.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    out = Path(tempfile.mkdtemp(prefix="tideline-")) / "tideline_src.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in top.rglob("*.py"):
            z.write(p, p.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(out))
    _SHIPPED.add(app)


def work_dir(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder.

    The folder comes from the session's ``spark.checkpoint.dir``. Only where that
    is unset in local mode, as in tests, a temporary folder is used instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tideline-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tideline-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` to the shared folder and return a reader of what was written."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def discard(*saved: DataFrame) -> None:
    """Delete tables of ``save`` that nothing reads any more."""
    for df in saved:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(df._saved_at.rsplit("/", 1)[0])
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


#: Rows of a table of ids up to which a join may hash it whole.
FEW = 100_000


def shuffled(df: DataFrame, n: int | None = None) -> DataFrame:
    """``df``, of ``n`` rows or as many as it has, for a join that broadcasts it only if its rows are few.

    Spark goes by the size of compressed files. Ids take some seven bytes there and
    ninety where the driver hashes them, and a table that is exploded counts as it was before.
    """
    return df if (df.count() if n is None else n) <= FEW else df.hint("merge")


#: Rows of an edge table that a file of it holds.
EDGES = 100_000


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, root): the smallest id that each linked id reaches.

    A round's tables have files by their rows, not by the number of shuffle
    partitions, so many partitions do not make rounds over few edges slow.
    """
    cores = edges.sparkSession.sparkContext.defaultParallelism
    now = save(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi > lo").distinct(), "edges")
    seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    for _ in range(max_rounds):
        files = max(cores, -(-seen["n"] // EDGES))
        # large star: every larger neighbour goes to the smallest neighbour, or oneself
        least = now.groupBy(F.col("hi").alias("lo")).agg(F.min("lo").alias("m"))
        large = save(now.join(shuffled(least, seen["n"]), "lo", "left").select("hi", F.coalesce("m", "lo").alias("lo")).coalesce(files), "large")
        # small star: smaller neighbours, and oneself, go to the smallest
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(shuffled(low, seen["n"]), "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi > lo").union(low.select("hi", F.col("m").alias("lo")))
        before, now = now, save(small.distinct().coalesce(files), "edges")
        discard(before, large)
        mark, seen = seen, now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if seen == mark:
            return shuffled(now.groupBy(F.col("hi").alias("id")).agg(F.min("lo").alias("root")), seen["n"])
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """Column names like ``names`` that clash with none of ``taken``; Spark ignores case."""
    low = {t.lower() for t in taken}
    out = []
    for name in names:
        while name.lower() in low:
            name = "_" + name
        low.add(name.lower())
        out.append(name)
    return out


def slices(batch: pa.RecordBatch, column: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a part has about ``size`` bytes of the given column, or one row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
        to = max(to, at + 1)
        yield batch.slice(at, to - at)
        at = to


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
