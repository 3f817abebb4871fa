"""Exact top-k search by distributed histogram selection.

Vectors are made integers (floor of scale times component) and scored by inner
product, blocks of vectors against blocks of queries. The first pass counts all
scores of a query in wide bins and finds the bin of its k-th score; further
passes count inside that bin, in narrower bins, until it is a single score; the
last keeps what scores more, and of those that score just as much the smallest
ids. Each task reports only bins, and ties, that can still matter: its own k
best lie at or above them.

Queries go in waves of bounded size, which are sent to the tasks; the vectors
are read again for each, and all hits go to one folder. Scores are exact: matrix
products in double precision where all sums stay below 2**53, in 64-bit integers
otherwise. Rows are told apart by a number of their own, given when the integer
vectors are saved, so ids may repeat.

Defined results: vectors that are null, or hold a null or a component that is not
finite, take no part, nor do rows without an id; vectors of different length are
not compared; a query is not compared with its own row, but with other rows of
its id; queries that share an id have their results apart, each with ranks from 1;
repeated candidate rows count each, ties to the smaller id; queries with fewer
candidates return all of them; an error is raised where scores may not fit in 64
bits; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import save, ship, work_dir

#: Queries in a wave; at 1,000 components 64 MB.
WAVE = 8192
ROWS = 2048
HITS = "no long, vec_id long, score long"
BINS = 512


def integer_vectors(vectors: DataFrame, asks: Column, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64) -> DataFrame:
    """no (the row's own number), vec_id, asks, dim, q (64-bit integers as bytes) and top (the largest absolute component) of the vectors that take part; saved."""
    ship(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for vec_id, asks, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if vec_id is None or not v.is_valid or v.values.null_count:
                    continue
                x = np.floor(v.values.to_numpy(zero_copy_only=False).astype(float) * scale)
                if np.isfinite(x).all():
                    rows.append((vec_id, asks, len(x), x.astype("<i8").tobytes(), float(np.abs(x).max(initial=0))))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.float64()))], ["vec_id", "asks", "dim", "q", "top"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.coalesce(asks, F.lit(False)).alias("asks"), F.col(vec_col).alias("v"))
    return save(rows.mapInArrow(run, "vec_id long, asks boolean, dim int, q binary, top double").withColumn("no", F.monotonically_increasing_id()), "vectors")


class Wave:
    """A bounded set of queries of one length, and what is known of each one's k-th score.

    It lies in [low, low + width), and ``left`` of what lies there, counted from
    above, belong to the k best.
    """

    def __init__(self, rows: np.ndarray, matrix: np.ndarray, bound: int, k: int):
        self.rows, self.matrix = rows, matrix.astype(float) if bound < 1 << 53 else matrix
        self.low, self.width, self.left = np.full(len(rows), -bound), 2 * bound + 1, np.full(len(rows), k)

    def scores(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """(queries, vec_ids, scores, which are not a query's own row), block by block."""
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                rows, ids = part.column(0).to_numpy(), part.column(1).to_numpy()
                v = np.frombuffer(b"".join(part.column(2).to_pylist()), "<i8").reshape(len(ids), -1).T.astype(self.matrix.dtype)
                for q in range(0, len(self.rows), ROWS):
                    at = slice(q, min(q + ROWS, len(self.rows)))
                    yield at, ids, (self.matrix[at] @ v).astype(np.int64), self.rows[at, None] != rows[None, :]


def _count(wave: Wave, step: int):
    """Histograms over each query's range, in bins of ``step``, from the top down to where a task's own counts suffice."""
    n_bins = -(-wave.width // step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hist = np.zeros((len(wave.rows), n_bins), np.int64)
        for at, _, s, other in wave.scores(batches):
            b = (s - wave.low[at, None]) // step
            ok = other & (b >= 0) & (b < n_bins)
            rows = np.broadcast_to(np.arange(len(s))[:, None], s.shape)
            hist[at] += np.bincount((rows * n_bins + b)[ok], minlength=len(s) * n_bins).reshape(len(s), n_bins)
        above = np.cumsum(hist[:, ::-1], 1)[:, ::-1] - hist
        rows, bins = np.nonzero((hist > 0) & (above < wave.left[:, None]))
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(bins), pa.array(hist[rows, bins])], ["query", "bin", "n"])

    return run


def refine(wave: Wave, rows: DataFrame) -> None:
    """One round: count in bins over all vectors, and narrow each query's range to the bin of its k-th score."""
    step = -(-wave.width // BINS)
    sums = rows.mapInArrow(_count(wave, step), "query long, bin long, n long").groupBy("query", "bin").agg(F.sum("n").alias("n"))
    left = F.element_at(F.lit(wave.left.tolist()), (F.col("query") + 1).cast("int"))
    down = Window.partitionBy("query").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    reached = sums.withColumn("above", F.coalesce(F.sum("n").over(down), F.lit(0))).withColumn("left", left).where("above < left")
    # one row per query of the wave
    for q, b, above in reached.groupBy("query").agg(F.min("bin"), F.max("above")).toPandas().itertuples(index=False):
        wave.low[q] += b * step
        wave.left[q] -= above
    wave.width = step


def _filter(wave: Wave, k: int):
    """What scores more than the k-th score, and the k smallest ids of a task that score the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ties: dict[int, list[int]] = {}
        for at, ids, s, other in wave.scores(batches):
            least = wave.low[at]
            rows, cols = np.nonzero((s > least[:, None]) & other)
            yield pa.RecordBatch.from_arrays([pa.array(wave.rows[at][rows]), pa.array(ids[cols].astype(np.int64)), pa.array(s[rows, cols])], ["no", "vec_id", "score"])
            same = (s == least[:, None]) & other
            for r in np.flatnonzero(same.any(1)).tolist():
                ties[at.start + r] = sorted(ties.get(at.start + r, []) + ids[same[r]].tolist())[:k]
        flat = [(int(wave.rows[i]), v, int(wave.low[i])) for i, vs in ties.items() for v in vs]
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in flat], pa.int64()) for j in range(3)], ["no", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, asks: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64, wave_size: int = WAVE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other ``vectors`` for each row of them that ``asks``."""
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, asks, id_col, vec_col, scale)
    asked = rows.where("asks").select("no", "vec_id", "dim", "q", "top", F.pmod(F.xxhash64("no"), F.lit(1 << 20)).alias("part"))
    folder = f"{work_dir(spark)}/hits"
    spark.createDataFrame([], HITS).write.parquet(folder)
    for dim, n, top in asked.groupBy("dim").agg(F.count("*"), F.max("top")).collect():  # a row per vector length
        same = rows.where(F.col("dim") == dim)
        bound = int(dim * top * (same.agg(F.max("top")).first()[0] or 0)) + 1
        if bound >= 1 << 62:
            raise ValueError("the scores may not fit in 64 bits")
        scanned, waves = same.select("no", "vec_id", "q"), -(-n // wave_size)
        for w in range(waves):
            part = asked.where((F.col("dim") == dim) & (F.col("part") % waves == w)).select("no", "q").toPandas()  # about wave_size rows
            if len(part):
                wave = Wave(part["no"].to_numpy(np.int64), np.frombuffer(b"".join(part["q"]), "<i8").reshape(len(part), -1), bound, k)
                while wave.width > 1:
                    refine(wave, scanned)
                scanned.mapInArrow(_filter(wave, k), HITS).write.mode("append").parquet(folder)
    best = Window.partitionBy("no").orderBy(F.desc("score"), "vec_id")
    ranked = spark.read.schema(HITS).parquet(folder).withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    return ranked.join(asked.select("no", F.col("vec_id").alias("query_id")), "no").select("query_id", "rank", "vec_id", "score")
