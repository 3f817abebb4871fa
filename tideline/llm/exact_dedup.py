"""Exact dedup by an extendible-hash index on shared files.

A text's key is the 64-bit hash of its normalised form. The directory maps the
leading bits of a key to a bucket; it starts with one bucket and, while a bucket
holds more distinct keys than its capacity, doubles and splits it. Buckets are
ranges of keys, and each owner task processes whole buckets in key order: texts
that share a key are chained and told apart by comparing bytes. The index
(bucket, key, place in the chain, digest, who stays, group size) is written to
the shared folder and can be probed again; for ``kept_rows`` an entry holds the
row that stays as well, so texts move once and are joined with nothing.

Before texts move, each task combines equal texts it holds, so a group of copies
of any size reaches its owner as a few texts per task. Owners stream; they keep
only the chain of one key.

Defined results: null counts as empty, and empty texts equal each other; of
equal texts the one with the most code points, then the smallest doc_id (null
last) stays; of rows that repeat that doc_id and length, one stays (for
``kept_rows`` that with the smallest text, then the smallest other columns) and
the others are dropped; an empty table gives an empty table; extra columns,
whatever their names, are ignored by ``dedup`` and kept by ``kept_rows``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import discard, save, ship, slices

CAPACITY = 2048
#: The directory is sent to every task: it has at most this many entries of 4 bytes, and buckets hold more where keys are many.
ENTRIES = 1 << 22
_SEED = 42


def squeeze(text: str) -> bytes:
    """The text without ``[\\x20\\x09-\\x0D]``, in UTF-8; these are what bytes.split() takes for blanks."""
    return b"".join(text.encode().split())


def _key(norm: bytes) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(norm, _SEED)).view(np.int64))


def slim_rows(docs: DataFrame) -> DataFrame:
    """doc_id, key, text_sha256, n_points: what stands for a row beside the index."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                texts = [t or "" for t in part.column(1).to_pylist()]
                norms = [squeeze(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([_key(x) for x in norms], pa.int64()), pa.array([hashlib.sha256(x).digest() for x in norms], pa.binary()), pa.array([len(t) for t in texts], pa.int64())],
                    ["doc_id", "key", "text_sha256", "n_points"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, key long, text_sha256 binary, n_points long")


def directory(keys: DataFrame, capacity: int = CAPACITY, entries: int = ENTRIES) -> np.ndarray:
    """Bucket of each leading bit pattern of a key, by doubling and splitting.

    ``keys`` are distinct. The directory may double until it has eight entries for
    each full bucket that the keys need, so its depth follows their number; beyond
    ``entries`` buckets hold more instead. Only the keys' histogram over the
    leading bits reaches the driver, a bounded number of sums.
    """
    n_keys = keys.count()
    capacity = max(capacity, -(-8 * n_keys // entries))
    max_depth = max(4, (8 * n_keys // capacity).bit_length())
    prefix = F.shiftrightunsigned("key", 64 - max_depth)
    counts = np.zeros(1 << max_depth, np.int64)
    for at, n in keys.groupBy(prefix.alias("p")).count().toPandas().itertuples(index=False):
        counts[at] = n
    table, depth = np.zeros(1, np.int32), 0
    local = {0: 0}  # bucket -> its depth
    while True:
        held = np.bincount(table, weights=counts.reshape(len(table), -1).sum(1), minlength=len(local))
        full = [b for b in local if held[b] > capacity and local[b] < max_depth]
        if not full:
            break
        if any(local[b] == depth for b in full):
            table, depth = np.repeat(table, 2), depth + 1
        at = np.flatnonzero(np.diff(table, prepend=-1))
        first, size = dict(zip(table[at].tolist(), at.tolist())), np.bincount(table, minlength=len(local))
        for b in full:
            new = len(local)
            table[first[b] + size[b] // 2 : first[b] + size[b]] = new
            local[b] += 1
            local[new] = local[b]
    # numbered in key order, so that owners process key ranges
    return np.cumsum(np.diff(table, prepend=table[0]) != 0, dtype=np.int64).astype(np.int32)


def build_index(docs: DataFrame, keys: DataFrame, capacity: int = CAPACITY, entries: int = ENTRIES, with_rows: bool = False) -> DataFrame:
    """The index on shared files: one row per distinct normalised text.

    bucket, key, chain, text_sha256, keep_points, keep_id, group_size; with
    ``with_rows``, also text and rest (the other columns) of the row that stays.
    ``keys`` are the distinct keys of the texts.
    """
    spark = docs.sparkSession
    ship(spark)
    table = directory(keys, capacity, entries)
    n_buckets, depth, raw = int(table[-1]) + 1, len(table).bit_length() - 1, table.tobytes()
    n_owners = max(1, min(n_buckets, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]) if with_rows else F.lit(None)
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").isNull().alias("none"), row.alias("rest"))
    entry = T.StructType.fromDDL("owner int, bucket int, key long, n_points long, doc_id long, n long, text string, none boolean").add("rest", rows.schema["rest"].dataType)
    found = T.StructType.fromDDL("bucket int, key long, chain int, text_sha256 binary, keep_points long, keep_id long, group_size long, text string, none boolean").add("rest", rows.schema["rest"].dataType)

    def better(new: tuple, old: tuple) -> bool:
        """Of (points, doc_id, text, is null, rest)."""
        a, b = (-new[0], new[1] is None, new[1] or 0), (-old[0], old[1] is None, old[1] or 0)
        return a < b or a == b and with_rows and (new[2], new[3], repr(new[4])) < (old[2], old[3], repr(old[4]))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Equal texts of a task become one entry with their number; flushed when many bytes are held, but for frequent texts."""
        to_bucket, held, size, kind = np.frombuffer(raw, np.int32), {}, 0, None

        def flush(least: int) -> Iterator[pa.RecordBatch]:
            out = []
            for norm in [x for x, e in held.items() if e[0] < least]:
                n, (points, doc, text, none, rest) = held.pop(norm)
                key = _key(norm)
                bucket = int(to_bucket[(key & (1 << 64) - 1) >> (64 - depth)])
                out.append((bucket * n_owners // n_buckets, bucket, key, points, doc, n, text if with_rows else norm.decode(), none, rest))
                if len(out) == 500:
                    yield _batch(out, entry, kind)
            if out:
                yield _batch(out, entry, kind)

        for batch in batches:
            kind = batch.schema.field("rest").type
            for part in slices(batch, 0):
                for text, doc, none, rest in zip(*(c.to_pylist() for c in part.columns)):
                    norm, new = squeeze(text), (len(text), doc, text if with_rows else "", none, rest)
                    e = held.get(norm)
                    if e is None:
                        held[norm] = [1, new]
                        size += len(norm) + len(new[2]) + 300
                    else:
                        e[0] += 1
                        if better(new, e[1]):
                            e[1] = new
                if size > 16 << 20:
                    yield from flush(8)
                    size = sum(len(x) + len(e[1][2]) + 300 for x, e in held.items())
                    if size > 8 << 20:
                        yield from flush(1 << 62)
                        size = 0
        yield from flush(1 << 62)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries come in key order: chain those of one key, comparing bytes."""
        now, chain, out, size, kind = None, {}, [], 0, None
        for batch in batches:
            kind = batch.schema.field("rest").type
            for part in slices(batch, 6):
                for _, bucket, key, points, doc, n, text, none, rest in zip(*(c.to_pylist() for c in part.columns)):
                    if now != (bucket, key):
                        size += _close(now, chain, out, with_rows)
                        now = (bucket, key)
                        if len(out) > 1000 or size > 4 << 20:
                            yield _batch(out, found, kind)
                            size = 0
                    norm, new = squeeze(text), (points, doc, text, none, rest)
                    e = chain.get(norm)
                    if e is None:
                        chain[norm] = [n, new]
                    else:
                        e[0] += n
                        if better(new, e[1]):
                            e[1] = new
        _close(now, chain, out, with_rows)
        if out:
            yield _batch(out, found, kind)

    owned = rows.mapInArrow(combine, entry).repartitionById(n_owners, "owner").sortWithinPartitions("bucket", "key")
    index = owned.mapInArrow(own, found)
    return save(index if with_rows else index.drop("text", "none", "rest"), "index")


def _close(now: tuple | None, chain: dict, out: list, with_rows: bool) -> int:
    """Move the chain of a finished key to the output; returns the bytes of its texts."""
    size = 0
    for place, (norm, (n, (points, doc, text, none, rest))) in enumerate(chain.items()):
        out.append((*now, place, hashlib.sha256(norm).digest(), points, doc, n, text if with_rows else "", none, rest))
        size += len(text)
    chain.clear()
    return size


_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: T.StructType, rest: pa.DataType) -> pa.RecordBatch:
    """Rows as a batch; ``rest`` keeps the Arrow type it came with. Empties the list."""
    cols = [pa.array(c, rest if f.name == "rest" else _ARROW[f.dataType.simpleString()]) for c, f in zip(zip(*rows), schema)]
    rows.clear()
    return pa.RecordBatch.from_arrays(cols, schema.names)


def dedup(docs: DataFrame, capacity: int = CAPACITY, entries: int = ENTRIES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    slim = save(slim_rows(docs), "slim")
    index = build_index(docs, slim.select("key").distinct(), capacity, entries)
    # rows that repeat a doc_id, text and length are one here, so that one of them can stay
    rows = slim.groupBy("doc_id", "key", "text_sha256", "n_points").agg(F.count("*").alias("n"))
    joined = rows.join(index.select("key", "text_sha256", "keep_points", "keep_id", "group_size"), ["key", "text_sha256"])
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points"))
    each = joined.withColumn("stays", stays).withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return each.select("doc_id", "keep_id", "group_size", (F.col("stays") & (F.col("i") == 1)).alias("kept"), F.lower(F.hex("text_sha256")).alias("text_sha256"))


def kept_rows(docs: DataFrame, capacity: int = CAPACITY, entries: int = ENTRIES) -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept."""
    keys = save(slim_rows(docs).select("key").distinct(), "keys")
    index = build_index(docs, keys, capacity, entries, with_rows=True)
    discard(keys)
    text = F.when(~F.col("none"), F.col("text")).alias("text")
    return index.select(*[text if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns])
