"""Token counts of documents in flat, unindexed token files, by scanning for separators.

A token file is nothing but identifiers (little-endian, of a fixed width), with
an end-of-document identifier behind each document. Files are cut into blocks of
fixed size. A task loads a block as an array, finds all separators at once and
gives the lengths between them; the first is wanting what earlier blocks hold of
that document. A prefix scan over the block sums (separators, tokens behind the
last one) of each file supplies it, and the documents' numbers. Only those sums,
one small row a block, are ordered per file.

Files are read and written through pyarrow's file systems, by the URI of the
folder, so tasks need no local copies.

Defined results: a document may be empty (two separators in a row); tokens behind
a file's last separator are a document of their own, marked as not ended; a file
of no tokens has no documents; an empty table makes files without documents; null
texts are empty documents.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.bpe import read_ranks
from tideline.llm.common import save, ship, slices, work_dir

#: Tokens in a block.
BLOCK = 4 << 20


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


@functools.lru_cache(maxsize=2)
def _tokenizer(raw: bytes, pattern: str):
    import tiktoken

    return tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=read_ranks(raw), special_tokens={})


def write_flat(docs: DataFrame, folder: str, ranks_path: str, pattern: str, end_id: int, width: int = 2) -> DataFrame:
    """Tokenise whole texts into flat files, one a task; returns (file, place, doc_id), saved.

    A file gets a name of its own for every attempt, and counts only if the
    attempt's rows were committed, so lost executors leave no document twice. A
    separator that is a token, or identifiers beyond the width, are refused.
    """
    ship(docs.sparkSession)
    with open(ranks_path, "rb") as f:
        raw = f.read()
    taken = read_ranks(raw).values()
    if end_id in taken or max(end_id, *taken) >= 1 << 8 * width:
        raise ValueError(f"the separator {end_id} is a token, or an identifier is wider than {width} bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = _tokenizer(raw, pattern), end_id.to_bytes(width, "little")
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        name, place = f"{uuid.uuid4().hex}.tok", 0
        with fs.open_output_stream(f"{base}/{name}") as out:
            for batch in batches:
                for part in slices(batch, 1):
                    for t in part.column(1):
                        out.write(np.array(enc.encode_ordinary(t.as_py() or ""), f"<u{width}").tobytes() + end)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * part.num_rows, pa.string()), pa.array(np.arange(place, place + part.num_rows)), part.column(0)], ["file", "place", "doc_id"])
                    place += part.num_rows

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "file string, place long, doc_id long")
    return save(rows, "placed")


def count_flat(spark: SparkSession, folder: str, end_id: int, width: int = 2, block: int = BLOCK, pattern: str = "*.tok") -> DataFrame:
    """file, place, n_tokens, ended: one row per document of the flat files in ``folder``."""
    ship(spark)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.floor(F.col("length") / width).alias("n"))
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(block).cast("long")))
    blocks = listed.where("n > 0").select("file", "n", cut.alias("at")).select("file", "at", F.least(F.lit(block), F.col("n") - F.col("at")).alias("n"))
    n_parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        for batch in batches:
            for file, at, n in zip(*(c.to_pylist() for c in batch.columns)):
                with fs.open_input_file(f"{base}/{file}") as f:
                    f.seek(at * width)
                    tokens = np.frombuffer(f.read(n * width), f"<u{width}")
                ends = np.flatnonzero(tokens == end_id)
                lengths = np.diff(ends, prepend=-1) - 1
                tail = len(tokens) - (ends[-1] + 1 if len(ends) else 0)
                k = len(ends)
                # k = -1: the block's sums
                yield pa.RecordBatch.from_arrays([pa.array([file] * (k + 1), pa.string()), pa.array(np.full(k + 1, at)), pa.array(np.append(np.arange(k), -1)), pa.array(np.append(lengths, tail)), pa.array(np.full(k + 1, k))], ["file", "at", "k", "length", "n_ends"])

    found = save(blocks.repartition(n_parts, "file", "at").mapInArrow(scan, "file string, at long, k long, length long, n_ends long"), "blocks")
    order = Window.partitionBy("file").orderBy("at")
    upto, earlier = order.rowsBetween(Window.unboundedPreceding, Window.currentRow), order.rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        found.where("k = -1")
        .select("file", "at", "n_ends", F.col("length").alias("tail"))
        .withColumn("run", F.sum(F.when(F.col("n_ends") > 0, 1).otherwise(0)).over(upto))
        # tokens behind the last separator so far, over the blocks without one
        .withColumn("open", F.sum("tail").over(Window.partitionBy("file", "run").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("carry", F.coalesce(F.lag("open").over(order), F.lit(0)))
        .withColumn("before", F.coalesce(F.sum("n_ends").over(earlier), F.lit(0)))
        .withColumn("last", F.lead("at").over(order).isNull())
    )
    ended = found.where("k >= 0").join(sums.select("file", "at", "carry", "before"), ["file", "at"]).select("file", (F.col("before") + F.col("k")).alias("place"), (F.col("length") + F.when(F.col("k") == 0, F.col("carry")).otherwise(0)).alias("n_tokens"), F.lit(True).alias("ended"))
    rest = sums.where("last AND open > 0").select("file", (F.col("before") + F.col("n_ends")).alias("place"), F.col("open").alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.unionByName(rest)


def document_tokens(docs: DataFrame, ranks_path: str, pattern: str, end_id: int, width: int = 2, block: int = BLOCK) -> DataFrame:
    """doc_id, n_tokens: flat files are made of ``docs``, then counted by scanning them."""
    spark = docs.sparkSession
    folder = f"{work_dir(spark)}/flat"
    placed = write_flat(docs, folder, ranks_path, pattern, end_id, width)
    if placed.isEmpty():
        return placed.select("doc_id", F.lit(0).cast("long").alias("n_tokens"))
    return count_flat(spark, folder, end_id, width, block).join(placed, ["file", "place"]).select("doc_id", "n_tokens")
