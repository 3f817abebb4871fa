"""SimHash near-dedup with pivot distance tables.

Fingerprints: a text's bit is 1 where over half of its shingles' hashes have it.
Equal fingerprints are one from then on, so copies cost nothing further.

Pivots are reference fingerprints: zero, the 64 fingerprints of one bit, and some
random ones; the table holds each fingerprint's Hamming distance to every pivot.
By the triangle inequality, two fingerprints at most ``radius`` apart have no
coordinate that differs by more than ``radius``: pairs with a larger difference
are discarded, survivors are verified by their exact distance.

Which pairs meet is decided by coordinates too. The coordinate to a one-bit pivot
and that to zero together tell the bit, so fingerprints agree in a band of such
coordinates just when their bits under the band's mask are equal. The 64 are dealt
into ``radius`` + 3 bands; at most ``radius`` flips touch at most ``radius`` of
them, so every close pair agrees on all bands but some choice of ``radius``: for
each choice, those that agree on the others form a cell. Cells of up to ``leaf``
fingerprints are compared in a task, which reports no pairs but a spanning forest
of the close ones. A larger cell (a dense cloud of near copies) is never compared
whole; the bands left open are dealt into ``radius`` + 3 finer ones, and so on. Few
open bits allow few fingerprints, so this ends, and however large a cloud is, a
fingerprint meets a bounded number of others.

Components come from alternating large-star and small-star steps, each saved.

In the words of candidate search: bands of bits propose, the pivot table discards
of what they propose (12 of 23 pairs at a scale of 0.1), exact distance verifies.

``first_of_groups`` keeps one row of each group of near copies. It checks what
fingerprints propose by the texts' shingles, so unlike texts stay.

Defined results: null, empty and blank texts have fingerprint zero and link like
any other; fewer words than a shingle make one shingle of all; whole texts are
read; repeated rows get the same component; the fingerprints are what is linked,
so rows without a doc_id, or with the same, are grouped by their texts like any
other; a component is called by its smallest doc_id, null only if all are null
(where doc_ids repeat, components can share a name); an empty table gives an
empty table; extra columns are ignored by ``near_groups`` and kept by
``first_of_groups``.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm import minhash
from tideline.llm.common import components, discard, fresh, save, ship, slices
from tideline.llm.minhash import text_hash

SEED, SHINGLE, RADIUS = 42, 3, 2
#: A cell with more fingerprints than this times the choices of bands is split: about where comparing costs more than splitting.
LEAF = 50
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED, distinct: bool = False) -> int:
    """Words are counted in blocks, so that memory does not grow with the number of shingles (but with that of different ones, if ``distinct``)."""
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hash_of, join = xxhash.xxh64_intdigest, b" ".join
    starts = range(max(1, len(w) - shingle + 1))
    if distinct:
        w = list(set(w)) if shingle == 1 else list({join(w[i : i + shingle]) for i in starts})
        starts, shingle = range(len(w)), 1
    n, ones = len(starts), np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        h = np.array([hash_of(join(w[i : i + shingle]), seed) for i in starts[at : at + (1 << 16)]], np.uint64)
        octets = h.astype(">u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            ones[8 * k : 8 * k + 8] += np.bincount(octets[:, k], minlength=256) @ _BITS
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, distinct: bool = False) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every whole text."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                fp = np.array([fingerprint(t.as_py(), shingle, seed, distinct) for t in part.column(1)], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def random_pivots(n: int, seed: int = 1) -> list[int]:
    rnd = random.Random(seed)
    return [rnd.getrandbits(64) for _ in range(n)]


PIVOTS = np.array([0, *(1 << i for i in range(64)), *random_pivots(8)], np.uint64)


def pivot_table(fp: np.ndarray) -> np.ndarray:
    """Distances of fingerprints (rows) to the pivots (columns)."""
    return np.bitwise_count(fp.view(np.uint64)[:, None] ^ PIVOTS).astype(np.int8)


def finer(open_bits: int, radius: int = RADIUS) -> list[int]:
    """The masks that stay open when all but ``radius`` bands of the open bits must agree."""
    bits = [i for i in range(64) if open_bits >> i & 1]
    bands = [sum(1 << i for i in bits[b :: radius + 3]) for b in range(radius + 3)]
    return [sum(chosen) for chosen in combinations(bands, radius)]


def _join(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs that join two parts; ``label`` (the smallest member of each row's part) is brought up to date."""
    kept: list[tuple] = [(i[:0], j[:0])]
    while len(i := i[apart := label[i] != label[j]]):
        j = j[apart]
        high, low = np.maximum(label[i], label[j]), np.minimum(label[i], label[j])
        roots, first = np.unique(high, return_index=True)
        label[roots] = low[first]
        kept.append((i[first], j[first]))
        while (label[label] != label).any():
            label[:] = label[label]
    return np.concatenate([k[0] for k in kept]), np.concatenate([k[1] for k in kept])


def _compare(radius: int):
    """A spanning forest of the close pairs in each cell; cells come whole and in order."""

    def forest(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        beside = np.append(key[1:] == key[:-1], False)
        shared = beside | np.append(False, beside[:-1])  # most cells hold one fingerprint
        key, fp = key[shared], fp[shared]
        near, label, kept, step = pivot_table(fp), np.arange(len(fp)), [], 1
        while step < len(fp) and len(i := np.flatnonzero(key[step:] == key[:-step])):
            i = i[label[i] != label[i + step]]
            i = i[np.abs(near[i + step] - near[i]).max(1, initial=0) <= radius]
            i = i[np.bitwise_count((fp[i] ^ fp[i + step]).view(np.uint64)) <= radius]
            kept.append(_join(label, i, i + step))
            step += 1
        a, b = (fp[np.concatenate([k[side] for k in kept])] if kept else fp[:0] for side in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 2
        for batch in batches:
            held = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns)]
            # the last cell may go on
            n = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if n:
                yield forest(*(h[:n] for h in held))
                held = [h[n:] for h in held]
        yield forest(*held)

    return run


def links(fps: DataFrame, radius: int = RADIUS, leaf: int | None = None) -> DataFrame:
    """(a, b), a < b, of distinct fingerprints (``fp``): pairs at most ``radius`` apart, enough of them to join all that such pairs join."""
    spark, n_parts = fps.sparkSession, int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ship(spark)
    leaf = leaf or LEAF * comb(radius + 3, radius)
    dealt = lambda df, name: save(df.repartition(n_parts), name)  # noqa: E731  not by fp, which Spark would join into few tasks again: a row becomes one per choice of bands
    now, masks, found = dealt(fps.select("fp", F.lit(-1).cast("long").alias("open")), "fps"), [(1 << 64) - 1], []
    while masks:
        split = spark.createDataFrame([(_signed(m), [_signed(x) for x in finer(m, radius)]) for m in masks], "open long, to array<long>")
        # a row per mask: their number is fixed by the radius and the level
        keyed = now.join(F.broadcast(split), "open").select("fp", F.explode("to").alias("open"))
        if found:  # one finer mask may come of several
            keyed = keyed.distinct()
        keyed = keyed.withColumn("key", F.xxhash64("open", F.col("fp").bitwiseAND(F.bitwise_not("open"))))
        crowded = save(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > leaf).select("key"), "crowded")
        none = crowded.isEmpty()
        few = keyed if none else keyed.join(crowded, "key", "left_anti")
        found.append(save(few.select("key", "fp").repartition(n_parts, "key").sortWithinPartitions("key", "fp").mapInArrow(_compare(radius), "a long, b long"), "links"))
        if none:
            break
        now = dealt(keyed.join(crowded, "key", "left_semi").select("fp", "open"), "crowd")
        masks = [r["open"] % (1 << 64) for r in now.select("open").distinct().collect()]  # masks of one level
        if any(m.bit_count() <= radius for m in masks):
            raise ValueError("leaf is too small")
    return reduce(DataFrame.unionByName, found)  # one table per level


def near_groups(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id of every row."""
    own = save(fingerprints(docs, shingle, seed), "own")
    fps = save(own.groupBy("fp").agg(F.min("doc_id").alias("best")), "fps")
    roots = components(links(fps.select("fp"), radius)).select(F.col("id").alias("fp"), "root")
    members = save(fps.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "best"), "members")
    best = members.groupBy("root").agg(F.min("best").alias("component_id"))
    groups = members.select("fp", "root").join(best.hint("merge"), "root").select("fp", "component_id")
    return own.join(groups.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def first_of_groups(docs: DataFrame, shingle: int = 1, seed: int = SEED, radius: int = 6, distinct: bool = True, similarity: float = 0.8, words: int = 5, short: int = 128) -> DataFrame:
    """One row of ``docs`` of each group: that with the smallest doc_id (null last), then the smallest hash of its text.

    Texts with the same set of ``words``-word shingles are copies. Between others
    fingerprints only propose: those that chains of fingerprints at most
    ``radius`` apart join, and those that share one, are compared by their
    shingles' signatures (see ``minhash.links``) and linked if their full sets
    are as similar as ``similarity``. Of texts of fewer than ``short`` words, one
    word alters the fingerprint by too many bits, so these are all compared with
    one another by signatures. By default fingerprints are those of a text's
    different words: a changed word alters one of these but several longer
    shingles, so near copies lie closer.
    The rows that go are few and small beside the texts, so it is they that are
    listed and left out; texts move only where even that list is too large to
    broadcast.
    """

    def own_fingerprint(text: str | None) -> int:
        return fingerprint(text, shingle, seed, distinct)

    own = save(minhash.sketches(docs, words, own_fingerprint).withColumn("digest", F.coalesce("digest", F.lit(b""))), "own")
    nodes = minhash.number_sets(own)
    full = nodes.where("sig IS NOT NULL")
    near = components(links(full.select("fp").distinct(), radius)).select(F.col("id").alias("fp"), "root")
    scopes = full.join(near, "fp", "left").select("no", F.xxhash64(F.lit(1), F.coalesce("root", "fp")).alias("scope"))
    several = scopes.groupBy("scope").agg(F.count("*").alias("n")).where("n > 1")
    scopes = scopes.join(several.hint("merge"), "scope", "left_semi").select("no", "scope")
    small = full.where(F.col("n_words") < short).select("no", F.lit(0).cast("long").alias("scope"))
    linked = minhash.links(full, docs, save(scopes.unionByName(small), "scopes"), round(100 * similarity), words)
    roots = components(linked).select(F.col("id").alias("no"), "root")

    members = save(nodes.join(roots, "no", "left").select("digest", F.coalesce("root", "no").alias("root"), "first"), "members")
    best = members.groupBy("root").agg(F.min("first").alias("best"))
    chosen = members.select("digest", "root").join(best.hint("merge"), "root").select("digest", "best")
    each = own.groupBy("digest", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))
    gone, h = fresh(docs.columns, "gone_id", "gone_hash")
    listed = save(each.join(chosen.hint("merge"), "digest").select(F.col("doc_id").alias(gone), F.col("text_hash").alias(h), "n", stays.alias("stays")), "listed")
    discard(own, nodes, members, linked)
    left = docs.join(listed.where("NOT stays").select(gone, h), F.col("doc_id").cast("long").eqNullSafe(F.col(gone)) & (text_hash(F.col("text")) == F.col(h)), "left_anti")
    if listed.where("stays AND n > 1").isEmpty():
        return left
    # rows that repeat a doc_id and its text: one of them stays
    marked = left.select("*", F.col("doc_id").cast("long").alias(gone), text_hash(F.col("text")).alias(h))
    return marked.dropDuplicates([gone, h]).drop(gone, h)
