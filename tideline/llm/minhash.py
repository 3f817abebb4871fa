"""MinHash near-dedup with an LSH forest over sets of word shingles.

Texts with the same set are one node from the start, so copies cost nothing
further. A node's signature holds, for each of ``FUNCTIONS`` hash functions, 16
bits of the least hash in its set; two signatures agree in a place as often as
their sets are similar. A tree of the forest is one order of the signature's
places (each begins ``FUNCTIONS / TREES`` places after the one before): sorted by
it, similar nodes are neighbours with a long common prefix. A region of a tree is
what shares a prefix, of three places at first. Where more than ``leaf`` nodes
share it, that region alone goes deeper, and so on; the rest of the tree stays
shallow. A crowd that goes deeper stays in touch: one node of each part it falls
into meets those of the other parts. Where these, or nodes with all places equal,
are more than ``leaf``, buckets are dealt by hash, and one node of each is taken on.

In a region, nodes meet their neighbours first, and pairs whose signatures agree
often enough are proposed as a spanning forest. What is proposed is confirmed on
the full sets, in three steps that each leave less to do: the first two trees'
likeliest pairs; then those of all trees that join what is not yet joined; then
every pair of a region that is still apart, as a pair that failed may have hidden
another. These are compared in the region by their sets' ``SKETCH`` least hashes
(all of them, for most texts) before full sets are moved. No pair is dropped for number. A pair of similarity 0.85 shares a region
of three places in some tree but for 2 in 10 million; in a region that had to go
deeper it is found less often (0.85 to the power of the depth, in each of 16 trees),
but there is joined by more ways. README has figures.

Sets are of 64-bit hashes of shingles: of two texts with 20,000 words each, two
shingles are taken for equal with a chance of 2 in 100 billion.

Defined results: null, empty and blank texts have an empty set and are linked
with nothing; fewer words than a shingle make one shingle of all; whole texts are
read; repeated rows get the same component; rows without a doc_id, or with the
same, are told apart by their texts; a component is called by its smallest
doc_id, null only if all are null; an empty table gives an empty table; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from math import sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import components, discard, save, ship, shuffled, slices

SEED, SHINGLE, PERCENT = 42, 5, 85
FUNCTIONS, TREES = 128, 16
DEPTHS = (3, 4, 6, 8, 11, 15, 20, 27, 36, 50, 70, 98, FUNCTIONS)
LEAF = 1000
#: Least hashes of a set that a region's pairs are compared by before full sets are.
SKETCH = 1024
_RANDOM = np.random.default_rng(7).integers(0, 1 << 64, (2, FUNCTIONS), np.uint64)
XOR, ODD = _RANDOM[0], _RANDOM[1] | np.uint64(1)
_FOLD, _END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _WordHashes(dict):
    """Hashes of words met lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 60_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return h


_HASHES = _WordHashes()


def shingles(text: str | None, words: int = SHINGLE) -> np.ndarray:
    """Hashes of the different shingles of a whole text, in order; of fewer words, one of them all."""
    w = (text or "").encode().lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, w), np.uint64, len(w))
    size = min(words, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        out = (out ^ h[k : len(h) - size + 1 + k]) * _FOLD
        out ^= out >> np.uint64(29)
    return np.unique((out ^ out >> np.uint64(32)) * _END)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 16-bit values per set (none of them empty)."""
    every, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    out, work = np.empty((len(sets), FUNCTIONS), np.uint16), np.empty_like(every)
    for f in range(FUNCTIONS):
        np.bitwise_xor(every, XOR[f], out=work)
        np.multiply(work, ODD[f], out=work)
        out[:, f] = np.minimum.reduceat(work, starts) >> np.uint64(20) & np.uint64(0xFFFF)
    return out


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def sketches(docs: DataFrame, words: int = SHINGLE, fingerprint: Callable[[str | None], int] | None = None) -> DataFrame:
    """doc_id, text_hash, n_words, n_shingles, digest of the set, and signature (both null for an empty set) of every whole text.

    With ``fingerprint``, also fp: its 64 bits as a signed long.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, 1 << 18):
                texts = part.column(2).to_pylist()
                sets = [shingles(t, words) for t in texts]
                full = [s for s in sets if len(s)]
                rows = iter(signatures(full)) if full else iter(())
                digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                sigs = [next(rows).tobytes() if len(s) else None for s in sets]
                n_words = [len(t.split()) if t else 0 for t in texts]
                fp = [pa.array(np.array(list(map(fingerprint, texts)), np.uint64).view(np.int64))] if fingerprint else []
                columns = [*part.columns[:2], pa.array(n_words, pa.int64()), pa.array(list(map(len, sets)), pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary()), *fp]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_words", "n_shingles", "digest", "sig", "fp"][: len(columns)])
            pa.default_memory_pool().release_unused()  # workers stay for the next stage
        _HASHES.clear()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text")).alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, n_words long, n_shingles long, digest binary, sig binary" + ", fp long" * bool(fingerprint))


def number_sets(own: DataFrame) -> DataFrame:
    """A row per different set of ``sketches``, saved: no, digest, sig, n_words, first (of the row that stands for it: none, doc_id, text_hash), fp if given."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    least = [F.min(c).alias(c) for c in ("n_words", "fp") if c in own.columns]
    each = own.where("digest IS NOT NULL").groupBy("digest").agg(F.first("sig").alias("sig"), *least, first)
    return save(each.select(F.monotonically_increasing_id().alias("no"), "*"), "nodes")


def _dealt(rows: DataFrame, leaf: int) -> list[DataFrame]:
    """tree, key, no in regions of about ``leaf`` nodes at most: larger ones are dealt over buckets by hash, and one node of each bucket is dealt again."""
    found = []
    while True:
        sizes = save(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
        found.append(rows.join(shuffled(sizes).where(F.col("n") <= leaf), "key", "left_semi").select("tree", "key", "no"))
        crowded = sizes.where(F.col("n") > leaf)
        if crowded.isEmpty():
            return found
        bucket = F.pmod(F.xxhash64("no"), F.ceil(2 * F.col("n") / leaf))
        dealt = save(rows.join(crowded, "key").select("tree", F.xxhash64("key", bucket).alias("key"), "no", F.col("key").alias("of")), "dealt")
        found.append(dealt.select("tree", "key", "no"))
        rows = save(dealt.groupBy("tree", "key", "of").agg(F.min("no").alias("no")).select("tree", F.xxhash64("of", F.lit(1)).alias("key"), "no"), "of_buckets")


def regions(nodes: DataFrame, scopes: DataFrame, leaf: int = LEAF) -> DataFrame:
    """tree, key, no: the nodes of every region with several, saved; only nodes of one scope (no, scope) meet."""
    ways = scopes.select("no", "scope", F.lit(None).cast("long").alias("parent"))
    twice = nodes.select("no", F.concat("sig", "sig").alias("twice"))
    found, left = [], []
    for depth in DEPTHS:
        prefix = F.col("twice").substr(F.col("tree") * (2 * FUNCTIONS // TREES) + 1, F.lit(2 * depth))
        placed = shuffled(ways).join(twice, "no")
        if depth == DEPTHS[0]:  # exploded here, as a join takes the rows of all trees for as small as those of one
            placed = placed.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))))
        now = save(placed.select("no", "scope", "tree", "parent", F.xxhash64("scope", "tree", prefix).alias("key")), "level")
        if depth > DEPTHS[0]:  # what a crowd parts into stays in touch
            left.append(now.groupBy("tree", "parent", "key").agg(F.min("no").alias("no")).select("tree", F.xxhash64("parent", F.lit(0)).alias("key"), "no"))
        sizes = save(now.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
        found.append(save(now.join(shuffled(sizes).where(F.col("n") <= leaf), "key", "left_semi").select("tree", "key", "no"), "regions"))
        crowded = sizes.where(F.col("n") > leaf)
        if crowded.isEmpty():
            break
        ways = save(now.join(crowded, "key", "left_semi").select("no", "scope", "tree", F.col("key").alias("parent")), "ways")
    else:
        left.append(ways.select("tree", F.col("parent").alias("key"), "no"))
    if left:
        found += _dealt(save(reduce(DataFrame.unionByName, left), "left"), leaf)
    return reduce(DataFrame.unionByName, found)


def _join(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs that join two parts, one a part at a time; ``label`` is brought up to date."""
    kept = [(i[:0], j[:0])]
    while len(i := i[apart := label[i] != label[j]]):
        j = j[apart]
        high, low = np.maximum(label[i], label[j]), np.minimum(label[i], label[j])
        roots, first = np.unique(high, return_index=True)
        label[roots] = low[first]
        kept.append((i[first], j[first]))
        while (label[label] != label).any():
            label[:] = label[label]
    return np.concatenate([k[0] for k in kept]), np.concatenate([k[1] for k in kept])


def _agree(sig: np.ndarray, i: np.ndarray, step: int) -> np.ndarray:
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), 1 << 14):
        part = i[at : at + (1 << 14)]
        out[at : at + (1 << 14)] = (sig[part] == sig[part + step]).sum(1)
    return out


def _lists(column: pa.ListArray) -> np.ndarray:
    """An array of arrays: views of the column's values, which stay eight bytes each."""
    out, ends = np.empty(len(column), object), np.cumsum(pc.list_value_length(column).to_numpy())
    for i, values in enumerate(np.split(column.flatten().to_numpy(), ends)[: len(column)]):
        out[i] = values
    return out


class _Regions:
    """Whole regions out of batches of rows sorted by key and, in it, by their tree's order."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.batches = batches

    def __iter__(self) -> Iterator[list]:
        held = None
        for batch in self.batches:
            new = [c.to_numpy() for c in batch.columns[:4]] + [np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint16).reshape(-1, FUNCTIONS)]
            new += [_lists(batch.column(5))] if batch.num_columns > 5 else []
            held = [np.concatenate(x) for x in zip(held, new)] if held else new
            n = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last region may go on
            if n:
                yield [h[:n] for h in held]
                held = [h[n:] for h in held]
        if held:
            yield held


def _pairs_of(tree: np.ndarray, no: np.ndarray, i: np.ndarray, j: np.ndarray, likely: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(tree[i]), pa.array(np.minimum(no[i], no[j])), pa.array(np.maximum(no[i], no[j])), pa.array(likely)], ["tree", "a", "b", "likely"])


def _propose(likely: float, least: float):
    """A spanning forest of each region's pairs with signatures that agree in ``least`` places, likely ones first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, tree, no, _, sig in _Regions(batches):
            label, kept = np.arange(len(no)), [(np.zeros(0, np.int64),) * 2]
            for floor in (likely, least):
                step = 1
                while step < len(no) and len(i := np.flatnonzero(key[step:] == key[:-step])):
                    i = i[label[i] != label[i + step]]
                    i = i[_agree(sig, i, step) >= floor]
                    kept.append(_join(label, i, i + step))
                    step += 1
            i, j = (np.concatenate([k[side] for k in kept]) for side in (0, 1))
            yield _pairs_of(tree, no, i, j, (sig[i] == sig[j]).sum(1) >= likely)

    return run


def _as_similar(a: set, b: set, share: float, whole: bool) -> bool:
    """Of whole sets, whether their similarity is ``share``; of their least hashes, whether that is not ruled out."""
    if whole:
        both = len(a & b)
        return both >= share * (len(a) + len(b) - both) - 1e-9
    k = min(len(a), len(b))
    union = sorted(a | b, key=lambda x: x % 2**64)[:k]  # hashes are unsigned
    return len(a.intersection(union) & b) >= k * share - 4.5 * sqrt(k * share * (1 - share))


def _complete(least: float, share: float):
    """All of a region's pairs with different roots that may be similar, by their least hashes; one that surely is joins its roots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, tree, no, root, sig, least_hashes in _Regions(batches):
            _, first, label = np.unique(np.stack([key, root]), axis=1, return_index=True, return_inverse=True)
            label, sets, kept, step = first[label.ravel()], {}, [], 1
            while step < len(no) and len(i := np.flatnonzero(key[step:] == key[:-step])):
                i = i[label[i] != label[i + step]]
                for x in i[_agree(sig, i, step) >= least].tolist():
                    y = x + step
                    if label[x] != label[y]:
                        a, b = (sets.get(z) or sets.setdefault(z, set(least_hashes[z].tolist())) for z in (x, y))
                        whole = max(len(a), len(b)) < SKETCH
                        if _as_similar(a, b, share, whole):
                            kept.append((x, y))
                            if whole:
                                label[label == max(label[x], label[y])] = min(label[x], label[y])
                step += 1
            i, j = np.array(kept, np.int64).reshape(-1, 2).T
            yield _pairs_of(tree, no, i, j, np.ones(len(i), bool))

    return run


PAIRS = "tree int, a long, b long, likely boolean"


def _regions_with(found: DataFrame, known: DataFrame, *more: str) -> DataFrame:
    """The rows of regions, with what is known of their nodes (no, root, sig), dealt by region and in its tree's order."""
    n_parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.concat("sig", "sig").substr(F.col("tree") * (2 * FUNCTIONS // TREES) + 1, F.lit(2 * FUNCTIONS))
    rows = found.join(known.hint("merge"), "no").select("key", "tree", "no", "root", order.alias("sig"), *more)
    return rows.repartition(n_parts, "key").sortWithinPartitions("key", "sig")


def sets_of(docs: DataFrame, wanted: DataFrame, words: int = SHINGLE) -> DataFrame:
    """no, set: the shingles of the texts that stand for the wanted nodes, saved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                sets = [shingles(t, words).view(np.int64) for t in part.column(1).to_pylist()]
                ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets)))], ["no", "set"])

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_hash(F.col("text")).alias("h"), "text")
    same = F.col("id").eqNullSafe(F.col("first.doc_id")) & (F.col("h") == F.col("first.text_hash"))
    once = rows.join(wanted.select("no", "first"), same).select("no", "text").mapInArrow(run, "no long, set array<long>")
    return save(once.dropDuplicates(["no"]), "sets")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough, saved."""
    both = F.size(F.array_intersect("set_a", "set_b"))
    a, b = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")
    rows = shuffled(pairs).join(a, "a").join(b, "b")
    return save(rows.where(100 * both >= percent * (F.size("set_a") + F.size("set_b") - both)).select("a", "b"), "links")


def links(nodes: DataFrame, docs: DataFrame, scopes: DataFrame | None = None, percent: int = PERCENT, words: int = SHINGLE, leaf: int = LEAF) -> DataFrame:
    """(a, b) of nodes with 100 * intersection >= ``percent`` * union: enough of them to join all that such pairs join."""
    ship(nodes.sparkSession)
    s = percent / 100
    likely, least = s * FUNCTIONS, s * FUNCTIONS - 4.5 * sqrt(s * (1 - s) * FUNCTIONS)
    scopes = nodes.select("no", F.lit(0).cast("long").alias("scope")) if scopes is None else scopes
    found = regions(nodes, scopes, leaf)
    proposed = save(_regions_with(found, nodes.select("no", F.col("no").alias("root"), "sig")).mapInArrow(_propose(likely, least), PAIRS), "proposed")
    ends = save(proposed.select(F.explode(F.array("a", "b")).alias("no")).distinct(), "ends")
    sets = sets_of(docs, nodes.join(shuffled(ends), "no"), words)
    first = save(proposed.where("tree < 2 AND likely").select("a", "b").distinct(), "first")
    linked, tried = _confirm(first, sets, percent), first

    def still_apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
        of = [roots.select(F.col("id").alias(x), F.col("root").alias(f"root_{x}")) for x in ("a", "b")]
        both = pairs.join(of[0], "a", "left").join(of[1], "b", "left")
        return both.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")

    roots = components(linked)
    second = save(still_apart(proposed.select("a", "b").distinct(), roots).join(shuffled(tried), ["a", "b"], "left_anti"), "second")
    more = _confirm(second, sets, percent)
    linked, tried = linked.unionByName(more), tried.unionByName(second)
    roots = components(roots.toDF("a", "b").unionByName(more))  # goes on from what is joined
    # nodes that were never proposed have no pair at all
    known = nodes.join(sets.select("no", F.slice("set", 1, SKETCH).alias("least")), "no").join(roots.withColumnRenamed("id", "no"), "no", "left").select("no", F.coalesce("root", "no").alias("root"), "sig", "least")
    rest = _regions_with(found, known, "least").mapInArrow(_complete(least, s), PAIRS).select("a", "b").distinct()
    third = save(rest.join(shuffled(tried), ["a", "b"], "left_anti"), "third")
    linked = save(linked.unionByName(_confirm(third, sets, percent)), "linked")
    discard(sets, proposed, ends, first, second, third)
    return linked


def near_groups(docs: DataFrame, percent: int = PERCENT, words: int = SHINGLE, leaf: int = LEAF) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    own = save(sketches(docs, words), "own")
    nodes = number_sets(own)
    roots = components(links(nodes, docs, None, percent, words, leaf)).select(F.col("id").alias("no"), "root")
    members = save(nodes.join(roots, "no", "left").select("digest", F.coalesce("root", "no").alias("root"), F.col("first.doc_id").alias("best")), "members")
    best = members.groupBy("root").agg(F.min("best").alias("component_id"))
    named = members.join(best.hint("merge"), "root").select("digest", "component_id")
    rows = own.join(named.hint("merge"), "digest", "left").select("doc_id", "n_shingles", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
