"""Suffix-array dedup: remove every byte that a repeated 200-byte string covers.

All suffixes of a corpus cannot meet in one place, so they are first dealt out
such that equal 200-byte windows always meet: a window's anchor is its leftmost
k-gram of least hash, and the windows of one anchor occurrence make one string
of up to 368 bytes, keyed by the anchor's hash. Anchors that occur once can
hold no repeated window and go. Equal strings, by a 128-bit cryptographic digest,
are one with a count.

All strings that are left are compared by column-wise construction over each
task's strings: each round inserts one symbol of every string into the
collection's positional Burrows-Wheeler transform and updates what neighbours
have in common. Equal windows lie alike about their anchors, so the strings are
aligned by these and a round costs no more than its column. The columns are a
file of the task's own, read front to back. A window is repeated if, in the round
that ends it, its string agrees with a neighbour over the last 200 columns, or
stands for several.

An anchor may have very many different strings (the ends of a passage that a
large part of all documents share). Such strings are cut by where their windows
start, in blocks of starts, and dealt by the bytes that all windows of a block
have in common; pieces that have become equal are one again. Blocks get smaller
until no group is large; those of a single start cannot be, as its windows are
then all the same. So every group is compared by the same rounds, none is large,
and a string is in a bounded number of them.

Defined results: null and empty texts and those below 200 bytes lose nothing;
matches never cross documents and may overlap; strings are judged on the input;
rows that repeat a document count as places of their own; an empty table gives
an empty table; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import discard, save, ship, slices

WINDOW, GRAM = 200, 32
#: Bytes whose windows get their anchors together: few enough that a core's cache holds what is computed of them.
BLOCK = 1 << 16
#: Different strings of a group beyond which it is split, and the blocks of window starts by which it is, one after another.
GROUP, STARTS = 1024, (32, 8, 2, 1)
#: Bytes of strings that are put in order together.
COLLECTION = 4 << 20
#: Packing of a run's place: first window, the anchor's offset from it, number of windows.
_OFFSET, _FIRST = 512, 512 * 512
_U = np.uint64


class Roll:
    """Polynomial hashes modulo 2**64 of any substrings of a block, from prefix sums; they choose anchors and decide nothing."""

    def __init__(self, base: int, size: int):
        inverse = pow(base, -1, 1 << 64)
        self.up, self.down = (np.concatenate([[_U(1)], np.cumprod(np.full(size, x, _U), dtype=_U)]) for x in (base, inverse))

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, _U)
        terms = data.astype(_U)
        terms += _U(1)
        terms *= self.up[: len(data)]
        np.cumsum(terms, out=out[1:])
        return out

    def of_all(self, data: np.ndarray, size: int) -> np.ndarray:
        """Of every substring of ``size`` bytes."""
        sums = self.sums(data)
        h = sums[size:] - sums[:-size]
        h *= self.down[: len(h)]
        return _mix(h)


def _mix(h: np.ndarray) -> np.ndarray:
    """In place."""
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(29)
    h *= _U(0xA24BAED4963EE407)
    return h


@functools.lru_cache(maxsize=1)
def rolling() -> Roll:
    return Roll(0x9E3779B97F4A7C15, BLOCK + WINDOW)


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(x) - width + 1
    full = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    full[: len(x)] = x
    rows = full.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def runs(texts: list[bytes], window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text number, first window, anchor's offset from it, number of windows, anchor hash) of every run of windows with one anchor."""
    lengths = np.array([len(t) for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    whole = np.frombuffer(b"".join(texts), np.uint8)
    roll = rolling()
    parts = []
    for at in range(0, len(whole) - window + 1, BLOCK):
        data = whole[at : at + BLOCK + window - 1]
        grams = roll.of_all(data, gram)
        places = _U((1 << 21) - 1)
        placed = grams & ~places
        placed |= np.arange(len(grams), dtype=_U)
        anchor = (sliding_min(placed, window - gram + 1) & places).astype(np.int64)
        n = len(anchor)
        cut = np.zeros(n, bool)
        cut[0] = True
        cut[1:] = anchor[1:] != anchor[:-1]
        for edge in (offsets[:-1], offsets[1:] - window + 1):  # a text's first window; its first that would cross its end
            low, high = np.searchsorted(edge, (at + 1, at + n))
            cut[edge[low:high] - at] = True
        start = np.flatnonzero(cut)
        stop = np.append(start[1:], n)
        text = np.searchsorted(offsets, start + at, "right") - 1
        inside = start + at + window <= offsets[text + 1]
        start, stop, text = start[inside], stop[inside], text[inside]
        parts.append((text, start + at - offsets[text], anchor[start] - start, stop - start, grams[anchor[start]]))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, _U))
    return tuple(map(np.concatenate, zip(*parts)))


def repeated_windows(strings: list[bytes], anchors: list[int], counts: list[int], window: int = WINDOW) -> list[np.ndarray]:
    """For each string, which of its windows another string has at the same place from its anchor, or it has more than once.

    The strings are laid under each other by their anchors. Round after round one
    more column comes in, a symbol of every string: ``order`` sorts the strings by
    what they hold so far, read from the newest column back (so the symbols, in
    order, are the column's part of the transform), and ``since`` is the column
    from which a string agrees with the one before it. A stable sort by the new
    symbols gives the next order; among equal symbols, strings agree since the
    latest column among those between them.
    """
    n, anchors = len(strings), np.array(anchors, np.int64)
    lengths = np.array([len(s) for s in strings], np.int64)
    first = (int(anchors.max()) if n else 0) - anchors  # the column of a string's first byte
    width = int((first + lengths).max(initial=0))
    if not width:
        return [np.zeros(0, bool)] * n
    marks = np.zeros((width, n), bool)  # by the column in which a window starts
    marks[:, np.array(counts) > 1] = True
    with tempfile.TemporaryFile(prefix="columns-") as file:  # has no name, so it goes with the task
        # one row per column; byte + 1 (255 is no byte of UTF-8), 0 where a string is not there
        columns = np.memmap(file, np.uint8, "w+", shape=(width, n))
        for i, s in enumerate(strings):
            columns[first[i] : first[i] + len(s), i] = np.frombuffer(s, np.uint8) + 1
        order, since = np.arange(n), np.zeros(n, np.int64)
        for c in range(width):
            symbol = columns[c, order]
            sort = np.argsort(symbol, kind="stable")
            symbol = symbol[sort]
            new = np.full(n, c + 1)
            k = np.flatnonzero((symbol[1:] == symbol[:-1]) & (symbol[1:] > 0)) + 1
            if len(k):
                low, high = sort[k - 1] + 1, sort[k] + 1
                down = np.argsort(-low, kind="stable")
                pairs = np.stack([low[down], high[down]], 1).ravel()
                new[k[down]] = np.maximum.reduceat(np.append(since, 0), pairs)[::2]
            order, since = order[sort], new
            start = c + 1 - window
            if start >= 0:
                k = np.flatnonzero(since <= start)
                k = k[k > 0]
                marks[start, order[k]] = marks[start, order[k - 1]] = True
        del columns
    return [np.array(marks[f : f + max(0, m - window + 1), i]) for i, (f, m) in enumerate(zip(first.tolist(), lengths.tolist()))]


def _intervals(mask: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edge[::2].tolist(), edge[1::2].tolist()


def _bytes(texts: pa.Array) -> list[bytes]:
    return pc.fill_null(texts.cast(pa.binary()), b"").to_pylist()


def _occurrences(docs: DataFrame) -> DataFrame:
    """h (anchor), d (digest of the string), r (row), at (first window, anchor's offset and number of windows, packed) of every run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                texts = _bytes(part.column(1))
                text, at, off, n, h = runs(texts)
                d = [digest(texts[t][a : a + m + WINDOW - 1]) for t, a, m in zip(text.tolist(), at.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(d, pa.binary()), part.column(0).take(pa.array(text)), pa.array(at * _FIRST + off * _OFFSET + n)], ["h", "d", "r", "at"])

    return docs.select("r", "text").mapInArrow(run, "h long, d binary, r binary, at long")


def _batch(rows: list[tuple], names: str, *kinds: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names.split())


STRINGS = "g long, d binary, n long, off int, bytes binary"


def _cut_out(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of chosen strings, from the rows that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, 1 << 20):
                out = []
                for data, picks in zip(_bytes(part.column(0)), part.column(1).to_pylist()):
                    for p in picks:
                        start, off, n = p["at"] // _FIRST, p["at"] // _OFFSET % _OFFSET, p["at"] % _OFFSET
                        out.append((p["h"], p["d"], p["n"], off, data[start : start + n + WINDOW - 1]))
                yield _batch(out, "g d n off bytes", pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.binary())

    listed = wanted.groupBy("r").agg(F.collect_set(F.struct("h", "d", "n", "at")).alias("picks"))
    once = docs.select("r", "text").join(listed, "r").select("text", "picks")
    return save(once.mapInArrow(run, STRINGS), "strings")


def _by_columns(strings: DataFrame) -> DataFrame:
    """g, d, low, high: the repeated windows (from low to below high) of strings that meet in groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None  # (g, d, count, offset, bytes)

        def settle() -> pa.RecordBatch:
            marks = repeated_windows([x[4] for x in held], [x[3] for x in held], [x[2] for x in held])
            out = [(x[0], x[1], *_intervals(m)) for x, m in zip(held, marks) if m.any()]
            held.clear()
            return _batch(out, "g d low high", pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[-1][:2] == row[:2]:  # equal rows have cut out the same
                    continue
                if size >= COLLECTION and row[0] != last:  # groups are never torn apart
                    yield settle()
                    size = 0
                held.append(row)
                size, last = size + len(row[4]), row[0]
        if held:
            yield settle()

    n = max(1, int(strings.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return strings.select("g", "d", "n", "off", "bytes").repartition(n, "g").sortWithinPartitions("g", "d").mapInArrow(run, "g long, d binary, low array<int>, high array<int>")


def _split(strings: DataFrame, starts: int) -> DataFrame:
    """Pieces of strings by blocks of window starts: g, d, n, off, bytes of the piece, of_g, of_d and skip (windows before it) of its string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                out = []
                for g, d, n, off, data in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns)):
                    m = len(data) - WINDOW + 1
                    for block in range(-off // starts, (m - 1 - off) // starts + 1):
                        low, high = max(0, block * starts + off), min(m, (block + 1) * starts + off)
                        # all windows that start in the block hold these bytes
                        core = data[(block + 1) * starts - 1 + off : block * starts + off + WINDOW]
                        name = int.from_bytes(digest(f"{g} {block} ".encode() + core)[:8], "little", signed=True)
                        piece = data[low : high + WINDOW - 1]
                        out.append((name, digest(b"%d " % (low - off) + piece), n, off - low, piece, g, d, low))
                yield _batch(out, "g d n off bytes of_g of_d skip", pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.int32())

    pieces = strings.select("g", "d", "n", "off", "bytes").mapInArrow(run, STRINGS + ", of_g long, of_d binary, skip int")
    return save(pieces, "pieces")


def _repeats(strings: DataFrame, group: int, starts: tuple[int, ...]) -> DataFrame:
    """g, d, low, high of all strings (g, d, n, off, bytes): groups of up to ``group`` by columns, larger ones after a split."""
    kinds = strings.groupBy("g").agg(F.count("*").alias("kinds"))
    large = save(kinds.where(F.col("kinds") > group).select("g"), "large")
    if not starts or large.isEmpty():
        return _by_columns(strings)
    pieces = _split(strings.join(large, "g", "left_semi"), starts[0])
    merged = save(pieces.groupBy("g", "d").agg(F.sum("n").alias("n"), F.first("off").alias("off"), F.first("bytes").alias("bytes")), "merged")
    inner = save(_repeats(merged, group, starts[1:]), "inner")
    back = inner.join(pieces.select("g", "d", "of_g", "of_d", "skip"), ["g", "d"])
    moved = back.select(F.col("of_g").alias("g"), F.col("of_d").alias("d"), *[F.transform(c, lambda x: x + F.col("skip")).alias(c) for c in ("low", "high")])
    joined = moved.groupBy("g", "d").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("low", "high")])
    return _by_columns(strings.join(large, "g", "left_anti")).unionByName(joined)


def removed_spans(docs: DataFrame, group: int = GROUP, starts: tuple[int, ...] = STARTS) -> DataFrame:
    """(r, spans): the byte ranges of each row ``r`` that repeated windows cover, as (first window, last window + 1) pairs."""
    ship(docs.sparkSession)
    # saved, so that texts are hashed once
    every = save(_occurrences(docs), "occurrences")
    # anchors that occur more than once; saved, so that Spark can split the join's skewed keys
    again = save(every.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "again")
    shared = save(every.join(again, "h", "left_semi"), "shared")
    discard(every, again)
    # the place of one occurrence stands for all
    strings = shared.groupBy("h", "d").agg(F.count("*").alias("n"), F.first(F.struct("r", "at")).alias("one"))
    cut = _cut_out(docs, strings.select("h", "d", "n", "one.r", "one.at"))
    found = save(_repeats(cut, group, starts), "found")
    hits = shared.join(found.withColumnRenamed("g", "h"), ["h", "d"])
    start = F.shiftright("at", 18)
    spans = F.transform(F.arrays_zip("low", "high"), lambda x: F.struct((start + x["low"]).alias("low"), (start + x["high"]).alias("high")))
    return hits.select("r", F.explode(spans).alias("s")).groupBy("r").agg(F.collect_set("s").alias("spans"))


def dedup(docs: DataFrame, group: int = GROUP, starts: tuple[int, ...] = STARTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes) of every row."""
    # a row is known by half of a SHA-256 of its id and text; equal rows have equal results
    whole = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(" "), F.coalesce("text", F.lit("")))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.unhex(F.substring(F.sha2(whole, 256), 1, 32)).alias("r"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                rows = []
                for data, low, high in zip(_bytes(part.column(1)), *(c.to_pylist() for c in part.columns[2:])):
                    edge = np.zeros(len(data) + 1, np.int32)
                    if low:
                        np.add.at(edge, np.array(low), 1)
                        np.add.at(edge, np.array(high) + WINDOW - 1, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    a, b = _intervals(gone)
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                    rows.append((len(data), len(data) - len(kept), len(a), kept))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary())))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    rows = keyed.join(removed_spans(keyed, group, starts), "r", "left").select("doc_id", "text", "spans.low", "spans.high")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
