"""Spelling variants: words one edit apart, grouped under their most frequent form.

Neighbours meet by Bloom-guided neighbourhoods. Filters of the vocabulary are
sharded by word length, and blocked: a word sets ``BITS`` bits within one 64-bit
block. They are made by ``bit_or`` over the blocks, and broadcast. Every word
generates its deletions (looked up in the filter of the next shorter length) and
its replacements by a later letter (in its own length's); insertions and
replacements by an earlier letter are the same pairs seen from the other side.
Hashes of edits follow from the word's own by sums over positions, so they are
made and probed as arrays. Only positives are shuffled, to an exact join with
the vocabulary that removes the false ones.

A filter holds at most ``wave`` words: a larger vocabulary is dealt by hash over
several rounds, each with filters of its own, so what is broadcast is bounded
whatever the corpus, and every word is looked up in all of them.

Defined results: a null or empty text has no words; a null doc_id counts as an
empty string in the noise rule; rows that repeat count again; whole texts are
read; ties go to the smaller word by code points; words of any length are
compared; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import discard, save, ship, slices

RUN = "[A-Za-zÀ-ÿ]+"
#: Letters of lower-cased runs; one byte each in Latin-1.
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)
NOISE = 97
BITS, BLOCKS_PER_WORD = 4, 0.5
#: Words whose filters are broadcast at a time (16 MB of blocks).
WAVE = 1 << 22
#: Edits hashed at a time.
EDITS = 1 << 19


def noisy(run: str, start: int) -> str:
    """A lower-cased run; where 97 divides the checksum of id and run, one letter is deleted."""
    h = crc32(run.encode(), start)
    if h % NOISE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, shortest: int = 5, least: int = 3) -> DataFrame:
    """word, n: every word of all whole texts with at least ``shortest`` letters and ``least`` occurrences."""
    ship(docs.sparkSession)
    find = regex.compile(RUN).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                total: Counter[str] = Counter()
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if text:
                        start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                        for w, n in Counter(find(text.encode().lower().decode())).items():  # bytes.lower() knows A-Z only
                            if len(w) >= shortest and len(w := noisy(w, start)) >= shortest:
                                total[w] += n
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    words = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _weights(length: int) -> np.ndarray:
    return _mix(np.arange(1, length + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _letters(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(-1, length).astype(np.uint64)


def word_hash(letters: np.ndarray) -> np.ndarray:
    """Of words (rows) of one length, before mixing: a sum over positions."""
    return (letters * _weights(letters.shape[1])).sum(1, dtype=np.uint64)


def _place(mixed: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and mask of hashes; the upper bits choose the block, six bits each a bit of it."""
    mask = np.zeros(len(mixed), np.uint64)
    for k in range(BITS):
        mask |= np.uint64(1) << (mixed >> np.uint64(6 * k) & np.uint64(63))
    return ((mixed >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64), mask


def _wave_of(mixed: np.ndarray, waves: int) -> np.ndarray:
    return (_mix(mixed + np.uint64(1)) >> np.uint64(32)) % np.uint64(waves)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        yield length, np.flatnonzero(lengths == length)


class Filters:
    """A blocked Bloom filter per word length, of one wave of the vocabulary."""

    def __init__(self, shards: dict[int, np.ndarray], wave: int, waves: int):
        self.shards, self.wave, self.waves = shards, wave, waves

    def holds(self, length: int, hashes: np.ndarray) -> np.ndarray:
        """Whether words of a length with these hashes may be in it."""
        shard = self.shards.get(length)
        if shard is None:
            return np.zeros(hashes.shape, bool)
        mixed = _mix(hashes.ravel())
        block, mask = _place(mixed, len(shard))
        found = shard[block] & mask == mask
        if self.waves > 1:
            found &= _wave_of(mixed, self.waves) == self.wave
        return found.reshape(hashes.shape)


def make_filters(words: DataFrame, wave: int, waves: int) -> Filters:
    sizes = {r["length"]: max(1, int(r["n"] / waves * BLOCKS_PER_WORD)) for r in words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).collect()}  # a row per length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_pylist()
            for length, rows in _by_length(every):
                mixed = _mix(word_hash(_letters([every[i] for i in rows], length)))
                mixed = mixed[_wave_of(mixed, waves) == wave] if waves > 1 else mixed
                block, mask = _place(mixed, sizes[length])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(block), length)), pa.array(block), pa.array(mask.view(np.int64))], ["length", "block", "mask"])

    # half a block a word of the wave at most, so this is bounded
    blocks = words.select("word").mapInArrow(run, "length long, block long, mask long").groupBy("length", "block").agg(F.bit_or("mask").alias("mask")).toArrow()
    length, block, mask = (blocks.column(i).to_numpy() for i in range(3))
    shards = {n: np.zeros(size, np.uint64) for n, size in sizes.items()}
    for n in np.unique(length).tolist():
        at = length == n
        shards[n][block[at]] = mask[at].view(np.uint64)
    return Filters(shards, wave, waves)


def edits(words: list[str], length: int, filters: Filters) -> Iterator[tuple[int, str]]:
    """(which of the words of one length, edited word) for every edit that the filters may hold, each once."""
    letters, weights = _letters(words, length), _weights(length)
    terms = letters * weights
    whole = terms.sum(1, dtype=np.uint64)
    step = max(1, EDITS // max(1, len(words)))
    if filters.shards.get(length - 1) is not None:
        before = np.cumsum(terms, 1, dtype=np.uint64) - terms
        moved = np.zeros_like(letters)
        moved[:, 1:] = letters[:, 1:] * weights[: length - 1]
        after = np.cumsum(moved[:, ::-1], 1, dtype=np.uint64)[:, ::-1] - moved
        found = filters.holds(length - 1, before + after)
        found[:, 1:] &= letters[:, 1:] != letters[:, :-1]  # of a run of one letter any deletion is the same
        for i, p in zip(*(x.tolist() for x in np.nonzero(found))):
            yield i, words[i][:p] + words[i][p + 1 :]
    step = max(1, step // len(ALPHABET))
    for start in range(0, length, step):
        part = letters[:, start : start + step, None]
        new = whole[:, None, None] + (ALPHABET - part) * weights[start : start + step, None]
        found = filters.holds(length, new) & (ALPHABET > part)
        for i, p, c in zip(*(x.tolist() for x in np.nonzero(found))):
            p += start
            yield i, words[i][:p] + chr(int(ALPHABET[c])) + words[i][p + 1 :]


def _probe(filters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for length, rows in _by_length(every):
                rows = rows.tolist()
                size = max(1, EDITS // (len(ALPHABET) * length))
                for at in range(0, len(rows), size):
                    some = rows[at : at + size]
                    found = list(edits([every[i] for i in some], length, filters.value))
                    src = [some[i] for i, _ in found]
                    yield pa.RecordBatch.from_arrays([pa.array([every[i] for i in src], pa.string()), pa.array([n[i] for i in src], pa.int64()), pa.array([e for _, e in found], pa.string())], ["word", "n", "near"])

    return run


def near_words(words: DataFrame, wave: int = WAVE) -> DataFrame:
    """word, n, near, near_n: every two words (of word, n; saved) one edit apart, both ways round."""
    spark = words.sparkSession
    ship(spark)
    waves, found = max(1, -(-words.count() // wave)), []
    for w in range(waves):
        filters = spark.sparkContext.broadcast(make_filters(words, w, waves))
        found.append(save(words.mapInArrow(_probe(filters), "word string, n long, near string"), "positives"))
        filters.unpersist()
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    one = save(reduce(DataFrame.unionByName, found).join(known, "near").select("word", "n", "near", "near_n"), "near")
    discard(*found)
    return one.unionByName(one.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def follow(forms: DataFrame) -> DataFrame:
    """word, root: where the forms (word, form) that follow one another end; each round doubles the way."""
    now = save(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not now.where("moved").isEmpty():
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        # what has reached its end takes no more part
        open_ = now.where("moved").join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        before, now = now, save(open_.unionByName(now.where("NOT moved")), "roots")
        discard(before)
    return now.select("word", "root")


def group_variants(words: DataFrame, wave: int = WAVE, factor: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word (of word, n)."""
    words = save(words, "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    own = near_words(words, wave).groupBy("word").agg(F.count("*").alias("n_near"), best)
    taken = -F.col("best.less") >= factor * F.col("n")
    rows = words.join(own, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n"))
    rows = save(rows, "forms")
    return rows.join(follow(rows.where("form IS NOT NULL")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
