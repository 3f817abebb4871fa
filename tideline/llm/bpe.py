"""Byte-level BPE encoding and decoding by a table of byte prefixes.

For every prefix of a byte string exactly one token can end it: the last token
of that prefix's own encoding. ``PrefixTable`` holds that token for each prefix.
The entry for a prefix follows from shorter prefixes alone: of the vocabulary
tokens that are suffixes of the prefix, it is the one that may stand after the
entry of what precedes it. Two tokens may stand side by side when merging their
joint bytes never crosses the border between them. So appending bytes extends
the table exactly, and after an edit only entries near the edit change.

Spark partitions the documents; a task encodes one text at a time, each match
of the split pattern separately, and remembers the ids of pieces it has met
(a memo of two generations, bounded in bytes, which changes nothing but speed).

Defined results: a null or empty text has no tokens, ids and decoded bytes are
empty; very long texts are encoded whole; repeated rows give repeated results;
an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import ship, slices

FOREVER = 1 << 40


class ByteBPE:
    """A vocabulary of byte strings with merge ranks; ranks are the ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = 24 << 20):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        #: Bytes of pieces, ids and their objects that a generation of the memo holds.
        self.memo_size = memo
        self.longest = max(map(len, ranks), default=1)
        # ids of pieces met since the last change of generations, and of those met before it
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._held = 0
        self._fits: dict[int, bool] = {}
        self._edges: dict[int, tuple[list, list]] = {}
        halves = {i: self._halves(b) for b, i in ranks.items()}
        self.halves = {i: h for i, h in halves.items() if h}
        #: Every suffix of a token -> the token's id, or -1 where it is no (reachable) token.
        self.tails: dict[bytes, int] = {}
        for b, i in ranks.items():
            for k in range(1, len(b)):
                self.tails.setdefault(b[k:], -1)
            if len(b) == 1 or i in self.halves:
                self.tails[b] = i
            else:
                self.tails.setdefault(b, -1)

    def merge(self, data: bytes, below: int = FOREVER) -> list[bytes]:
        """Plain BPE: join the leftmost pair of least rank, again and again."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, k = min((self.ranks.get(parts[i] + parts[i + 1], FOREVER), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _halves(self, token: bytes) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None if merging never makes it."""
        if len(token) == 1:
            return None
        parts = self.merge(token, self.ranks[token])
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None

    def _edge(self, token: int) -> tuple[list, list]:
        """(id, rank that swallows it) of the pieces that show at the right and at the left edge, oldest first."""
        found = self._edges.get(token)
        if found is None:
            sides = []
            for side in (1, 0):
                chain, t, end = [], token, FOREVER
                while True:
                    chain.append((t, end))
                    if t not in self.halves:
                        break
                    end, t = t, self.halves[t][side]
                sides.append(chain[::-1])
            found = self._edges[token] = (sides[0], sides[1])
        return found

    def fits(self, a: int, b: int) -> bool:
        """Whether the encoding of the joint bytes of tokens a and b is [a, b]."""
        key = a << 32 | b
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > 400_000:
                self._fits.clear()
            known = self._fits[key] = self._holds(a, b)
        return known

    def _holds(self, a: int, b: int) -> bool:
        left, right, i, j = self._edge(a)[0], self._edge(b)[1], 0, 0
        ranks, bytes_of = self.ranks, self.bytes_of
        while True:
            (x, x_end), (y, y_end) = left[i], right[j]
            joint = ranks.get(bytes_of[x] + bytes_of[y])
            # of merges of one rank the leftmost goes first
            if joint is not None and joint < x_end and joint <= y_end:
                return False
            if x_end == y_end == FOREVER:
                return True
            if x_end <= y_end:
                i += 1
            else:
                j += 1

    def extend(self, data: bytes, last: list[int], start: int, stop: int | None = None) -> None:
        """Work out the entries of the prefixes data[:i] for every i above ``start``, up to ``stop``.

        Entry i is the one token that ends the encoding of data[:i]: a token that
        is a suffix of it and fits behind the entry of what precedes.
        """
        tails, known = self.tails.get, self._fits.get
        for i in range(start + 1, (len(data) if stop is None else stop) + 1):
            for low in range(i - 1, -1, -1):
                t = tails(data[low:i])
                if t is None:
                    raise ValueError("the vocabulary lacks single bytes")
                if t >= 0:
                    if not low:
                        last.append(t)
                        break
                    ok = known(last[low] << 32 | t)
                    if ok or ok is None and self.fits(last[low], t):
                        last.append(t)
                        break

    def encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of different pieces.

        In sorted order a piece shares a prefix with the one before it, whose
        table entries up to there hold for it as well.
        """
        table, out = PrefixTable(self), {}
        for data, piece in sorted((p.encode(), p) for p in pieces):
            whole = self.ranks.get(data)
            if whole is None:
                table.turn_into(data)
                ids = table.ids()
                out[piece] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                out[piece] = struct.pack("<I", whole)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        split = [self.pattern.findall(t) for t in texts]
        known, new = {}, []
        young, old = self._young.get, self._old.get
        for piece in set().union(*split):
            found = young(piece) or old(piece)
            if found is None:
                new.append(piece)
            else:
                known[piece] = found
        known |= self.encode_pieces(new)
        # pieces that come again go on to the next generation, the others leave with the one after
        for piece, ids in known.items():
            if len(piece) <= 64 and piece not in self._young:
                self._young[piece] = ids
                self._held += 150 + len(piece) + len(ids)
                if self._held > self.memo_size:
                    self._old, self._young, self._held = self._young, {}, 0
        ids = known.__getitem__
        return [b"".join(map(ids, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class PrefixTable:
    """The last token of every prefix of one piece; grows by append, heals after edits."""

    def __init__(self, bpe: ByteBPE, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        n, self.data = len(self.data), self.data + more
        self.bpe.extend(self.data, self.last, n)

    def turn_into(self, data: bytes) -> None:
        """Keep the entries of the prefix shared with ``data``; extend from there."""
        n = 0
        for a, b in zip(self.data, data):
            if a != b:
                break
            n += 1
        del self.last[n + 1 :]
        self.data = data
        self.bpe.extend(data, self.last, n)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of data[start:stop]; returns how many entries were worked out again.

        Entries up to ``start`` stay. Beyond the new bytes, once as many entries
        in a row as the longest token has bytes are as they were, so is the rest.
        """
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last, same = old[: start + 1], 0
        for i in range(start + 1, len(self.data) + 1):
            self.bpe.extend(self.data, self.last, i - 1, i)
            t = self.last[i]
            if i > start + len(new):
                same = same + 1 if old[i - shift] == t else 0
                if same >= self.bpe.longest:
                    self.last += old[i - shift + 1 :]
                    return i - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        out, i = [], len(self.data)
        while i:
            out.append(self.last[i])
            i -= len(self.bpe.bytes_of[out[-1]])
        return out[::-1]


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Lines of base64 token and rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


@functools.lru_cache(maxsize=2)
def load(raw: bytes, pattern: str) -> ByteBPE:
    """One vocabulary per worker process."""
    return ByteBPE(read_ranks(raw), pattern)


SCHEMA = "doc_id long, n_tokens long, ids binary"


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) of every whole text; with ``decoded``, also the bytes these ids decode to.

    Decoding in the same pass spares a second set of workers with a vocabulary each.
    """
    ship(docs.sparkSession)
    with open(ranks_path, "rb") as f:
        raw = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(raw, pattern)
        for batch in batches:
            for part in slices(batch, 1):
                ids = bpe.encode([t or "" for t in part.column(1).to_pylist()])
                more = [pa.array(list(map(bpe.decode, ids)), pa.binary())] if decoded else []
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), *more], ["doc_id", "n_tokens", "ids", "decoded"][: 3 + decoded])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA + ", decoded binary" * decoded)


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Adds ``decoded`` (bytes) to rows of ``encode_documents``."""
    ship(encoded.sparkSession)
    with open(ranks_path, "rb") as f:
        raw = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(raw, pattern)
        for batch in batches:
            for part in slices(batch, 2):
                decoded = [bpe.decode(x or b"") for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], ["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, SCHEMA + ", decoded binary")


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and of the bytes decoded from them."""
    rows = encode_documents(docs, ranks_path, pattern, decoded=True)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
