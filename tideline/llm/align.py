"""Alignment of two tokenizers' tokens over the same bytes.

Each tokenizer reports spans: character offsets of the byte-level tokenizer's
tokens, and the spans of sentencepiece's immutable result (which the installed
release gives as ``offset_mapping``; it refuses the name ``immutable_proto``).
Spans are coarse cuts: they tell where tokens end only between characters.
Tokens that split a character share its span, or stand at its beginning until
the last of them takes it; between two coarse cuts such ends are refined by the
tokens' decoded bytes. Tokens whose decoded bytes are not those of the text are
no alignment. Byte offsets where tokens of both end cut them into groups, and
the last tokens of a group, which end together, are linked.

A text is encoded in segments: neither tokenizer has a token that crosses from
one to the next, so the tokens are those of the whole text (``Aligner`` proves
the rule for the vocabularies it is given, and encodes whole texts where it does
not hold). Segments met again come from a memo of two generations, bounded in
bytes, which changes nothing but speed. What the corpus counts is joined, never
broadcast, but for the highest count of each token of the second vocabulary.

Defined results: a null or empty text, or one whose tokens of either kind do not
give back its bytes, has no tokens and zeros everywhere; whole texts are read;
repeated rows, and rows that share or lack a doc_id, each count and are returned;
an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import functools
import gc
import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import save, ship, slices

#: Punctuation that ends a word and is cut off from it, where no token joins the two.
TAIL = '.,;:!?&#%*"'
#: A segment begins with white space that follows something else; a carriage return or a rarer space begins none.
_CHUNK = r"\s*\S+(?:(?![ \t\n])\s+\S*)*|\s+"
_TAILS = rf"\s*[^\W_]+(?=[{TAIL}]+(?:[ \t\n]|\Z))|(?<=[^\W_])[{TAIL}]+(?=[ \t\n]|\Z)|"
#: White space to some pattern languages but not to all.
_DOUBTFUL = re.compile("[\x1c-\x1f\x85]")


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary's entries stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def refined(spans: np.ndarray, sizes: np.ndarray, byte_at: np.ndarray) -> np.ndarray:
    """Byte ends of tokens, from the characters they span (start, end) and the sizes of their decoded bytes.

    Where the next token begins with a new character, the span's end is a cut.
    Tokens before it that share its character end by their bytes, counted from
    the cut before.
    """
    start, end = spans[:, 0], spans[:, 1]
    cut = (start < end) & (end <= np.append(start[1:], len(byte_at) - 1))
    by_bytes = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(cut, np.arange(len(sizes)), -1))
    return by_bytes + np.where(last >= 0, (byte_at[end] - by_bytes)[last], 0)


class Aligner:
    """A byte-level tokenizer (a) and a sentencepiece model (b), from the contents of their files."""

    def __init__(self, a_json: bytes, b_model: bytes, memo: int = 48 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json.decode())
        self.a.encode_special_tokens = True  # their strings are text
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(b_model)
        plain = spec.normalizer_spec.add_dummy_prefix and not spec.normalizer_spec.remove_extra_whitespaces and not spec.normalizer_spec.precompiled_charsmap and not spec.trainer_spec.treat_whitespace_as_suffix
        spec.normalizer_spec.add_dummy_prefix = False  # the space ahead of a text is part of what is encoded
        self.b = sentencepiece.SentencePieceProcessor()
        self.b.LoadFromSerializedProto(spec.SerializeToString())
        byte = _byte_of()
        n = self.a.get_vocab_size()
        entry = [self.a.id_to_token(i) or "" for i in range(n)]
        self.a_bytes = [bytes(map(byte.get, e)) if all(c in byte for c in e) else e.encode() for e in entry]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array(list(map(len, x))) for x in (self.a_bytes, self.b_bytes))
        self.a_bytes, self.b_bytes = (np.array([*x, None], object)[:-1] for x in (self.a_bytes, self.b_bytes))
        # may b join a character to what stands after it? (control pieces never come of text)
        joined = {p[k : k + 2] for i, p in enumerate(pieces) if not self.b.is_byte(i) and not self.b.is_control(i) and not self.b.is_unknown(i) for k in range(len(p) - 1)}
        spaced = any(x not in "▁" and not x.isspace() and y in "▁\t\n" for x, y in joined)
        byte_level = [x.get("use_regex", True) and not x.get("add_prefix_space") for x in [json.loads(a_json).get("pre_tokenizer") or {}] if x.get("type") == "ByteLevel"]
        self.cuts = bool(byte_level and byte_level[0] and plain and not spaced and self.a.normalizer is None)
        self.find = re.compile(_CHUNK if any(x.isalnum() and y in TAIL for x, y in joined) else _TAILS + _CHUNK).findall
        most = max(n, len(pieces))
        self.before_comma, self.before_bar, self.before_end = (np.array([f"{i}{c}" for i in range(most)], object) for c in ",|;")
        self.memo_size, self._held = memo, 0
        #: Hashes of segments met once; what comes again is remembered.
        self._once: set[int] = set()
        self._young: dict[str, tuple | None] = {}
        self._old: dict[str, tuple | None] = {}

    def _encode(self, segments: list[str]) -> dict[str, tuple | None]:
        """(tokens of a, of b, groups, groups as text, links) of each segment; None where bytes differ."""
        plain, other = [], []
        for s in segments:
            (plain if s.isascii() else other).append(s)
        return self._cut(plain, True) | self._cut(other, False)

    def _cut(self, segments: list[str], plain: bool) -> dict[str, tuple | None]:
        """Where all characters are ``plain`` bytes, decoded bytes are the spans, which are not asked for."""
        if not segments:
            return {}
        if plain:
            found = [([x.ids for x in self.a.encode_batch_fast(segments, add_special_tokens=False)], None), (self.b.encode(segments, num_threads=1), None)]
        else:
            a = self.a.encode_batch(segments, add_special_tokens=False)
            b = self.b.encode(segments, return_type="offset_mapping", num_threads=1)
            found = [([x.ids for x in a], [x.offsets for x in a]), ([y["ids"] for y in b], [y["offsets"] for y in b])]
        points = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        byte_at = np.append(0, np.cumsum(1 + (points >= 1 << 7) + (points >= 1 << 11) + (points >= 1 << 16)))
        begin = np.cumsum([0, *map(len, segments)])
        data, ids, ends, counts = "".join(segments).encode(), [], [], []
        for (of, spans), raw, size in zip(found, (self.a_bytes, self.b_bytes), (self.a_size, self.b_size)):
            counts.append(np.fromiter(map(len, of), np.int64, len(of)))
            ids.append(np.fromiter(chain.from_iterable(of), np.int64))
            by_bytes = np.append(0, np.cumsum(size[ids[-1]]))
            if (by_bytes[np.cumsum(counts[-1])] != byte_at[begin[1:]]).any() or b"".join(raw[ids[-1]].tolist()) != data:
                # some segment is not what its tokens decode to: each for itself
                if len(segments) == 1:
                    return {segments[0]: None}
                half = len(segments) // 2
                return self._cut(segments[:half], plain) | self._cut(segments[half:], plain)
            if plain:
                ends.append(by_bytes[1:])
            else:
                local = np.fromiter(chain.from_iterable(chain.from_iterable(spans)), np.int64).reshape(-1, 2)
                ends.append(refined(local + np.repeat(begin[:-1], counts[-1])[:, None], size[ids[-1]], byte_at))
        both = np.intersect1d(*ends, assume_unique=True)
        group = [np.searchsorted(both, e) for e in ends]
        last = [both[g] == e for g, e in zip(group, ends)]
        links = (ids[0][last[0]] << 32 | ids[1][last[1]]).tolist()
        words = np.empty(len(ids[0]) + len(ids[1]), object)
        words[np.arange(len(ids[0])) + np.searchsorted(group[1], group[0])] = np.where(last[0], self.before_bar[ids[0]], self.before_comma[ids[0]])
        words[np.arange(len(ids[1])) + np.searchsorted(group[0], group[1], "right")] = np.where(last[1], self.before_end[ids[1]], self.before_comma[ids[1]])
        words = words.tolist()
        to_word = np.cumsum(counts[0] + counts[1]).tolist()
        to_group = (group[0][np.cumsum(counts[0]) - 1] + 1).tolist()
        out: dict[str, tuple | None] = {}
        at = g = 0
        for s, x, y, to, h in zip(segments, counts[0].tolist(), counts[1].tolist(), to_word, to_group):
            out[s] = (x, y, h - g, "".join(words[at:to])[:-1], links[g:h])
            at, g = to, h
        return out

    def align(self, texts: list[str | None]) -> list[tuple[int, int, int, str, dict[int, int]]]:
        """(tokens of a, tokens of b, groups, groups as text, times of each link) of each text."""
        whole = [" " + t if t else "" for t in texts]
        split = [self.find(t) if self.cuts and not _DOUBTFUL.search(t) else [t] * bool(t) for t in whole]
        known, again, new = {}, [], []
        young, old = self._young, self._old
        for s in set().union(*split):
            if s in young:
                known[s] = young[s]
            elif s in old:
                known[s] = old[s]
                again.append(s)
            else:
                new.append(s)
        known |= self._encode(new)
        for s in new:  # met once, it is only marked
            if len(s) <= 64:
                if (h := hash(s)) in self._once:
                    again.append(s)
                else:
                    self._once.add(h)
        for s in again:
            found = self._young[s] = known[s]
            self._held += 500 + len(s) + (len(found[3]) + 40 * found[2] if found else 0)
            if self._held > self.memo_size:
                self._old, self._young, self._held = self._young, {}, 0
        if len(self._once) > 1_000_000:
            self._once.clear()
        out = []
        for text, segments in zip(whole, split):
            parts = [known[s] for s in segments]
            if None in parts:  # what a part alone does not give back, the whole may
                parts = [x for x in self._encode([text]).values()] if len(parts) > 1 else parts
                parts = [] if None in parts else parts
            links = Counter(chain.from_iterable(p[4] for p in parts))
            out.append((sum(p[0] for p in parts), sum(p[1] for p in parts), sum(p[2] for p in parts), ";".join([p[3] for p in parts]), links))
        return out


@functools.lru_cache(maxsize=2)
def load(a_json: bytes, b_model: bytes) -> Aligner:
    # the memo's many small objects make no cycles, and collections over them take a tenth of the time
    gc.set_threshold(500_000, 50, 50)
    return Aligner(a_json, b_model)


SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, groups string, link array<long>, times array<long>"


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, numbers of tokens and groups, the groups as ``a1,a2|b1;a3|b2,b3``, and how often ids are linked (a's id in the upper 32 bits)."""
    ship(docs.sparkSession)
    with open(a_path, "rb") as f, open(b_path, "rb") as g:
        a_json, b_model = f.read(), g.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = load(a_json, b_model)
        for batch in batches:
            for part in slices(batch, 1):
                rows = aligner.align(part.column(1).to_pylist())
                ends = pa.array(np.cumsum([0, *(len(r[4]) for r in rows)]), pa.int32())
                sides = [pa.ListArray.from_arrays(ends, pa.array(np.fromiter(chain.from_iterable(side(r[4]) for r in rows), np.int64))) for side in (dict.keys, dict.values)]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)), pa.array([r[3] for r in rows], pa.string()), *sides], ["doc_id", "n_a", "n_b", "n_groups", "groups", "link", "times"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def score_links(aligned: DataFrame) -> DataFrame:
    """Each row of ``aligned`` with n_links, n_best (links whose count is the highest of their second id) and count_sum, in place of its links."""
    rows = save(aligned.withColumn("no", F.monotonically_increasing_id()), "aligned")
    links = rows.select("no", F.explode(F.arrays_zip("link", "times")).alias("x")).select("no", "x.link", "x.times")
    counts = save(links.groupBy("link").agg(F.sum("times").alias("n")), "counts")
    b = F.col("link").bitwiseAND(0xFFFFFFFF)
    # a row for each entry of the second vocabulary at most
    best = F.broadcast(counts.groupBy(b.alias("b")).agg(F.max("n").alias("most")))
    counts = counts.join(best, b == best["b"]).select("link", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    per = links.join(counts, "link").groupBy("no").agg(F.sum("times").alias("n_links"), F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")]
    return rows.join(per, "no", "left").select(*[c for c in aligned.columns if c not in ("link", "times")], *zero)
