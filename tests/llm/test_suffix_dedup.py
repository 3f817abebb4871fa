import collections
import hashlib
import random
import re

import numpy as np

from tests.llm.helpers import AWKWARD, docs
from tideline.llm import suffix_dedup as sd


def brute(rows):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = collections.Counter(t[i : i + 200] for _, t in texts for i in range(len(t) - 199))
    out = []
    for i, t in texts:
        mark = bytearray(len(t))
        for k in range(len(t) - 199):
            if seen[t[k : k + 200]] > 1:
                mark[k : k + 200] = b"\x01" * 200
        kept = bytes(x for x, m in zip(t, mark) if not m)
        out.append((i, len(t), sum(mark), len(re.findall(b"\x01+", bytes(mark))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def ours(spark, rows, **options):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in sd.dedup(docs(spark, rows), **options).collect()), key=repr)


def passages(seed, n=60):
    rnd = random.Random(seed)
    line = lambda k: " ".join(f"{rnd.choice('abcdefgh')}{rnd.randrange(10**5)}é" for _ in range(k))
    shared = [line(30), line(45), line(8)]
    return [(i, line(rnd.randrange(40)) + "".join(rnd.choice(shared)[rnd.randrange(20) :] + line(5) for _ in range(rnd.randrange(4))) + ("ab " * rnd.randrange(200))) for i in range(n)]


def test_against_brute_force(spark):
    assert ours(spark, passages(1)) == brute(passages(1))
    assert ours(spark, AWKWARD) == brute(AWKWARD)
    assert ours(spark, []) == []


def test_large_groups(spark):
    """Groups are split by blocks of window starts, down to a single start; the result is the same."""
    rows = passages(2) + [(1000 + i, passages(2)[5][1] + f"{i % 40} and so on, text {i * i} " * 8) for i in range(80)]
    want = brute(rows)
    assert ours(spark, rows, group=2) == want
    assert ours(spark, rows, group=2, starts=(1,)) == want


def test_strings_on_which_polynomial_hashes_agree(spark):
    """Thue-Morse words and their complements have equal polynomial hashes modulo 2**64 for any base, but share no window."""
    word = [0]
    while len(word) < 2048:
        word += [1 - x for x in word]
    a, b = ("".join("ab"[x ^ flip] for x in word) for flip in (0, 1))
    assert ours(spark, [(1, "p" * 60 + a[:1024] + "q" * 60), (2, "p" * 60 + b[:1024] + "q" * 60)]) == brute([(1, "p" * 60 + a[:1024] + "q" * 60), (2, "p" * 60 + b[:1024] + "q" * 60)])
    head = "some common words stand before, " * 2
    rows = [(1, head + a[:256] + head), (2, head + b[:256] + head)]
    assert ours(spark, rows) == brute(rows)


def test_columns_find_repeats():
    rnd = random.Random(3)
    for _ in range(100):
        base = bytes(rnd.choice(b"ab\xf0") for _ in range(60))
        strings, anchors = [], []
        for _ in range(rnd.randrange(1, 12)):
            i = rnd.randrange(30)
            s = bytearray(base[i : rnd.randrange(31, 60)])
            for _ in range(rnd.randrange(3)):
                s[rnd.randrange(len(s))] = ord("c")
            strings.append(bytes(s)), anchors.append(30 - i)
        w = rnd.choice([3, 5, 8])
        counts = [rnd.choice([1, 1, 1, 4]) for _ in strings]
        seen = collections.Counter()
        for s, a, n in zip(strings, anchors, counts):
            for i in range(len(s) - w + 1):
                seen[i - a, s[i : i + w]] += n
        for s, a, got in zip(strings, anchors, sd.repeated_windows(strings, anchors, counts, w)):
            assert got.tolist() == [seen[i - a, s[i : i + w]] > 1 for i in range(max(0, len(s) - w + 1))]


def test_every_window_is_in_one_run():
    rnd = random.Random(4)
    texts = [bytes(rnd.choice(b"abc ") for _ in range(n)) for n in (0, 199, 200, 201, 5000, 0, 777)] + [b"ab" * 3000]
    text, start, off, n, h = sd.runs(texts)
    assert ((off >= 0) & (off <= sd.WINDOW - sd.GRAM + n)).all()
    for k, t in enumerate(texts):
        cover = np.zeros(max(0, len(t) - 199), int)
        for s, m in zip(start[text == k], n[text == k]):
            cover[s : s + m] += 1
        assert (cover == 1).all()


def test_anchors_of_one_pass_over_the_texts(spark, monkeypatch):
    """Anchors are those of any block size, and texts are hashed once (twice before)."""
    rnd = random.Random(8)
    texts = ["".join(rnd.choice("abé ") for _ in range(rnd.randrange(900))) for _ in range(40)] + [None, "", "a" * 5000]
    data = [(t or "").encode() for t in texts]

    def anchors(block):
        monkeypatch.setattr(sd, "BLOCK", block)
        sd.rolling.cache_clear()
        out = [(t, a + k, a + off, h) for t, a, off, n, h in zip(*(x.tolist() for x in sd.runs(data))) for k in range(n)]
        monkeypatch.undo()
        sd.rolling.cache_clear()
        return out

    assert anchors(700) == anchors(1 << 20)
    passes, kind = [], type(spark.range(1))
    run = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, f, schema, *a, **b: passes.append(schema) or run(self, f, schema, *a, **b))
    sd.removed_spans(docs(spark, list(enumerate(texts))).selectExpr("cast(cast(doc_id as string) as binary) r", "text"))
    assert sum(str(x).startswith("h long") for x in passes) == 1
