import random

import numpy as np
import pytest

from tests.llm.helpers import AWKWARD, docs, find_groups, plans_of
from tideline.llm import common, minhash


def brute_set(text, words=5):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute(rows, percent=85):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    sets = [brute_set(r[1]) for r in rows]
    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    like = {i: {j for x in s for j in by[x]} for i, s in enumerate(sets)}
    near = lambda a, b: b in like[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    root = find_groups(len(rows), near)
    return sorted(((r[0], len(s), rows[c][0], r[0] == rows[c][0]) for r, s, c in zip(rows, sets, root)), key=repr)


def check(spark, rows, **options):
    got = minhash.near_groups(docs(spark, rows), **options)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def edited(rnd, words, n):
    w = list(words)
    for _ in range(n):
        w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
    return w


def near_texts(seed, groups, start=1000):
    """Groups of texts of 6 to 600 words with edits that leave similarities on both sides of 0.85."""
    rnd, out = random.Random(seed), []
    for _ in range(groups):
        base = [f"w{rnd.randrange(5000)}" for _ in range(int(6 * 100 ** rnd.random()))]
        for _ in range(rnd.randrange(1, 6)):
            w = edited(rnd, base, rnd.randrange(1 + len(base) // 40))
            out.append(rnd.choice([w, [*w, "more"], w[1:], [x.upper() for x in w]]))
    rnd.shuffle(out)
    return [(start + i, rnd.choice([" ", "  ", "\n"]).join(w)) for i, w in enumerate(out)]


def test_against_brute_force(spark):
    check(spark, [*AWKWARD, *near_texts(1, 150)])


def test_deep_regions_and_small_leaves(spark):
    """Dense clouds around two texts that share a passage: regions go deeper, no link between different texts is lost."""
    rnd = random.Random(3)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for c in range(2):
        base = passage + [f"c{c}w{i}" for i in range(140)]
        rows += [(c * 1000 + i, " ".join(edited(rnd, base, rnd.randrange(4)))) for i in range(150)]
    rows += [(3000 + i, " ".join(passage + [f"u{i}v{k}" for k in range(rnd.randrange(5, 60))])) for i in range(100)]
    check(spark, rows, leaf=60)


def test_many_sets_with_one_signature(spark):
    """Long texts that differ in a word of thousands: more of them than a region may hold."""
    base = [f"w{i}" for i in range(6000)]
    rows = [(i, " ".join([*base[: 100 * i], f"x{i}", *base[100 * i + 1 :]])) for i in range(50)]
    check(spark, rows, leaf=4)


def test_hidden_pair(spark):
    """A pair that fails must not hide another: 1 and 2, 2 and 3 are below the limit, 1 and 3 reach it."""
    base = [f"w{i}" for i in range(100)]
    one, three = base, [*base[:-1], "z"]
    two = [*base[:42], "k", *base[43:80], "m", *base[81:]]
    check(spark, [(1, " ".join(one)), (2, " ".join(two)), (3, " ".join(three)), (4, " ".join([*two, "end"]))])


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for same in (10, 50, 90):
        pool = rng.integers(0, 1 << 63, 300).astype(np.uint64)
        a, b = np.unique(pool[:200]), np.unique(pool[100 - same : 300 - same] if same < 100 else pool[:200])
        want = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        sig = minhash.signatures([a, b])
        assert abs((sig[0] == sig[1]).mean() - want) < 0.15


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (None, "  ")]])
def test_nothing_to_link(spark, rows):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_groups(docs(spark, rows)).collect()}
    assert got == {(r[0], 0, r[0], True) for r in rows}


def test_shingles_are_those_of_the_words():
    for text in ["a", "a b", "A  b\nc", "a b c d e", "a b c d e a b c d e f", "é É x\x0by \xa0"]:
        assert len(minhash.shingles(text)) == len(brute_set(text))
    assert minhash.shingles("A b c").tolist() == minhash.shingles(" a\tb  C").tolist() != minhash.shingles("a b").tolist()


def test_least_hashes_rule_out_only_unlike_sets():
    rng = np.random.default_rng(2)
    for same, want in ((0.7, False), (0.9, True)):
        pool = rng.integers(0, 1 << 64, 20_000, np.uint64)
        n = int(10_000 * 2 * same / (1 + same))
        sets = [np.unique(x).view(np.int64)[: minhash.SKETCH].tolist() for x in (pool[:10_000], pool[10_000 - n : 20_000 - n])]
        assert minhash._as_similar(set(sets[0]), set(sets[1]), 0.85, False) == want
    assert minhash._as_similar(set(range(100)), set(range(85)), 0.85, True) and not minhash._as_similar(set(range(100)), set(range(84)), 0.85, True)


def test_trees_are_exploded_after_the_join(spark, monkeypatch):
    """A join takes exploded rows for as small as they were before, so those of 16 trees would be hashed in the driver."""
    plans = plans_of(monkeypatch, minhash)
    check(spark, near_texts(5, 40))
    assert plans["level"][0].index("Generate") < plans["level"][0].index("Join")


def test_many_ids_are_shuffled(spark, monkeypatch):
    """No table of ids beyond a number of rows is hashed whole, and the groups stay the same."""
    monkeypatch.setattr(common, "FEW", 0)
    plans = plans_of(monkeypatch, minhash, common)
    check(spark, near_texts(6, 40), leaf=20)
    for name in ("level", "regions", "proposed", "second", "members", "large"):
        assert plans[name] and not any("BroadcastHashJoin" in p for p in plans[name])
