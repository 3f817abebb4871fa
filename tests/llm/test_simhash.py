import random

import numpy as np
import xxhash

from tests.llm.helpers import AWKWARD, docs, find_groups, plans_of
from tideline.llm import common, minhash, simhash


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def check(spark, rows, **options):
    got = {(r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.near_groups(docs(spark, rows), **options).collect()}
    rows = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    fps = [brute_fingerprint(r[1]) for r in rows]
    root = find_groups(len(rows), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    assert {g for g in got if g[0] is not None} == {(r[0], f, rows[c][0]) for r, f, c in zip(rows, fps, root)}


def near_texts(n, seed):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(500)}" for _ in range(150)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rnd.randrange(3)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(9)}"
        out.append((i + 100, " ".join(w)))
    return out


def test_against_brute_force(spark):
    check(spark, AWKWARD)
    check(spark, near_texts(120, 1) + [(i, f"other text number {i} of many words {i * 7}") for i in range(60)])


def test_null_ids_link_others(spark):
    """A text without an id between two others joins them."""
    base = _words(3)
    first = _near_copy(base)
    fp = brute_fingerprint(first)
    second = next(t for t in (" ".join([*base[:-2], f"y{i}", base[-1]]) for i in range(20_000)) if 2 < (brute_fingerprint(t) ^ fp).bit_count() and (brute_fingerprint(t) ^ brute_fingerprint(" ".join(base))).bit_count() <= 2)
    got = {r.doc_id: r.component_id for r in simhash.near_groups(docs(spark, [(1, first), (None, " ".join(base)), (2, second)])).collect()}
    assert got == {1: 1, None: 1, 2: 1}


def same_groups(spark, fps, radius=2, **options):
    """Whether links are close pairs, join what all close pairs join, and are not too many."""
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    got = {(r.a, r.b) for r in simhash.links(df, radius, **options).collect()}
    assert all(a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= radius for a, b in got)
    x = np.sort(np.array([simhash._signed(f) for f in fps]))
    i, j = [], []
    for k in range(len(x)):
        at = k + 1 + np.flatnonzero(np.bitwise_count((x[k + 1 :] ^ x[k]).view(np.uint64)) <= radius)
        i.append(np.full(len(at), k)), j.append(at)
    want, ours = np.arange(len(x)), np.arange(len(x))
    simhash._join(want, np.concatenate(i), np.concatenate(j))
    pairs = np.searchsorted(x, np.array(sorted(got), np.int64).reshape(-1, 2))
    simhash._join(ours, pairs[:, 0], pairs[:, 1])
    assert (want == ours).all()


def test_joining_pairs():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n = int(rng.integers(1, 40))
        i, j = rng.integers(0, n, (2, int(rng.integers(0, 60))))
        label, close = np.arange(n), set(map(tuple, np.stack([i, j], 1).tolist()))
        a, b = simhash._join(label, i, j)
        assert label.tolist() == find_groups(n, lambda x, y: (x, y) in close or (y, x) in close)
        assert len(a) == n - len(set(label.tolist())) and set(zip(a.tolist(), b.tolist())) <= close


def test_any_close_fingerprints_meet(spark):
    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(40)]
    fps = base + [b ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64) for b in base] + [b ^ 7 << rnd.randrange(61) for b in base]
    fps = list(dict.fromkeys(fps))
    for radius in (1, 2, 3):
        same_groups(spark, fps, radius)
    df = spark.createDataFrame([], "fp long")
    assert simhash.links(df).count() == 0


def test_dense_clouds(spark):
    """5,000 fingerprints around one, and all 4,096 over 12 bits: all links are found, by cells that are never paired up whole."""
    rnd = random.Random(6)
    centre, cloud = rnd.getrandbits(64), set()
    while len(cloud) < 5000:
        f = centre
        for _ in range(rnd.randrange(6)):
            f ^= 1 << rnd.randrange(64)
        cloud.add(f)
    for fps in ([f & (1 << 64) - 1 for f in sorted(cloud)], [i << 3 | 1 for i in range(4096)]):
        for leaf in (500, 32):
            same_groups(spark, fps, leaf=leaf)


def test_pivot_table_gives_bits_and_bounds():
    rng = np.random.default_rng(1)
    fp = rng.integers(-(2**63), 2**63 - 1, 200)
    near = simhash.pivot_table(fp)
    bits = (near[:, :1] + 1 - near[:, 1:65]) // 2
    assert (bits == (fp.view(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).astype(int)).all()
    apart = np.bitwise_count((fp[:-1] ^ fp[1:]).view(np.uint64))
    assert (np.abs(near[1:] - near[:-1]).max(1) <= apart).all()


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert {r.root for r in simhash.components(edges).collect()} == {0}


def test_rows_that_stay(spark):
    d = docs(spark, AWKWARD)
    kept = simhash.first_of_groups(d)
    ids = [r.doc_id for r in kept.collect()]
    # of the blank texts one stays, of 5 and 6 (the same words) too, and one 7
    assert kept.columns == d.columns and sorted(ids, key=str) == sorted([1, 4, 5, 7, 8, 9, None, 10, 11], key=str)
    assert simhash.first_of_groups(docs(spark, [])).count() == 0


def test_near_copies_go_and_others_stay(spark, sf_dir):
    """Of all pairs of texts with a similarity of 0.8, at least nine in ten are of one group; nothing goes that is like no other."""
    from tideline.llm import exact_dedup
    from tideline.llm.common import save, table

    d = exact_dedup.kept_rows(table(spark, sf_dir, "documents"))
    rnd, copies = random.Random(8), []
    for r in d.where("length(text) > 400").orderBy("doc_id").limit(80).collect():
        w = r.text.split(" ")
        for _ in range(1 + len(w) // 70):
            w[rnd.randrange(len(w))] = rnd.choice(["", "changed", w[0]])
        copies.append((*r[:1], " ".join(w), *r[2:]))
    d = save(d.unionByName(spark.createDataFrame([(10**6 + c[0], *c[1:]) for c in copies], d.schema)), "d")
    text = {r.doc_id: r.text for r in d.select("doc_id", "text").collect()}
    kept = {r.doc_id for r in simhash.first_of_groups(d).select("doc_id").collect()}
    sets, by = {i: set(minhash.shingles(t).tolist()) for i, t in text.items()}, {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    like = {}
    for i, s in sets.items():
        for j in {j for x in s for j in by[x] if j != i}:
            if len(s & sets[j]) >= 0.8 * len(s | sets[j]):
                like.setdefault(i, set()).add(j)
    ids = sorted(text)
    groups = {}
    for i, r in zip(ids, find_groups(len(ids), lambda a, b: ids[b] in like.get(ids[a], ()))):
        groups.setdefault(r, []).append(i)
    extra = sum(len(g) - 1 for g in groups.values())
    found = sum(len(g) - len(kept & set(g)) for g in groups.values())
    assert extra > 20 and found >= 0.9 * extra
    assert all(kept & set(g) for g in groups.values())


def _words(seed):
    rnd = random.Random(seed)
    return [f"w{rnd.randrange(9999)}" for _ in range(150)]


def _near_copy(words):
    """Other words whose fingerprint is one or two bits away."""
    fp = brute_fingerprint(" ".join(words))
    for i in range(10_000):
        text = " ".join([*words[:-1], f"x{i}"])
        if 1 <= (brute_fingerprint(text) ^ fp).bit_count() <= 2:
            return text


def test_rows_without_an_id_are_grouped_by_text(spark):
    """Unrelated rows without an id all stay; near copies among them are linked, and one stays."""
    texts = [" ".join(_words(s)) for s in range(5)]
    near = texts[0] + " more"
    rows = [(None, t) for t in [*texts, near]]
    kept = [r.text for r in simhash.first_of_groups(docs(spark, rows)).collect()]
    assert len(kept) == 5 and set(texts[1:]) < set(kept) and len({texts[0], near} & set(kept)) == 1
    kept = [(r.doc_id, r.text) for r in simhash.first_of_groups(docs(spark, [*rows, (4, near)])).collect()]
    assert sorted(kept, key=str) == sorted([(4, near), *[(None, t) for t in texts[1:]]], key=str)


def test_different_texts_of_one_id(spark):
    """They are rows of their own groups: none is lost, none links the groups, and no near copy comes back with the other."""
    a, b = " ".join(_words(1)), " ".join(_words(2))
    near = b + " more"
    kept = [(r.doc_id, r.text) for r in simhash.first_of_groups(docs(spark, [(7, a), (7, b), (7, b), (9, near)])).collect()]
    assert sorted(kept) == sorted([(7, a), (7, b)])
    kept = [(r.doc_id, r.text) for r in simhash.first_of_groups(docs(spark, [(7, a), (7, near), (3, b)])).collect()]
    assert sorted(kept) == sorted([(7, a), (3, b)])


def test_unlike_texts_of_one_fingerprint_stay(spark):
    """The same words in another order have the same fingerprint, but share no shingles."""
    w = _words(4)
    rows = [(1, " ".join(w)), (2, " ".join(w[::-1])), (3, " ".join(sorted(w))), (4, " ".join(w) + " more")]
    assert {simhash.fingerprint(t, 1, distinct=True) for _, t in rows[:3]} == {simhash.fingerprint(rows[0][1], 1, distinct=True)}
    assert sorted(r.doc_id for r in simhash.first_of_groups(docs(spark, rows)).collect()) == [1, 2, 3]


def kept_ids(spark, texts):
    rows = [(i, t if isinstance(t, str) else " ".join(t)) for i, t in enumerate(texts, 1)]
    return sorted(r.doc_id for r in simhash.first_of_groups(docs(spark, rows)).collect())


def test_links_among_texts_of_one_fingerprint(spark):
    """The first text of a fingerprint is unlike the others, which are like each other."""
    w = [f"w{i}" for i in range(60)]
    shuffled = random.Random(1).sample(w, 60)
    assert kept_ids(spark, [shuffled, w, [*w, w[-1]], [*w, w[-1], w[-1]]]) == [1, 2]


def test_links_behind_an_unlike_first_text(spark):
    """Linked fingerprints, of which the first texts are unlike."""
    w = [f"w{i}" for i in range(200)]
    changed = next(c for i in range(9999) if 0 < (simhash.fingerprint(" ".join(c := [*w[:-1], f"x{i}"]), 1, distinct=True) ^ simhash.fingerprint(" ".join(w), 1, distinct=True)).bit_count() <= 6)
    assert kept_ids(spark, [random.Random(1).sample(w, 200), w, changed]) == [1, 2]


def test_short_texts(spark):
    """One word more, in texts of 12 to 400: nine in ten pairs of similarity 0.8 at least are found, at every length."""
    rnd, texts, at = random.Random(2), [], {}
    for length in (12, 20, 30, 50, 90, 130, 400):
        for _ in range(60):
            w = [f"w{rnd.randrange(9999)}" for _ in range(length)]
            p = rnd.choice([0, length, rnd.randrange(length)] if length > 48 else [0, length])
            at.setdefault(length, []).append(len(texts) + 2)
            texts += [w, [*w[:p], "more", *w[p:]]]
    kept = set(kept_ids(spark, texts))
    missed = {length: len(kept.intersection(ids)) for length, ids in at.items()}
    assert len(kept) >= len(texts) / 2 and max(missed.values()) <= 6, missed


def test_near_stage_hashes_no_table_of_many_ids(spark, monkeypatch):
    """What grows with the rows is joined by sort-merge, and the same rows stay."""
    rnd = random.Random(8)
    base = [[f"w{rnd.randrange(999)}" for _ in range(n)] for n in (30, 200, 400)]
    texts = [t for w in base for t in (w, [*w, "more"], rnd.sample(w, len(w)))]
    want = kept_ids(spark, texts)
    monkeypatch.setattr(common, "FEW", 0)
    plans = plans_of(monkeypatch, simhash, minhash, common)
    assert kept_ids(spark, texts) == want == [1, 3, 4, 6, 7, 9]
    for name in ("scopes", "level", "regions", "proposed", "second", "members", "listed"):
        assert plans[name] and not any("BroadcastHashJoin" in p for p in plans[name])
