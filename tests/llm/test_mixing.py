from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, docs
from tideline.llm import mixing


def brute_targets(sizes: dict, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        capped = {s for s in open_ if w[s] * level > most * sizes[s]}
        if not capped:
            return out | {s: w[s] * level for s in open_}
        for s in capped:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ -= capped
    return out


def test_targets_and_taken(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 13)), "en", ["big", "mid", "small", None][0 if i % 3 else i % 4]) for i in range(3000)]
    got = mixing.mix(docs(spark, rows), bucket_rows=64).collect()
    sizes, taken = {}, {}
    source = {i: s for i, _, _, s in rows}
    for r in got:
        assert r.size == 1 + r.doc_id * 7 % 13 and r.taken % r.size == 0 and r.taken <= 3 * r.size
        s = source[r.doc_id]
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
    want = brute_targets(sizes)
    for r in got:
        assert abs(r.target - want[source[r.doc_id]]) < 1e-6 and r.source_size == sizes[source[r.doc_id]]
    assert all(abs(taken[s] - want[s]) <= 13 for s in sizes)
    again = mixing.mix(docs(spark, rows[::-1]).repartition(7), bucket_rows=64).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def brute_mix(rows, targets, most=3):
    """Finish times of all copies in one list, cut at the budget; ``rows``: doc_id, source, size, place of a source's order."""
    sources, copies = {}, []
    for doc_id, source, size, place in rows:
        if size:
            sources.setdefault(source, {}).setdefault((doc_id, size), [place, 0])[1] += size
    names = sorted({r[1] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    for source, units in sources.items():
        whole = sum(w for _, w in units.values())
        for epoch in range(min(most - 1, int(targets[source] / whole)) + 1):
            upto = epoch * whole
            for unit, (place, w) in sorted(units.items(), key=lambda x: x[1][0]):
                upto += w
                copies.append((upto / targets[source], names.index(source), epoch, place, w, source, unit))
    left, taken = sum(r[2] for r in rows), {}
    for *_, w, source, unit in sorted(copies):
        if w > left:
            break
        left -= w
        taken[source, unit] = taken.get((source, unit), 0) + 1
    return sorted((d, size, size * taken.get((source, (d, size)), 0)) for d, source, size, _ in rows)


def test_order_and_cut_against_brute_force(spark):
    rows = [(i // 2 if i % 50 < 2 else i, " ".join(["w"] * (i * 11 % 17)), "en", ["big", "mid", "small", None][0 if i % 3 else i % 4]) for i in range(2000)]
    d = docs(spark, rows)
    sized = d.select("doc_id", "source", mixing.words(F.col("text")).alias("size"))
    n_rows = sized.groupBy("source").agg(F.count("*").alias("n_rows"))
    placed = mixing.with_sources(sized, n_rows).select("doc_id", "source", "size", mixing._order(7, 64).alias("place"))
    known = [(r.doc_id, r.source, r.size, tuple(r.place)) for r in placed.collect()]
    sizes = {}
    for _, s, n, _ in known:
        sizes[s] = sizes.get(s, 0) + n
    want = brute_mix(known, brute_targets(sizes))
    got = mixing.mix(d, bucket_rows=64).collect()
    assert sorted((r.doc_id, r.size, r.taken) for r in got) == want and {0, 3} <= {t // n for _, n, t in want if n}


def test_rows_of_the_mix(spark):
    rows = [(i, "a b c d", "en", "ab"[i % 2]) for i in range(200)]
    n = {}
    d = docs(spark, rows)
    mixed = mixing.mixed_rows(d)
    assert mixed.columns == d.columns
    for r in mixed.collect():
        n[r.doc_id] = n.get(r.doc_id, 0) + 4
    assert n == {r.doc_id: r.taken for r in mixing.mix(d).collect() if r.taken}


def test_awkward_tables(spark):
    got = mixing.mix(docs(spark, AWKWARD)).collect()
    assert len(got) == len(AWKWARD)
    assert all(r.taken == 0 for r in got if r.doc_id in (1, 2, 3))
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.mixed_rows(docs(spark, [])).count() == 0
    assert mixing.mix(docs(spark, [(1, None), (2, "")])).count() == 2
