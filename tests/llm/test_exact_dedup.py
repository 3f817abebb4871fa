import hashlib
import re

import numpy as np

from tests.llm.helpers import AWKWARD, docs
from tideline.llm import exact_dedup


def brute(rows):
    groups = {}
    for i, t, *_ in rows:
        t = t or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i is None, i))
    out = []
    for norm, members in groups.items():
        best = min(members)
        seen = False
        for m in sorted(members):
            first = m == best and not seen
            seen |= first
            out.append((m[2], best[2], len(members), first, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    for rows in (AWKWARD, [(i, "text %d" % (i % 40) + " " * (i % 3)) for i in range(400)], []):
        got = sorted((tuple(r) for r in exact_dedup.dedup(docs(spark, rows), capacity=8, entries=512).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)
        assert got == brute(rows)


def test_kept_rows(spark):
    d = docs(spark, AWKWARD)
    kept = exact_dedup.kept_rows(d)
    assert kept.columns == d.columns
    want = sorted(repr(r[0]) for r in brute(AWKWARD) if r[3])
    assert sorted(repr(r.doc_id) for r in kept.collect()) == want
    text = {i: t for i, t, *_ in AWKWARD}
    assert all(r.text == text[r.doc_id] for r in kept.collect())
    assert exact_dedup.kept_rows(docs(spark, [])).count() == 0


def test_directory_splits_full_buckets(spark):
    keys = spark.createDataFrame([(int(k),) for k in np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 3000)], "key long")
    for capacity, entries, most in ((200, 1 << 22, 200), (5, 1 << 22, 40), (1, 64, 800)):
        table = exact_dedup.directory(keys, capacity, entries)
        bits = len(table).bit_length() - 1
        held = np.bincount(table[[(k.key & (2**64 - 1)) >> (64 - bits) for k in keys.collect()]])
        assert held.max() <= most and len(table) <= max(entries, 16)
        # a bucket is one range of leading bits
        assert (np.diff(table) >= 0).all()
        for b in range(table.max() + 1):
            assert (table == b).sum().bit_count() == 1
