import random
import re
from collections import Counter
from zlib import crc32

import pytest

from tests.llm.helpers import AWKWARD, docs
from tideline.llm import spelling


def brute_words(rows):
    total = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def texts(seed, n):
    rnd = random.Random(seed)
    base = ["there", "house", "häuser", "écoles", "señora", "aaaaa", "aaaaaa", "abcabc", "ZEBRAS", "ÿÿÿÿÿ"] + ["".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(5, 9))) for _ in range(25)]
    out = []
    for i in range(n):
        words = []
        for _ in range(rnd.randrange(80)):
            w = base[min(rnd.randrange(35), rnd.randrange(35))]
            if rnd.random() < 0.4:
                p, c = rnd.randrange(len(w)), rnd.choice("abcéÿ")
                w = rnd.choice([w[:p] + w[p + 1 :], w[:p] + c + w[p:], w[:p] + c + w[p + 1 :]])
            words.append(w)
        out.append((i, rnd.choice([" ", ", ", "-"]).join(words)))
    return out


@pytest.mark.parametrize("wave", [spelling.WAVE, 40])
def test_against_brute_force(spark, wave):
    rows = [*AWKWARD, *texts(1, 150), *texts(1, 150), (None, "there there there thre thre thre"), (900, "xqzzz " * 3 + "xqzzk " * 7 + "xqzkk " * 15)]
    want = brute(brute_words(rows))
    assert sum(r[4] for r in want) > 200 and ("xqzzz", "xqzzk", "xqzkk") in {r[:3] for r in want}
    got = spelling.group_variants(spelling.vocabulary(docs(spark, rows)), wave)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_long_words_and_ties(spark):
    long = "x" * 3000
    rows = [(1, f"{long} {long} {long} {long[1:]} " + f"{long}y " * 3 + "apple " * 6 + "ample " * 6 + "aptle " * 3 + f"{long[1:]} " * 5)]
    want = brute(brute_words(rows))
    assert sorted(map(tuple, spelling.group_variants(spelling.vocabulary(docs(spark, rows))).collect()), key=repr) == want
    assert next(r for r in want if r[0] == "aptle")[1] == "apple"


def test_long_chains(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(40)] + [(f"v{i}", "w3") for i in range(50)], "word string, form string")
    got = {r.word: r.root for r in spelling.follow(forms).collect()}
    assert len(got) == 90 and set(got.values()) == {"w40"}


def test_empty(spark):
    assert spelling.group_variants(spelling.vocabulary(docs(spark, []))).count() == 0
    assert spelling.group_variants(spelling.vocabulary(docs(spark, AWKWARD[:4]))).count() == 0


def test_few_false_positives(spark):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(8)) for _ in range(3000)]
    df = spark.createDataFrame([(w, 1) for w in set(words)], "word string, n long")
    filters = spelling.make_filters(df, 0, 1)
    hits = list(spelling.edits(words[:200], 8, filters))
    assert len(hits) < 0.05 * 200 * 8 * 80
    assert filters.holds(8, spelling.word_hash(spelling._letters(words, 8))).all()
