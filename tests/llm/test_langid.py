import math
import zlib

import numpy as np
import pytest

from tests.llm.helpers import AWKWARD, docs
from tideline.llm import langid
from tideline.llm.common import table


def test_held_out_accuracy(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    got = langid.predict(d, langid.fit(d)).join(d.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


@pytest.fixture(scope="module")
def learned(spark, sf_dir):
    return langid.fit(table(spark, sf_dir, "documents"))


def passages(spark, sf_dir, n, held=True):
    """(passage of n code points, language), from held-out texts."""
    for r in table(spark, sf_dir, "documents").where("lang IS NOT NULL").select("doc_id", "text", "lang").collect():
        if r.text and len(r.text) >= n and zlib.crc32(str(r.doc_id).encode()) % 3 == 1:
            at = r.doc_id * 37 % (len(r.text) - n + 1)
            yield r.text[at : at + n], r.lang


def test_weights_are_sparse_and_scores_calibrated(spark, sf_dir, learned):
    """Expected calibration error over held-out passages of many lengths."""
    assert (learned.weights == 0).mean() > 0.5 and learned.temperature > 0
    seen = [(learned.predict(t), lang) for n in (16, 64, 256) for t, lang in passages(spark, sf_dir, n)]
    score, right = np.array([s for (_, s), _ in seen]), np.array([p == lang for (p, _), lang in seen])
    bins = np.minimum((score * 10).astype(int), 9)
    assert sum(abs(score[bins == b].sum() - right[bins == b].sum()) for b in range(10)) / len(score) < 0.15


FOREIGN = [
    "Съешь же ещё этих мягких французских булок, да выпей чаю, сказал он и ушёл домой по дороге.", "色は匂へど散りぬるを我が世誰ぞ常ならむ有為の奥山今日越えて浅き夢見じ酔ひもせず。" * 2, "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία και πάω στο σπίτι μου το βράδυ με τα πόδια.",
    "xkq zvw qqj wxz kjq zzx vqk jxw qzk wvx kqz jjq xwv zkq qxj vwz kxq zjv wqx kzj qvw xzk jqv", "1010 0x3f 88-91 7766 5.4e9 @@@ 0xdeadbeef == 55 || 77 && x1 y2 z3 0b1101 0o777 9f8e7d 6c5b4a",
]


def test_what_is_recognised(spark, sf_dir, learned):
    """Letterless rows and other scripts go; passages of the learned languages stay, the shortest ones too."""
    assert not any(map(learned.recognises, [None, "", "  ", "12345 !!! ###", "\U0001f600 ..."]))
    assert not any(map(learned.recognises, FOREIGN)), ([learned.strangeness(t) for t in FOREIGN], learned.limits)
    for n in (12, 40, 100, 600):
        found = [learned.recognises(t) for t, _ in passages(spark, sf_dir, n)]
        assert len(found) > 20 and sum(found) >= 0.98 * len(found)
    assert list(learned.limits) == sorted(learned.limits, reverse=True)
    kept = langid.recognised_rows(docs(spark, [(i, t) for i, t in enumerate([*FOREIGN, None, "4"])]), learned)
    assert kept.count() == 0


def test_a_learning_step_is_that_of_the_plain_formula():
    """Proximal steps with per-coordinate rates, written out weight by weight."""
    rng = np.random.default_rng(4)
    own, z, n = langid.Ftrl(3, 6, 0.5, 1.0, 0.02, 0.01), np.zeros((3, 7)), np.zeros((3, 7))

    def weight(c, i):
        return 0.0 if abs(z[c, i]) <= 0.02 else -(z[c, i] - math.copysign(0.02, z[c, i])) / ((1.0 + math.sqrt(n[c, i])) / 0.5 + 0.01)

    for _ in range(60):
        at, y = np.flatnonzero(rng.random(7) < 0.5), int(rng.integers(3))
        x = rng.normal(size=len(at))
        w = [[weight(c, i) for i in at] for c in range(3)]
        e = [math.exp(sum(a * b for a, b in zip(w[c], x))) for c in range(3)]
        for c in range(3):
            for k, i in enumerate(at):
                g = (e[c] / sum(e) - (c == y)) * x[k]
                s = (math.sqrt(n[c, i] + g * g) - math.sqrt(n[c, i])) / 0.5
                z[c, i] += g - s * w[c][k]
                n[c, i] += g * g
        own.learn(at, x, y)
    assert np.allclose(own.z, z) and np.allclose(own.n, n)


def test_long_texts_count_every_gram_once():
    text = "äbc dé" * (langid.BLOCK // 3)
    whole = langid.counts(text)
    assert whole.sum() == sum(len(text) - k for k in range(3))


def test_awkward_tables(spark):
    rows = [(i, t, "en" if i % 2 else "fr") for i, t in enumerate(["the cat and the dog", "le chat et le chien"] * 30)]
    d = docs(spark, [(i, t, lang, "s") for i, t, lang in rows])
    m = langid.fit(d)
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs(spark, AWKWARD), m).collect()}
    assert got[1] == got[2] == got[3] == got[10] == "und" and got[7] in ("en", "fr")
    assert langid.predict(docs(spark, AWKWARD), m).count() == len(AWKWARD)
    empty = langid.fit(docs(spark, []))
    assert langid.predict(docs(spark, [(1, "text")]), empty).first().lang_pred == "und"
    assert langid.recognised_rows(docs(spark, AWKWARD), m).columns == docs(spark, []).columns


def test_sample_follows_distinct_texts(spark):
    """Copies do not thin the sample: a language of few texts, each many times over, is learned from all of them."""
    few = ["le chat et le chien sont dans la maison", "il fait beau et nous allons au marché", "elle lit un livre près de la fenêtre"]
    rows = [(3 * i, t, "fr", "s") for i, t in enumerate(few * 3000)]
    rows += [(30_000 + i, f"the cat number {i} and the dog are in the house by the river", "en", "s") for i in range(600)]
    m = langid.fit(docs(spark, rows))
    assert (m.weights[m.languages.index("fr")] != 0).any()
    assert [m.predict(t)[0] for t in few] == ["fr"] * 3
