import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, docs
from tideline.llm import chat, quality, tokcount, topk
from tideline.llm.common import table
from tideline.llm.queries import ranks_file


# ---- token counts ----


def test_counts_of_flat_files(spark, tmp_path):
    rnd = random.Random(1)
    want = []
    for f in range(3):
        tokens, place = [], 0
        for _ in range(40):
            n = rnd.choice([0, 0, 1, 5, 90])
            want.append((f"{f}.tok", place, n, True))
            tokens += [7] * n + [9]
            place += 1
        if f == 1:
            tokens += [7] * 33
            want.append((f"{f}.tok", place, 33, False))
        np.array(tokens, "<u2").tofile(tmp_path / f"{f}.tok")
    (tmp_path / "empty.tok").touch()
    for block in (1, 7, 64, 1 << 20):
        got = tokcount.count_flat(spark, f"file://{tmp_path}", 9, block=block).select("file", "place", "n_tokens", "ended").collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_counts_of_documents(spark):
    import tiktoken

    path, pattern = ranks_file()
    enc = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=tokcount.read_ranks(open(path, "rb").read()), special_tokens={})
    got = tokcount.document_tokens(docs(spark, AWKWARD), path, pattern, 50256, block=1000).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, len(enc.encode_ordinary(t or "")))) for i, t, *_ in AWKWARD)
    assert tokcount.document_tokens(docs(spark, []), path, pattern, 50256).count() == 0
    for end_id in (100, 70_000):
        with pytest.raises(ValueError):
            tokcount.document_tokens(docs(spark, AWKWARD), path, pattern, end_id)


# ---- exact top-k ----


def brute_top(rows, k):
    good = [(n, i, [int(np.floor(64 * float(x))) for x in v]) for n, (i, v) in enumerate(rows) if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for m, q, a in good:
        if q % 3 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for n, i, b in good if n != m and len(a) == len(b))[:k]
            out += [(q, r + 1, i, -t) for r, (t, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_top_k(spark, scale):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=8) * scale).astype("f4").tolist()) for i in range(90)] + [(i, [0.5] * 8) for i in range(100, 160)]
    rows += [(200, None), (201, [None] * 8), (202, [float("nan")] * 8), (203, [1.0, 2.0]), (204, [3.0, -1.0]), (205, []), (None, [1.0] * 8)]
    rows += [(3, (rng.normal(size=8) * scale).astype("f4").tolist()), (3, rows[3][1]), (4, rows[4][1])]  # ids again, with other and with the same vectors
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, no string")
    for wave in (8192, 7):
        got = topk.top_k(df, F.col("vec_id") % 3 == 0, 5, wave_size=wave).collect()
        assert sorted(map(tuple, got)) == brute_top(rows, 5)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 3 == 0).count() == 0


# ---- quality ----


def test_grades_are_learned(spark):
    from tideline.llm.queries import op8_quality

    sf_dir = "/root/testdata/sf0.1"  # a smaller table has too few toxic rows to learn from and to judge by
    scored = op8_quality(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    got = scored.where(quality.held_out(F.col("doc_id"))).collect()
    assert 50 < len(got) < scored.count() / 3  # what nothing was learned from
    good, toxic = [r for r in got if r.quality == 1 and r.toxic == 0], [r for r in got if r.toxic == 1]
    assert sum(r.kept for r in good) >= 0.98 * len(good) and sum(r.kept for r in toxic) <= 0.12 * len(toxic)
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.p_top <= 1 for r in got)


def test_a_step_of_the_fit_goes_down_the_plain_likelihood():
    """One row, one step: the weights and thresholds move against the loss's numeric gradient, worked out from the definition."""

    def loss(s, first, steps, y):
        cut = [-math.inf, *(first + np.concatenate([[0.0], np.cumsum(np.exp(steps))])), math.inf]
        return -math.log(1 / (1 + math.exp(s - cut[y + 1])) - (1 / (1 + math.exp(s - cut[y])) if y else 0.0))

    at, e = np.array([3, 17]), 1e-6
    for y in range(4):
        share = np.cumsum(np.bincount([y], minlength=4)[:-1] + 1.0) / 5
        cut = np.log(share / (1 - share))
        first, steps = cut[0], np.log(np.diff(cut))
        m = quality.fit_rows([(y, at)], 4, epochs=1, rate=0.15, l1=0.0)
        g = (loss(e, first, steps, y) - loss(-e, first, steps, y)) / (2 * e)
        assert np.allclose(m.weights[at], -0.15 * g / math.sqrt(0.01 + g * g), atol=1e-6) and not m.weights[[0, 4]].any()
        df = (loss(0, first + e, steps, y) - loss(0, first - e, steps, y)) / (2 * e)
        ds = np.array([(loss(0, first, steps + e * u, y) - loss(0, first, steps - e * u, y)) / (2 * e) for u in np.eye(2)])
        want = first - 0.01 * df + np.concatenate([[0.0], np.cumsum(np.exp(steps - 0.01 * ds))])
        assert np.allclose(m.thresholds, want, atol=1e-5)


def test_quality_of_awkward_tables(spark):
    rated = spark.createDataFrame([(4, 2), (5, 0), (6, 0), (6, 1), (8, 2), (None, 1)], "doc_id long, grade int")
    m = quality.fit(docs(spark, AWKWARD), rated, 3)
    assert (np.diff(m.thresholds) > 0).all()
    assert quality.score(docs(spark, AWKWARD), m).count() == len(AWKWARD)
    assert quality.score(docs(spark, []), m).count() == 0
    none = quality.fit(docs(spark, []), rated, 3)
    assert abs(quality.score(docs(spark, [(1, "a b")]), none).first().expected_grade - 1) < 0.2


# ---- chat ----


MARKS = st.text(alphabet="ab:#<>/\\ \nturn$1", max_size=30)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(MARKS, MARKS), min_size=1, max_size=60))
def test_turns_come_back(spark, turns):
    piece, start, stop = chat.formatted_turn(F.col("role"), F.col("text"))
    rows = spark.createDataFrame([(i, *t) for i, t in enumerate(turns)], "i long, role string, text string").select("i", piece.alias("p"), start.alias("a"), stop.alias("b")).orderBy("i").collect()
    assert chat.read_turns("".join(r.p for r in rows)) == turns
    assert [chat.unescape(r.p[r.a : r.b]) for r in rows] == [t for _, t in turns]


def test_a_very_long_turn_takes_little_memory():
    import tracemalloc

    text = "a line with #marks and <tags> \\ and more of it; " * 420_000
    piece = f"### user: {text.replace('\\', '\\\\').replace('#', '\\#').replace('<', '\\<')} </turn>\n"
    tracemalloc.start()
    (turn,) = chat.read_turns(piece)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert turn == ("user", text) and len(text) > 20_000_000 and most < 500 << 20


def test_trees(spark):
    rows = [("t", 1, None, "user", "root", 0.0), ("t", 2, 1, "assistant", "a", 1.0), ("t", 3, 1, "assistant", "b", 3.0), ("t", 4, 2, "user", "aa", 5.0), ("t", 5, 3, "user", "bb", 0.0), ("t", 6, 99, "user", "orphan", 0.5), ("t", 7, 8, "user", "c", 9.0), ("t", 8, 7, "user", "c", 9.0)]
    nodes = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    got = sorted((r.leaf, r["rank"], r.up, r.node) for r in chat.branches(nodes, best=3).collect())
    assert got == [(4, 1, 0, 4), (4, 1, 1, 2), (4, 1, 2, 1), (5, 2, 0, 5), (5, 2, 1, 3), (5, 2, 2, 1), (6, 3, 0, 6)]


def test_long_and_awkward_conversations(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"turn {i}") for i in range(137)] + [(2, 0, None, None), (None, 1, "assistant", "x"), (3, 5, "assistant", "same"), (3, 5, "assistant", "same"), (4, None, "assistant", "\\<")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, tree string")
    rows += [(5, i, "assistant", "long # text <b> " * 100_000) for i in range(2)]
    df = df.unionByName(spark.createDataFrame([(*r, "z") for r in rows[-2:]], df.schema))
    turns = chat.format_trees(chat.linear_tree(df))
    got = {r.conv_id: r for r in chat.read_back(turns).collect()}
    whole = {r.conv_id: r for r in chat.conversations(turns).collect()}
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        loss = "".join(t for r, t in turns if r == "assistant")
        g = got[conv]
        assert g.n_turns == len(turns) and g.loss_chars == len(loss)
        assert g.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert g.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        w = whole[conv]
        assert chat.read_turns(w.formatted) == turns and len(w.formatted) == g.formatted_chars
        assert "".join(chat.unescape(w.formatted[a:b]) for a, b in w.loss) == loss
    assert chat.read_back(chat.format_trees(chat.linear_tree(df.limit(0)))).count() == 0


def test_one_id_for_all_rows_is_one_rated_row(spark):
    """However many texts share an id, the training task gets one of them."""
    rows = [(7, f"text {i} of the same id") for i in range(400)] + [(1, "a good text"), (2, "a bad text")]
    ratings = spark.createDataFrame([(7, 1), (7, 2), (1, 2), (2, 0)], "doc_id long, grade int")
    many, few = (quality.fit(docs(spark, r), ratings, 3) for r in (rows, rows[:1] + rows[-2:]))
    assert many.thresholds.shape == few.thresholds.shape == (2,) and np.isfinite(many.weights).all()
    assert np.count_nonzero(many.weights) < 60


def test_too_many_languages_are_refused(spark):
    from tideline.llm import langid

    rows = [(i, f"some text of language {i}", f"l{i}", "s") for i in range(40)]
    with pytest.raises(ValueError, match="most_languages"):
        langid.fit(docs(spark, rows), most_languages=5)
