import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import AWKWARD, docs
from tideline.llm import bpe
from tideline.llm.queries import ranks_file

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def both():
    path, pattern = ranks_file()
    raw = open(path, "rb").read()
    return bpe.load(raw, pattern), tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=bpe.read_ranks(raw), special_tokens={})


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=80))
def test_same_as_tiktoken(both, text):
    own, other = both
    text = text.encode("utf-8", "ignore").decode()
    ids = own.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == other.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(a=st.binary(max_size=30), b=st.binary(max_size=10), data=st.data())
def test_append_and_edit_equal_a_fresh_table(both, a, b, data):
    own, _ = both
    table = bpe.PrefixTable(own, a)
    table.append(b)
    assert table.last == bpe.PrefixTable(own, a + b).last
    i = data.draw(st.integers(0, len(a + b)))
    j = data.draw(st.integers(i, len(a + b)))
    table.replace(i, j, b"xyz")
    assert table.last == bpe.PrefixTable(own, (a + b)[:i] + b"xyz" + (a + b)[j:]).last


def test_edits_near_the_front_of_a_long_piece_stop_early(both):
    own, _ = both
    table = bpe.PrefixTable(own, b"abcdefghij" * 500)
    assert table.replace(5, 6, b"Q") < 200
    assert table.last == bpe.PrefixTable(own, b"abcdeQghij" + b"abcdefghij" * 499).last


def test_a_piece_of_any_length(both):
    own, other = both
    for text in ("x" * 5000, "abcdefghij" * 2000, "ß" * 3000 + "\u00e9a" * 500, "z" * 1_000_000):
        ids = np.frombuffer(own.encode([text])[0], "<u4").tolist()
        assert own.decode(own.encode([text])[0]) == text.encode()
        if len(text) < 100_000:
            assert ids == other.encode_ordinary(text)
    assert not any(len(p) > 64 for p in own._young)


def test_generations_of_the_memo_change_nothing(both):
    own, other = both
    small = bpe.ByteBPE(own.ranks, own.pattern.pattern, memo=3000)
    for i in range(60):
        text = f"some words come again and number {i} does not, nor does w{i * i}x"
        assert np.frombuffer(small.encode([text])[0], "<u4").tolist() == other.encode_ordinary(text)
        assert small._held <= 3000 and len(small._young) + len(small._old) < 45
    assert " again" in small._young or " again" in small._old


def test_awkward_tables(spark, both):
    _, other = both
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs(spark, AWKWARD), *ranks_file()).collect()}
    want = set()
    for i, t, *_ in AWKWARD:
        ids = other.encode_ordinary(t or "")
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == want
    assert bpe.digests(docs(spark, []), *ranks_file()).count() == 0
