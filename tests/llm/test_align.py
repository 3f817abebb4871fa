import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import AWKWARD, docs
from tideline.llm import align
from tideline.llm.queries import alignment_files

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
BYTE = {c: b for c, b in align._byte_of().items()}


def brute(text):
    """Tokens of the whole text, their ends by adding up decoded bytes; groups and links."""
    if not text:
        return 0, 0, [], []
    data = (" " + text).encode()
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    a_bytes = [bytes(BYTE[c] for c in A.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, B.id_to_piece(i)) for i in b)]
    if b"".join(a_bytes) != data or b"".join(b_bytes) != data:
        return 0, 0, [], []

    def ends(parts):
        at = 0
        return [at := at + len(p) for p in parts]

    ea, eb = ends(a_bytes), ends(b_bytes)
    both = sorted(set(ea) & set(eb))
    sides = [[[] for _ in both] for _ in "ab"]
    for side, ids, ends_of in zip(sides, (a, b), (ea, eb)):
        for i, e in zip(ids, ends_of):
            side[bisect.bisect_left(both, e)].append(str(i))
    groups = [f"{','.join(x)}|{','.join(y)}" for x, y in zip(*sides)]
    b_at = dict(zip(eb, b))
    links = [(x, b_at[e]) for x, e in zip(a, ea) if e in b_at]
    return len(a), len(b), groups, links


@pytest.fixture(scope="module")
def aligner():
    return align.load(*(open(p, "rb").read() for p in alignment_files()))


def same(aligner, texts):
    for text, (n_a, n_b, n, groups, links) in zip(texts, aligner.align(texts)):
        want = brute(text)
        assert (n_a, n_b, n, groups) == (want[0], want[1], len(want[2]), ";".join(want[2])), text
        assert links == Counter(x << 32 | y for x, y in want[3])


TEXTS = ["a", " a", "  a  b ", "\n\n x\n\ty \r\n", "don't they're 'd 's.", "3.14,15 x_y. _a! a.b", "漢字 \U0001f642x €. é́ Ａ", "<s> </s> <unk> <0x41> <|endoftext|>", "▁a▁▁b", "a\x1c! b\x85c\x00", "word" * 300, "x" + " " * 50 + "y", " a　b c", "!!! ### && a&&&", "a;\r\nb\r c }\r\n\r\n", "x\u2003y\r", "مرحبا नमस्ते."]


def test_awkward_texts(aligner):
    assert aligner.cuts
    same(aligner, [None, "", *TEXTS, *[r[1] for r in AWKWARD[:5]]])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\r\t.;,!'\"aé漢\U0001f642s1_▁ &"), st.characters(exclude_categories=["Cs"])), max_size=30), max_size=4))
def test_any_text(texts):
    same(align.load(*(open(p, "rb").read() for p in alignment_files())), texts)


def test_spans_are_refined():
    def ends(spans, sizes):
        return align.refined(np.array(spans), np.array(sizes), np.array([0, 1, 2, 5])).tolist()

    # a three-byte character in three byte tokens, after two one-byte characters
    assert ends([(0, 1), (1, 2), (2, 2), (2, 2), (2, 3)], [1, 1, 1, 1, 1]) == [1, 2, 3, 4, 5]
    # a token with a space and half a character reports the whole character
    assert ends([(0, 1), (1, 3), (2, 3)], [1, 2, 2]) == [1, 3, 5]


def test_a_small_memo_changes_nothing():
    small = align.Aligner(*(open(p, "rb").read() for p in alignment_files()), memo=2000)
    rnd = random.Random(1)
    for _ in range(5):
        same(small, [" ".join(rnd.choice(TEXTS) for _ in range(8)) for _ in range(4)])


def test_without_proof_whole_texts_are_encoded(aligner):
    whole = align.Aligner(*(open(p, "rb").read() for p in alignment_files()))
    whole.cuts = False
    assert whole.align(TEXTS) == aligner.align(TEXTS)


def test_query_against_brute_force(spark, tmp_path):
    from tideline.llm.queries import op13_align

    rnd = random.Random(2)
    words = ["the", "Haus", "été", "niño", "漢字", "antithesis", "42", "x€y", "don't"]
    rows = [*AWKWARD, *((100 + i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(60)))) for i in range(40)), *((300 + i, t) for i, t in enumerate(TEXTS)), (5, "another of its id")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = [brute(r[1]) for r in rows]
    counts = Counter(x for f in found for x in f[3])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    want = []
    for r, (n_a, n_b, groups, links) in zip(rows, found):
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else ""
        want.append((r[0], n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest))
    got = op13_align(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_empty_table(spark):
    assert align.score_links(align.align_documents(docs(spark, []), *alignment_files())).count() == 0
