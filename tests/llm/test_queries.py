import pytest

from tests.compare import connect, differences
from tests.llm.helpers import AWKWARD, docs
from tideline.llm import queries as q
from tideline.llm.minhash import shingles


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    n, found = differences(spark, connect(sf_dir), q.queries()[name], q.oracle_sql()[name], sf_dir)
    assert n and not found, found


def test_pipeline(spark, sf_dir):
    """Stage by stage: columns stay, nothing clean goes, duplicates do, the mix repeats, the codes are those of its texts."""
    import corpus_pipeline as cp
    from tideline.llm.common import save, table

    docs = table(spark, sf_dir, "documents")
    seen = {}
    for name, stage in cp.STAGES[:-1]:
        before, docs = docs, save(stage(spark, docs, sf_dir), name)
        assert docs.columns == before.columns
        seen[name] = docs
    raw = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    kept = {n: [r.doc_id for r in d.select("doc_id").collect()] for n, d in seen.items()}
    clean = [i for i, t in raw.items() if t and len(t) > 200]
    assert len(set(kept["language"]) & set(clean)) >= 0.995 * len(clean)
    norm = {}
    for i in sorted(kept["language"], key=lambda i: (-len(raw[i]), i)):
        norm.setdefault("".join(raw[i].encode().decode().split(" ")).translate({c: None for c in range(9, 14)}), i)
    assert sorted(kept["exact"]) == sorted(norm.values())
    sets = {i: set(shingles(raw[i]).tolist()) for i in kept["exact"]}
    for i in set(kept["exact"]) - set(kept["near"]):  # what goes is like a text before it
        assert any(len(sets[i] & s) >= 0.8 * len(sets[i] | s) for j, s in sets.items() if j != i)
    assert set(kept["near"]) < set(kept["exact"])
    assert set(kept["mix"]) <= set(kept["near"]) and max(map(kept["mix"].count, set(kept["mix"]))) <= 3
    last = cp.STAGES[-1][1](spark, docs, sf_dir)
    assert sorted(r.doc_id for r in last.collect()) == sorted(kept["mix"])


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_stages_take_any_table(spark, sf_dir, rows):
    """Nulls, empty and long texts, repeated rows, clashing names, no rows: each stage, and what it leaves for the next."""
    import corpus_pipeline as cp
    from tideline.llm.common import save

    d = docs(spark, rows)
    for name, stage in cp.STAGES:
        out = save(stage(spark, d, sf_dir), name)
        if name != "encode":
            assert out.columns == d.columns and set(map(repr, out.collect())) <= set(map(repr, d.collect()))
        # the later stages meet what the first would have removed
        d = d if name == "language" else out
    assert (out.count() > 0) == bool(rows)
