import random
from pathlib import Path

from tests.llm.helpers import find_groups
from tideline.llm import common

MANY = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def roots(spark, edges):
    return {(r.id, r.root) for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}


def test_against_brute_force(spark):
    rnd = random.Random(5)
    for edges in ([], [(4, 4)], [(9, 3), (3, 9)], [(70, i) for i in range(60)], [(rnd.randrange(80), rnd.randrange(80)) for _ in range(50)]):
        both = {frozenset(e) for e in edges}
        group = find_groups(80, lambda i, j: frozenset((i, j)) in both)  # noqa: B023
        assert roots(spark, edges) == {(i, g) for i, g in enumerate(group) if i != g}


def test_rounds_over_few_edges_write_few_files(spark, monkeypatch):
    """Not a file a shuffle partition: with 211 of these, rounds over 2,000 edges took 4 s a table."""
    files, save = [], common.save

    def counted(df, name="t"):
        out = save(df, name)
        files.append(len(list(Path(out._saved_at.removeprefix("file:")).glob("part-*"))))
        return out

    monkeypatch.setattr(common, "save", counted)
    before = {k: spark.conf.get(k, None) for k in MANY}
    try:
        for k, v in MANY.items():
            spark.conf.set(k, v)
        assert roots(spark, [(i, i + 500) for i in range(1500)]) == {(i, i % 500) for i in range(500, 2000)}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(files) >= 3 and max(files[1:]) <= spark.sparkContext.defaultParallelism


def test_goes_on_from_stars(spark):
    """Edges that join found components give what all edges at once give."""
    rnd = random.Random(6)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)]
    first = common.components(spark.createDataFrame(edges[:150], "a long, b long")).toDF("a", "b")
    got = common.components(first.unionByName(spark.createDataFrame(edges[150:], "a long, b long")))
    assert {tuple(r) for r in got.collect()} == roots(spark, edges)
