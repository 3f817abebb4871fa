from datetime import datetime, timedelta

import pytest

from tideline.session import scratch
from tideline.streaming import jobs, stateful

START = datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp, value double"


def at(hours):
    return START + timedelta(hours=hours)


@pytest.fixture
def stream(spark):
    """Runs the operator over each part in turn, stopping in between; gives all it has put out."""
    base = scratch(spark)

    def run(*parts, **options):
        for part in parts:
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
            q = stateful.ewma_and_gaps(spark.readStream.schema(SCHEMA).parquet(f"{base}/in"), 3, **options)
            jobs.append_stream(q, f"{base}/out", f"{base}/ck").awaitTermination()
        rows = spark.read.schema(stateful.OUT).parquet(f"{base}/out").collect()
        return sorted((r.k, r.kind, r.ts, r.until, r.value, r.n) for r in rows if r.kind != "row"), {(r.k, r.ts): r.value for r in rows if r.kind == "row"}

    return run


def test_restart_in_a_gap_and_late_rows(stream):
    """State outlives the query; rows at or behind a series' newest time are told of, far behind the watermark too."""
    values = [1.0, 2.0, None, None, 5.0, 7.0]
    rows = [("a", at(i), v) for i, v in enumerate(values)]
    other, ewma = stream(rows[:3], [*rows[3:], ("a", at(0), 9.0), ("a", at(2), 9.0), ("b", at(1), None)])
    assert [round(ewma["a", at(i)], 9) for i in range(6)] == [1, 1.5, 1.5, 1.5, 4.3, 5.65] and ewma["b", at(1)] is None
    assert other == [("a", "gap", at(2), at(4), None, 2), ("a", "late", at(0), None, 9.0, 1), ("a", "late", at(2), None, 9.0, 1)]


def test_silent_series_are_let_go(stream):
    """Its open gap is told, its state removed: what comes later begins anew."""
    later = [("b", at(100 + i), 1.0) for i in range(3)]
    other, ewma = stream([("a", at(0), 4.0), ("a", at(1), None), ("b", at(0), 1.0)], later, [("b", at(104), 1.0), ("a", at(103), 8.0)], idle=24.0)
    assert ("a", "gap", at(1), None, None, 1) in other and ("a", "expired", at(1), None, None, 1) in other
    assert ewma["a", at(103)] == 8.0 and ewma["b", at(104)] == 1.0
