"""State of one's own per series: a running EWMA and the gaps of a stream, with late rows on the side and a timer that lets idle series go.

A series' state is one row: level, how many missing rows lie behind the level's
last value, the first row of an open gap, and the newest time. It lives in the
state store with the query's checkpoint, so a query that is stopped and started
again goes on from there. A timer in event time, moved with every batch, ends a
series that has been silent for ``idle`` hours: its open gap is told and its
state is removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tideline.session import ship

EPOCH = datetime(1970, 1, 1)
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: kind: row (with the EWMA so far), gap (missing rows from ts to until), late (not taken), expired (the series was let go).
OUT = "k string, kind string, ts timestamp, until timestamp, value double, n long"
STATE = "level double, behind long, gap_start timestamp, gap_rows long, newest timestamp"


class EwmaAndGaps(StatefulProcessor):
    """``span`` of the EWMA (not adjusted; missing rows age what lies behind them) and ``idle`` hours until a series is let go."""

    def __init__(self, span: float, idle: float):
        self.alpha, self.idle = 2 / (span + 1), idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("series", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        level, behind, gap_start, gap_rows, newest = self.state.get() if self.state.exists() else (None, 0, None, 0, None)
        out = []
        # a micro-batch's rows of one series, in order of time
        for ts, value in pd.concat(list(rows)).sort_values("ts", kind="stable")[["ts", "value"]].itertuples(index=False):
            if newest is not None and ts <= newest:
                out.append((key[0], "late", ts, None, value, 1))
                continue
            newest = ts
            if pd.isna(value):
                behind += 1
                gap_start, gap_rows = gap_start if gap_rows else ts, gap_rows + 1
            else:
                if gap_rows:
                    out.append((key[0], "gap", gap_start, ts, None, gap_rows))
                    gap_start, gap_rows = None, 0
                old = (1 - self.alpha) ** (behind + 1)
                level = value if level is None else (old * level + self.alpha * value) / (old + self.alpha)
                behind = 0
            out.append((key[0], "row", ts, None, level, 1))
        self.state.update((level, behind, gap_start, gap_rows, newest))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(((newest - EPOCH).total_seconds() + 3600 * self.idle) * 1000))
        yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = []
        if self.state.exists():
            _, _, gap_start, gap_rows, newest = self.state.get()
            if gap_rows:
                out.append((key[0], "gap", gap_start, None, None, gap_rows))
            out.append((key[0], "expired", newest, None, None, 1))
            self.state.clear()
        yield _frame(out)

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["k", "kind", "ts", "until", "value", "n"])
    return out.astype({"ts": "datetime64[us]", "until": "datetime64[us]", "value": "float64", "n": "int64"})


def ewma_and_gaps(stream: DataFrame, span: float, late: str = "2 hours", idle: float = 48.0) -> DataFrame:
    """Of a stream of k, ts, value: rows of ``OUT``. The session keeps state in RocksDB, which this operator needs."""
    spark = stream.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    # the sum is no event time to Spark, which would drop what is behind the watermark before it is told of
    rows = stream.select("k", "ts", "value").withWatermark("ts", late).select("k", (F.col("ts") + F.expr("INTERVAL 0 SECONDS")).alias("ts"), "value")
    return rows.groupBy("k").transformWithStateInPandas(EwmaAndGaps(span, idle), OUT, "append", "eventTime")
