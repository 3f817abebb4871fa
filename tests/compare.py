"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows(pdf) -> list[str]:
    cols = sorted(pdf.columns)

    def plain(x):
        if x is None or type(x).__name__ in ("NAType", "NaTType") or x != x:
            return None
        if isinstance(x, float) or type(x).__name__.startswith("float"):
            x = round(float(x), 5) + 0.0
            return int(x) if x.is_integer() else x  # pandas makes floats of long columns with nulls
        if type(x).__name__ in ("int64", "int32", "Int64", "int"):
            return int(x)
        return str(x)

    return sorted(repr([plain(v) for v in r]) for r in pdf[cols].astype(object).values.tolist())


def differences(spark, con, query, sql: str, sf_dir: str) -> tuple[int, list]:
    got, want = rows(query(spark, sf_dir).toPandas()), rows(con.execute(sql).df())
    if got == want:
        return len(got), []
    a, b = [x for x in got if x not in set(want)][:2], [x for x in want if x not in set(got)][:2]
    return len(got), [("rows", len(got), len(want)), ("only ours", a), ("only SQL", b)]
