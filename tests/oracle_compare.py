"""Side-by-side check of a Spark query and its DuckDB SQL on the driver tables."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
USED = ["region", "nation", "customer", "part", "events"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in USED:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    got = spark_df.toPandas()
    want = con.execute(sql).df()
    out = {"spark_rows": len(got), "oracle_rows": len(want),
           "spark_cols": sorted(got.columns), "oracle_cols": sorted(want.columns)}
    out["cols_match"] = out["spark_cols"] == out["oracle_cols"]
    out["rows_match"] = len(got) == len(want)
    if out["cols_match"] and len(want) > 200_000 and out["rows_match"]:
        # large results of texts and whole numbers: compared as sorted columns
        g, w = (d[out["spark_cols"]].sort_values(out["spark_cols"], ignore_index=True) for d in (got, want))
        out["values_match"] = all((g[c].to_numpy() == w[c].to_numpy()).all() for c in out["spark_cols"])
    elif out["cols_match"]:
        g, w = _rows(got), _rows(want)
        out["values_match"] = g == w
        if not out["values_match"]:
            diff = [(a, b) for a, b in zip(g, w) if a != b][:3]
            out["first_diffs"] = diff
    else:
        out["values_match"] = False
    return out
