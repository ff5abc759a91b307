"""All 31 queries against their DuckDB SQL on a generated events table built
to stress ties and skew: many actions share a second, one user holds a third
of all rows, several days are empty. Dimensions are the sf0.001 tables."""

import os
import shutil
import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry_mod
from conftest import SF001
from oracle_compare import compare, duck
from shoplens.plans.queries import QUERIES as KEYS

N = 6_000
KINDS = ["view", "signup", "purchase", "click", "error"]


@pytest.fixture(scope="module")
def stress_dir():
    rng = np.random.default_rng(7)
    folder = tempfile.mkdtemp(prefix="shoplens-stress-")
    for t in ("customer", "part", "nation", "region"):
        shutil.copy(os.path.join(SF001, f"{t}.parquet"), os.path.join(folder, f"{t}.parquet"))
    hot = rng.random(N) < 1 / 3
    users = np.where(hot, 7, rng.integers(0, 150, N))
    # days 1-30 of January 2024 with gaps, seconds drawn from a small set -> many ties
    days = rng.choice([d for d in range(1, 31) if d % 7 != 3], N)
    seconds = rng.choice(np.arange(0, 86_400, 97), N) + rng.integers(0, 3, N)
    ts = pd.to_datetime("2024-01-01") + pd.to_timedelta(days - 1, "D") + pd.to_timedelta(seconds, "s") \
        + pd.to_timedelta(rng.integers(0, 1000, N), "ms")
    events = pd.DataFrame({
        "event_id": np.arange(N, dtype=np.int64),
        "ts": ts.astype("datetime64[us]"),
        "user_id": users.astype(np.int64),
        "event_type": rng.choice(KINDS, N),
        "value": rng.random(N).round(2),
        "props": [f'{{"k": {k}}}' for k in rng.integers(0, 100, N)],
    })
    pq.write_table(pa.Table.from_pandas(events, preserve_index=False), os.path.join(folder, "events.parquet"))
    return folder


@pytest.fixture(scope="module")
def stress_con(stress_dir):
    return duck(stress_dir)


QUERIES = {k: fn for k, fn in entry_mod.queries().items() if k in KEYS}  # the stress data has no corpus tables
SQL = entry_mod.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_on_stress_data(spark, stress_dir, stress_con, name):
    r = compare(QUERIES[name](spark, stress_dir), stress_con, SQL[name])
    assert r["cols_match"] and r["rows_match"], r
    assert r["values_match"], r.get("first_diffs")
