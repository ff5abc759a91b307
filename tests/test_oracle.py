"""Every registered query equals its DuckDB SQL on the sf0.01 tables."""

import pytest

import __spark_entry__ as entry_mod
from conftest import SF01
from oracle_compare import compare, duck

from shoplens.plans.queries import QUERIES as KEYS

# the optional corpus queries have tests of their own
QUERIES = {k: fn for k, fn in entry_mod.queries().items() if k in KEYS}
SQL = {k: sql for k, sql in entry_mod.oracle_sql().items() if k in KEYS}


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)
    assert len(QUERIES) == 31


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF01), con, SQL[name])
    assert r["cols_match"], r
    assert r["rows_match"], r
    assert r["values_match"], r.get("first_diffs")
    assert r["spark_rows"] > 0


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert df.columns == ["task_id", "category_id", "click_count", "order_count", "pay_count"]


DUCK_TYPES = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_output_types_match_oracle(spark, con, name):
    spark_types = dict(QUERIES[name](spark, SF01).dtypes)
    rel = con.sql(SQL[name])
    duck_types = {c: DUCK_TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types
    assert set(spark_types.values()) <= {"bigint", "double", "string"}


SESSION_VARIANT_KEYS = ["page_jump_counts", "page_convert_rate", "session_info", "session_sample",
                        "ads_blacklist", "area_top3_ads_json", "area_product_city_remark", "category_top10"]


@pytest.mark.parametrize("name", SESSION_VARIANT_KEYS)
def test_results_do_not_depend_on_session_settings(spark, con, name):
    """ANSI off and 200 shuffle partitions (200 range partitions for the jumps)."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.ansi.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.ansi.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        r = compare(QUERIES[name](spark, SF01), con, SQL[name])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert r["cols_match"] and r["rows_match"] and r["values_match"], r.get("first_diffs")
