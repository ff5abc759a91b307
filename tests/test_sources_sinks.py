"""Catalog source, sinks and the batch application runner."""

import os
from dataclasses import replace

from pyspark.sql import functions as F

from conftest import SF001
from shoplens.params import ActionFilter, PageFlow
from shoplens.plans import jobs
from shoplens.plans.queries import FIXTURE
from shoplens.sinks import register_view, replace_table, use_database, write_result
from shoplens.sources.tables import from_catalog, from_testdata


def test_catalog_tables_round_trip(spark, scratch):
    db = "shoplens_test_db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{os.path.join(scratch, 'wh')}'")
    t = from_testdata(spark, SF001)
    # the original stores action_time as text and has no event id
    uva = t.user_visit_action.withColumn("action_time", F.date_format("action_time", "yyyy-MM-dd HH:mm:ss")) \
        .drop("event_id")
    replace_table(uva, f"{db}.user_visit_action")
    replace_table(t.user_info, f"{db}.user_info")
    replace_table(t.product_info, f"{db}.product_info")
    replace_table(t.city_info, f"{db}.city_info")
    c = from_catalog(spark, db)
    a = c.user_visit_action
    assert dict(a.dtypes)["action_time"] == "timestamp_ntz" and "event_id" in a.columns
    assert a.count() == 1000
    # the tie-break id is a pure function of the row
    assert a.select("event_id").distinct().count() == a.count()
    res, shared = jobs.offline_results(c, FIXTURE)
    try:
        assert res["category_top10"].count() == 10
    finally:
        shared.unpersist()


def test_result_writer_and_view(spark, scratch):
    df = spark.createDataFrame([("2024-01-01", "a", 1), ("2024-01-02", "b", 2)], "day string, k string, v bigint")
    write_result(df, os.path.join(scratch, "r"))
    assert spark.read.parquet(os.path.join(scratch, "r")).count() == 2
    register_view(df, "tmp_view")
    register_view(df, "tmp_view")  # a second run re-registers
    assert spark.table("tmp_view").count() == 2


def test_database_is_selected_and_its_tables_read(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shoplens_s5")
    try:
        replace_table(spark.createDataFrame([(1, "x")], "a int, b string"), "shoplens_s5.s5_table")
        use_database(spark, None)  # no database named: the current one stays
        assert spark.catalog.currentDatabase() == "default"
        use_database(spark, "shoplens_s5")
        assert [tuple(r) for r in spark.table("s5_table").collect()] == [(1, "x")]
    finally:
        use_database(spark, "default")
        spark.sql("DROP DATABASE IF EXISTS shoplens_s5 CASCADE")


def test_offline_application_writes_all_tables(spark, scratch):
    out = os.path.join(scratch, "results")
    written = jobs.run_offline(from_testdata(spark, SF001), FIXTURE, out)
    assert written == list(jobs.OUTPUT_TABLES)
    assert spark.read.parquet(os.path.join(out, "category_top10")).count() == 10
    assert spark.read.parquet(os.path.join(out, "session_stat")).count() == 1


def test_a_repeated_run_replaces_its_own_rows_only(spark, scratch):
    out, tables, two = os.path.join(scratch, "runs"), from_testdata(spark, SF001), ["category_top10", "page_convert_rate"]
    first, second = replace(FIXTURE, task_id="1e5"), replace(FIXTURE, task_id="1e6")
    jobs.run_offline(tables, first, out, only=two[:1])  # cut off before its second table
    jobs.run_offline(tables, second, out, only=two)
    jobs.run_offline(tables, first, out, only=two)
    jobs.run_offline(tables, first, out, only=two)
    for name, n in zip(two, (10, 6)):
        rows = spark.read.parquet(os.path.join(out, name)).groupBy("task_id", "run").count().collect()
        assert {tuple(r) for r in rows} == {("1e5", "run-1e5", n), ("1e6", "run-1e6", n)}


def test_params_parsing():
    f = ActionFilter.from_json('{"startDate":"2024-01-05","endDate":"","startAge":"15","gender":null}')
    assert (f.start_date, f.end_date, f.start_age, f.end_age, f.gender) == ("2024-01-05", None, 15, None, None)
    assert PageFlow.parse("1,2,3,").jump_labels == ["1_2", "2_3"]
    assert ActionFilter.from_json(FIXTURE.actions.to_json()) == FIXTURE.actions


def test_ads_backfill_writes_all_tables(spark, scratch):
    from shoplens.sources.tables import ads_log_lines

    out = os.path.join(scratch, "ads")
    written = jobs.run_ads_backfill(ads_log_lines(spark, SF001), FIXTURE, out)
    assert written == list(jobs.ADS_TABLES)
    assert spark.read.parquet(os.path.join(out, "area_top3_ads_json")).count() > 0
    assert spark.read.parquet(os.path.join(out, "ads_rejected_lines")).count() == 0


def test_cli_offline(spark, scratch):
    out = os.path.join(scratch, "cli")
    jobs.main(["offline", "--testdata", SF001, "--out", out,
               "--conditions", '{"startDate":"2024-01-05","endDate":"2024-01-25","startAge":"15","endAge":"45"}',
               "--page-flow", "1,2,3,4,5,6,7", "--trace-date", "2024-01-15",
               "--top-categories", "4", "--products-per-area", "2"])
    assert spark.read.parquet(os.path.join(out, "category_top10")).count() == 4
    per_area = spark.read.parquet(os.path.join(out, "area_top3_product")).groupBy("area").count().collect()
    assert per_area and max(r["count"] for r in per_area) == 2
    rates = spark.read.parquet(os.path.join(out, "page_convert_rate"))
    assert rates.count() == 6
    assert set(os.listdir(out)) >= set(jobs.OUTPUT_TABLES)


def test_cli_offline_needs_a_target():
    import pytest as _pytest
    with _pytest.raises(SystemExit):
        jobs.main(["offline", "--testdata", SF001])
