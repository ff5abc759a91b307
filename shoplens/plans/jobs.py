"""Application entry points: compute every requirement and write its table.

``run_offline`` is the batch application (R1-R6 and the buyers' trace);
``run_streaming`` starts the ad-click queries (R7-R10). Both take the
session they are given; cluster settings stay with the deployment.

Usage::

    python -m shoplens.plans.jobs offline --testdata /root/testdata/sf0.1 --out /shared/results
    python -m shoplens.plans.jobs offline --database mydb --out /shared/results \
        --conditions '{"startDate":"2024-01-05","endDate":"2024-01-25","startAge":"15","endAge":"45"}'
    python -m shoplens.plans.jobs offline --database mydb --jdbc-url jdbc:mysql://host/db \
        --jdbc-user app --jdbc-password-env DB_PASSWORD
    python -m shoplens.plans.jobs streaming --lines /shared/ads_log --out /shared/ads --checkpoints /shared/ckpt
    python -m shoplens.plans.jobs ads-backfill --lines /shared/ads_log --out /shared/ads_batch
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from shoplens.operators import actions as act
from shoplens.operators import buyers as buy
from shoplens.operators import categories as cat
from shoplens.operators import pages as pg
from shoplens.operators import products as prod
from shoplens.operators import sessions as ses
from shoplens.params import ActionFilter, PageFlow, Params
from shoplens.sinks import use_database, write_result, write_run
from shoplens.sources.tables import Tables, from_catalog, from_testdata

Writer = Callable[[DataFrame, str], None]

# output table names of the original application
OUTPUT_TABLES = ("session_stat", "random_session_info", "category_top10", "top10_session_per_top10_cid",
                 "page_convert_rate", "area_top3_product", "visit_trace")


def offline_results(tables: Tables, params: Params) -> tuple[dict[str, DataFrame], DataFrame]:
    """All batch results as lazy DataFrames, plus the shared filtered actions.

    The filtered action set feeds five requirements; each prunes its own columns
    and filters from the scan, which is cheaper than keeping whole rows.
    """
    actions = act.filter_actions(tables.user_visit_action, tables.user_info, params.actions)
    stats = ses.session_stats(actions)
    top = cat.category_top(actions, params.top_categories, params.task_id)
    buyers = buy.top_buyers_in_one_pass(actions, params.hot_products, params.buyers_per_product)
    out = {
        "session_stat": ses.session_stat(stats, params.task_id, params.conditions_text()),
        "random_session_info": ses.session_sample(actions, stats, params.sample.size, params.task_id),
        "category_top10": top,
        "top10_session_per_top10_cid": cat.top_sessions_per_category(
            actions, top, params.sessions_per_category, params.task_id),
        "page_convert_rate": pg.page_convert_rate(actions, params.flow, params.task_id),
        "area_top3_product": prod.area_top_products(
            tables.user_visit_action, tables.city_info, params.products_per_area, params.other_label),
        "visit_trace": buy.visit_trace(actions, buyers, tables.product_info, tables.user_info, params.trace_date),
    }
    return out, actions


def run_offline(tables: Tables, params: Params, out_dir: str | None = None,
                writer: Writer | None = None, only: list[str] | None = None) -> list[str]:
    """Write each requirement's table (parquet under ``out_dir`` or a custom writer, e.g. JDBC).
    Tables under ``out_dir`` keep the runs of all task ids; a repeated run takes the place
    of the rows an earlier one of the same id wrote, whole or cut off (``sinks.write_run``).
    A custom writer appends what it is given."""
    if writer is None:
        if out_dir is None:
            raise ValueError("give out_dir or writer")
        writer = lambda df, name: write_run(df, f"{out_dir.rstrip('/')}/{name}", params.task_id)
    results, _ = offline_results(tables, params)
    names = [name for name in OUTPUT_TABLES if not only or name in only]
    for name in names:
        writer(results[name], name)
    return names


ADS_TABLES = ("ads_blacklist", "user_ads_day_counts", "area_city_ads_day", "area_ads_day", "area_top3_ads",
              "area_top3_ads_json", "last_hour_ads_trend", "ads_sliding_counts", "ads_rejected_lines")


def ads_results(lines: DataFrame, params: Params) -> dict[str, DataFrame]:
    """Batch twins of R7-R10 over a table of log lines (backfill / replay).

    Every result is a pruned scan of the lines.
    """
    from shoplens.operators import ads as ad
    from shoplens.sources.ads import parse_lines, rejected_lines

    a = params.ads
    parsed = parse_lines(lines)
    kept = ad.kept_counts(parsed, a.ban_threshold, a.batch_seconds)
    city = ad.area_city_ads_day(kept)
    area = ad.area_ads_day(kept)
    top = ad.area_top_ads(area, params.ads_per_area)
    return {
        "ads_blacklist": ad.ads_blacklist(parsed, a.ban_threshold, a.batch_seconds),
        "user_ads_day_counts": ad.user_ads_day_counts(kept),
        "area_city_ads_day": city,
        "area_ads_day": area,
        "area_top3_ads": top,
        "area_top3_ads_json": ad.area_top_ads_json(top),
        "last_hour_ads_trend": ad.last_hour_ads_trend(ad.last_hour_ads_minutes(parsed, a.trend_minutes)),
        "ads_sliding_counts": ad.ads_sliding_counts(parsed, a.sliding_window, a.sliding_slide),
        "ads_rejected_lines": rejected_lines(lines),
    }


def run_ads_backfill(lines: DataFrame, params: Params, out_dir: str | None = None,
                     writer: Writer | None = None) -> list[str]:
    """Write every ads table computed in batch from log lines (column ``line``)."""
    if writer is None:
        if out_dir is None:
            raise ValueError("give out_dir or writer")
        writer = lambda df, name: write_result(df, f"{out_dir.rstrip('/')}/{name}", mode="overwrite")
    results = ads_results(lines, params)
    for name in ADS_TABLES:
        writer(results[name], name)
    return list(ADS_TABLES)


def run_streaming(spark: SparkSession, lines_path: str, out_dir: str, checkpoints: str | None, params: Params,
                  kafka_servers: str | None = None, trigger: dict | None = None, topic: str = "ads_log",
                  starting_offsets: str = "latest", max_per_trigger: int | None = None, close: bool = False):
    """Start the ad-click query; checkpoints default to ``spark.checkpoint.dir``. ``max_per_trigger``
    limits what a micro-batch takes in (files, or Kafka records)."""
    import os

    from shoplens.session import checkpoint_dir
    from shoplens.sources.ads import file_lines, kafka_lines
    from shoplens.streaming import app

    if checkpoints is None:
        checkpoints = os.path.join(checkpoint_dir(spark), "shoplens-streams")

    if kafka_servers:
        factory = lambda: kafka_lines(spark, kafka_servers, topic, starting_offsets, max_per_trigger)
    else:
        factory = lambda: file_lines(spark, lines_path, max_per_trigger)
    return app.run_pipeline(spark, factory, app.Paths(out_dir, checkpoints), params.ads, trigger, close=close,
                            k=params.ads_per_area)


ADS_OPTIONS = ("ban_threshold", "batch_seconds", "trend_minutes", "sliding_window", "sliding_slide",
               "settle_seconds", "max_lead_seconds")
RANKING_OPTIONS = ("top_categories", "sessions_per_category", "hot_products", "buyers_per_product",
                   "products_per_area", "ads_per_area")


def _positive(text: str) -> int:
    n = int(text)
    if n < 1:
        raise argparse.ArgumentTypeError("must be at least 1")
    return n


def _params(ns) -> Params:
    """Options of the command line; those a command doesn't know are errors there."""
    given = vars(ns)
    params = Params.from_json(given.get("conditions") or "")
    changes: dict = {"task_id": given.get("task_id") or uuid.uuid4().hex}
    if given.get("page_flow"):
        changes["flow"] = PageFlow.parse(given["page_flow"])
    if given.get("trace_date"):
        changes["trace_date"] = given["trace_date"]
    if given.get("sample_size"):
        changes["sample"] = replace(params.sample, size=given["sample_size"])
    ads = {k: given[k] for k in ADS_OPTIONS if given.get(k) is not None}
    if ads:
        changes["ads"] = replace(params.ads, **ads)
    changes |= {k: given[k] for k in RANKING_OPTIONS if given.get(k)}
    return replace(params, **changes)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="shoplens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    off = sub.add_parser("offline")
    src = off.add_mutually_exclusive_group(required=True)
    src.add_argument("--testdata")
    src.add_argument("--database")
    off.add_argument("--out", default=None, help="folder for parquet result tables")
    off.add_argument("--jdbc-url", default=None, help="append result tables over JDBC instead (K1)")
    off.add_argument("--jdbc-user", default=None)
    off.add_argument("--jdbc-password-env", default=None, help="name of the environment variable with the password")
    off.add_argument("--conditions", default="")
    off.add_argument("--page-flow", default="")
    off.add_argument("--trace-date", default="")
    off.add_argument("--task-id", default="", help="default: a new random id for each run")
    off.add_argument("--sample-size", type=int, default=0)
    for name in RANKING_OPTIONS[:-1]:
        off.add_argument("--" + name.replace("_", "-"), type=_positive, default=None, help="how many are ranked")
    bf = sub.add_parser("ads-backfill")
    bf.add_argument("--lines", required=True)
    bf.add_argument("--out", required=True)
    st = sub.add_parser("streaming")
    st.add_argument("--lines", default="")
    st.add_argument("--kafka", default=None)
    st.add_argument("--out", required=True)
    st.add_argument("--checkpoints", default=None, help="default: <spark.checkpoint.dir>/shoplens-streams")
    st.add_argument("--topic", default="ads_log")
    st.add_argument("--starting-offsets", default="latest", help="latest, earliest, or offsets per partition as JSON")
    st.add_argument("--max-per-trigger", type=int, default=None, help="files (or Kafka records) a micro-batch takes in")
    st.add_argument("--settle-seconds", type=int, default=None, help="a slot is judged this long after its end")
    st.add_argument("--max-lead-seconds", type=int, default=None, help="rows dated further ahead of arrival are rejected")
    st.add_argument("--available-now", action="store_true", help="take in what is there, then stop")
    st.add_argument("--close", action="store_true", help="with --available-now: judge the last slots too")
    for cmd in (bf, st):
        cmd.add_argument("--ban-threshold", type=int, default=None)
        cmd.add_argument("--batch-seconds", type=int, default=None, help="slot of the ban rule, and the stream's trigger")
        cmd.add_argument("--trend-minutes", type=int, default=None)
        cmd.add_argument("--sliding-window", default=None)
        cmd.add_argument("--sliding-slide", default=None)
        cmd.add_argument("--ads-per-area", type=_positive, default=None)
    ns = ap.parse_args(argv)

    from shoplens.session import build_session
    spark = build_session()
    params = _params(ns)
    if ns.cmd == "offline":
        use_database(spark, ns.database)
        tables = from_testdata(spark, ns.testdata) if ns.testdata else from_catalog(spark, ns.database)
        writer = None
        if ns.jdbc_url:
            import os

            from shoplens.sinks import write_jdbc
            password = os.environ.get(ns.jdbc_password_env) if ns.jdbc_password_env else None
            writer = lambda df, name: write_jdbc(df, ns.jdbc_url, name, ns.jdbc_user, password)
        elif not ns.out:
            ap.error("offline needs --out or --jdbc-url")
        print(run_offline(tables, params, ns.out, writer))
    elif ns.cmd == "ads-backfill":
        lines = spark.read.text(ns.lines).withColumnRenamed("value", "line")
        print(run_ads_backfill(lines, params, ns.out))
    else:
        run_streaming(spark, ns.lines, ns.out, ns.checkpoints, params, ns.kafka,
                      {"availableNow": True} if ns.available_now else None, ns.topic, ns.starting_offsets,
                      ns.max_per_trigger, ns.close).awaitTermination()


if __name__ == "__main__":
    main()
