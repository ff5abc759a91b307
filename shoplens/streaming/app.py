"""Ad-click streaming pipeline (R7-R10) on Structured Streaming.

One query reads the source once a micro-batch (T6) and brings a set of versioned tables (see
``versions``) from one version to the next:

1.  ``ads_log``: the parsed lines, written ahead of everything else with the reason for which a line
    is not taken: ``malformed``, ``ahead`` (dated further after its arrival than a clock may
    go wrong; it can't move the newest time) or ``late`` (its slot is judged). Taken and
    rejected lines together are all lines. All later steps read this table.
2.  ``last_hour_minutes``, ``last_hour_ads_trend`` (K8, R10): the newest 60 minute counters of each
    ad, and their JSON, over all clicks in time, filtered or not.
3.  Slots that the newest click is ``settle_seconds`` past are judged (see ``bans``):
    ``ads_blacklist`` (K10) gains users, ``kept`` the rows that pass (T9), ``user_ads_day_counts`` (K9) and
    ``area_city_ads_day`` (K6, T10) their counts, ``area_top3_ads`` and its JSON (K7) are
    made anew for the days concerned.
4.  ``ads_sliding_counts`` (T11): windows whose slots are all judged, as stretches of window
    starts with one count; ``sliding_points`` holds the changes still to come.
5.  The manifest is switched. A run that dies before leaves nothing that counts, and
    the micro-batch is repeated; one that dies after is not repeated, as the version says which
    micro-batch it holds. Readers see all tables at one version.

What a micro-batch reads does not grow with the batches before it: logs by version, days by
at most ``versions.MERGE`` folders, and of the log only batches with rows not judged yet.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoplens.operators import ads as ad
from shoplens.params import ADS_PER_AREA, AdsParams
from shoplens.sources.ads import ADS_COLUMNS, parse_lines
from shoplens.streaming.bans import BANS_SCHEMA, judged, new_bans
from shoplens.streaming.versions import Manifest, Versions

TOTAL_KEYS = ["day", "area", "city", "ads_id"]
LOG_SCHEMA = "ts timestamp, day string, area string, city string, user_id string, ads_id string, line string, " \
             "slot bigint, reason string"
KEPT_SCHEMA = "ts timestamp, day string, area string, city string, user_id string, ads_id string, slot bigint"
TOTALS_SCHEMA = "area string, city string, ads_id string, click_count bigint, day string"
USER_COUNTS_SCHEMA = "user_id string, ads_id string, click_count bigint, day string"
TOP_SCHEMA = "area string, ads_id string, click_count bigint, rank bigint, day string"
TOP_JSON_SCHEMA = "area string, top3_json string, day string"
MINUTES_SCHEMA = "ads_id string, minute_ms bigint, click_count bigint"
TREND_SCHEMA = "ads_id string, trend_json string"
POINTS_SCHEMA = "ads_id string, start_ms bigint, change bigint"
INTERVALS_SCHEMA = "ads_id string, from_ms bigint, until_ms bigint, click_count bigint"
TAKEN, LATE = "ok", "late"
MINUTE_MS = 60_000


@dataclass(frozen=True)
class Paths:
    out: str
    checkpoints: str

    def ckpt(self, name: str) -> str:
        return os.path.join(self.checkpoints, name)


# ------------------------------------------------------------------ readers

def kept_rows(spark: SparkSession, paths: Paths) -> DataFrame:
    """The clicks of judged slots that passed the blacklist."""
    return Versions(spark, paths.out).read_log("kept", KEPT_SCHEMA)


def log_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """Every line read, parsed where it could be, with its reason (``ok`` if it was taken)."""
    return Versions(spark, paths.out).read_log("ads_log", LOG_SCHEMA)


def rejected_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    return log_lines(spark, paths).filter(F.col("reason") != TAKEN).select("line", "reason")


def current_totals(spark: SparkSession, paths: Paths, days: list[str] | None = None) -> DataFrame:
    """K6: clicks per (day, area, city, ad); ``days`` prunes the read."""
    return _total(Versions(spark, paths.out).read("area_city_ads_day", TOTALS_SCHEMA, parts=days), TOTAL_KEYS)


def current_user_counts(spark: SparkSession, paths: Paths, days: list[str] | None = None) -> DataFrame:
    """K9: kept clicks per (day, user, ad)."""
    return _total(Versions(spark, paths.out).read("user_ads_day_counts", USER_COUNTS_SCHEMA, parts=days), ad.DAY_USER_AD)


def current_blacklist(spark: SparkSession, paths: Paths) -> DataFrame:
    """Banned users and the slot that banned them."""
    return _bans(Versions(spark, paths.out).read("ads_blacklist", BANS_SCHEMA))


def current_top_ads(spark: SparkSession, paths: Paths) -> DataFrame:
    return Versions(spark, paths.out).read("area_top3_ads", TOP_SCHEMA)


def current_top_ads_json(spark: SparkSession, paths: Paths) -> DataFrame:
    return Versions(spark, paths.out).read("area_top3_ads_json", TOP_JSON_SCHEMA)


def current_trend(spark: SparkSession, paths: Paths) -> DataFrame:
    """K8: the last hour's JSON per ad."""
    return Versions(spark, paths.out).read("last_hour_ads_trend", TREND_SCHEMA)


def sliding_counts(spark: SparkSession, paths: Paths, params: AdsParams) -> DataFrame:
    """One row per complete window and ad with clicks."""
    found = Versions(spark, paths.out).read_log("ads_sliding_counts", INTERVALS_SCHEMA)
    return ad.sliding_windows(found, params.sliding_window, params.sliding_slide)


def _total(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("click_count").alias("click_count"))


def _bans(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id").agg(F.min("ban_slot").alias("ban_slot"))


# ------------------------------------------------------------------ one micro-batch

def classified(lines: DataFrame, params: AdsParams, judged_to: int | None) -> DataFrame:
    """Parsed lines with their slot and the reason for which a line is not taken."""
    parsed = parse_lines(lines, keep_rejects=True)
    slot = F.floor(F.unix_millis("ts") / F.lit(params.batch_seconds * 1000)).cast("bigint")
    reason = F.when(~F.col("ok"), "malformed")
    if "arrival" in parsed.columns:
        lead = F.unix_millis("ts") - F.unix_millis("arrival") > F.lit(params.max_lead_seconds * 1000)
        reason = reason.when(F.coalesce(lead, F.lit(False)), "ahead")
    if judged_to is not None:
        reason = reason.when(slot < F.lit(judged_to), LATE)
    return parsed.select(*ADS_COLUMNS, "line", slot.alias("slot"), reason.otherwise(TAKEN).alias("reason"))


def _days(df: DataFrame) -> list[str]:
    """The days of some settled slots: as many as a batch spans."""
    return sorted(r["day"] for r in df.select("day").distinct().collect())


def _last_hour(store: Versions, draft: Manifest, fresh: DataFrame, minutes: int) -> None:
    newest = draft.state["newest_ms"] // MINUTE_MS * MINUTE_MS
    minute = (F.floor(F.unix_millis("ts") / F.lit(MINUTE_MS)) * F.lit(MINUTE_MS)).cast("bigint")
    counts = fresh.groupBy("ads_id", minute.alias("minute_ms")).agg(F.count(F.lit(1)).alias("click_count"))
    ring = store.read("last_hour_minutes", MINUTES_SCHEMA, draft).unionByName(counts) \
        .filter(F.col("minute_ms") > F.lit(newest - minutes * MINUTE_MS)) \
        .groupBy("ads_id", "minute_ms").agg(F.sum("click_count").alias("click_count"))
    store.replace(draft, "last_hour_minutes", ring, [""])
    labelled = store.read("last_hour_minutes", MINUTES_SCHEMA, draft) \
        .withColumn("minute", F.date_format(F.timestamp_millis("minute_ms"), "HH:mm"))
    store.replace(draft, "last_hour_ads_trend", ad.last_hour_ads_trend(labelled), [""])


def _judge(store: Versions, draft: Manifest, due: DataFrame, params: AdsParams, first: int, k: int) -> None:
    banned = _bans(store.read("ads_blacklist", BANS_SCHEMA, draft))
    so_far = store.read("user_ads_day_counts", USER_COUNTS_SCHEMA, draft, _days(due))
    store.add(draft, "ads_blacklist", BANS_SCHEMA, new_bans(due, so_far, banned, params.ban_threshold, first),
              ["user_id"], "ban_slot", [""], F.min)
    passed = judged(due, _bans(store.read("ads_blacklist", BANS_SCHEMA, draft)))
    store.log(draft, "kept", passed.select(*ADS_COLUMNS, "slot"))
    kept = store.read_log("kept", KEPT_SCHEMA, [draft.batch], draft)
    days = _days(kept)
    if not days:
        return
    store.add(draft, "user_ads_day_counts", USER_COUNTS_SCHEMA, ad.user_ads_day_counts(kept), ad.DAY_USER_AD,
              "click_count", days)
    store.add(draft, "area_city_ads_day", TOTALS_SCHEMA, ad.area_city_ads_day(kept), TOTAL_KEYS, "click_count", days)
    totals = store.read("area_city_ads_day", TOTALS_SCHEMA, draft, days)
    store.replace(draft, "area_top3_ads", ad.area_top_ads(ad.area_ads_day(totals), k), days)
    top = store.read("area_top3_ads", TOP_SCHEMA, draft, days)
    store.replace(draft, "area_top3_ads_json", ad.area_top_ads_json(top), days)


def _slide(store: Versions, draft: Manifest, due: DataFrame, params: AdsParams, until_ms: int) -> None:
    """Give out the windows that end by ``until_ms``; keep each ad's sum and its changes from there on."""
    w_ms, s_ms = ad.window_millis(params.sliding_window, params.sliding_slide)
    end = (until_ms - w_ms) // s_ms * s_ms + s_ms  # the first window start that is not complete
    points = store.read("sliding_points", POINTS_SCHEMA, draft) \
        .unionByName(ad.sliding_points(due, params.sliding_window, params.sliding_slide))
    draft_points = points.groupBy("ads_id", F.greatest("start_ms", F.lit(end)).alias("start_ms")) \
        .agg(F.sum("change").alias("change")).filter("change <> 0")
    past = ad.sliding_intervals(points.filter(F.col("start_ms") < F.lit(end)))
    store.log(draft, "ads_sliding_counts", past.withColumn("until_ms", F.coalesce("until_ms", F.lit(end))).filter("click_count > 0"))
    store.replace(draft, "sliding_points", draft_points, [""])


def _settle(store: Versions, draft: Manifest, params: AdsParams, until: int, k: int) -> list:
    """What there is to do to judge all slots below ``until`` that are not judged yet."""
    state = draft.state
    pending = state.setdefault("pending", {})
    first = state.get("judged_to")
    if first is not None and until <= first:
        return []
    batches = [int(v) for v, (low, _) in pending.items() if low < until]
    due = store.read_log("ads_log", LOG_SCHEMA, batches, draft) \
        .filter((F.col("reason") == TAKEN) & (F.col("slot") < F.lit(until)))
    if first is not None:
        due = due.filter(F.col("slot") >= F.lit(first))
    if first is None:
        first = min((low for low, _ in pending.values()), default=until)
    state["judged_to"] = until
    state["pending"] = {v: span for v, span in pending.items() if span[1] >= until}
    steps = [lambda: _slide(store, draft, due, params, until * params.batch_seconds * 1000)]
    return steps + ([lambda: _judge(store, draft, due, params, first, k)] if batches else [])


def _run(steps: list) -> None:
    """Steps on tables of their own, side by side: each is a few short jobs."""
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        for done in [pool.submit(s) for s in steps]:
            done.result()


def process(store: Versions, lines: DataFrame, stream_batch: int, params: AdsParams, k: int = ADS_PER_AREA) -> None:
    """Bring all tables to the next version with the lines of one micro-batch."""
    draft = store.next()
    state = draft.state
    if state.get("stream_batch", -1) >= stream_batch:
        return  # committed before the run ended; the stream did not get to know
    state["stream_batch"] = stream_batch
    store.log(draft, "ads_log", classified(lines, params, state.get("judged_to")), "reason")
    fresh = store.read_log("ads_log", LOG_SCHEMA, [draft.batch], draft)
    found = {r["reason"]: r for r in fresh.groupBy("reason").agg(
        F.max(F.unix_millis("ts")).alias("newest"), F.min("slot").alias("low"), F.max("slot").alias("high")).collect()}
    in_time = [found[r] for r in (TAKEN, LATE) if r in found]
    steps = []
    if in_time:
        state["newest_ms"] = max([state.get("newest_ms", 0), *(r["newest"] for r in in_time)])
        clicks = fresh.filter(F.col("reason").isin(TAKEN, LATE))
        steps.append(lambda: _last_hour(store, draft, clicks, params.trend_minutes))
    if TAKEN in found:
        state.setdefault("pending", {})[str(draft.batch)] = [found[TAKEN]["low"], found[TAKEN]["high"]]
        settled_ms = state["newest_ms"] - params.settle_seconds * 1000
        steps += _settle(store, draft, params, settled_ms // (params.batch_seconds * 1000), k)
    _run(steps)
    store.commit(draft)


def settle_rest(spark: SparkSession, paths: Paths, params: AdsParams, k: int = ADS_PER_AREA) -> None:
    """Judge every slot read so far, at the end of a log that has an end. Rows of these
    slots that come later are late."""
    store = Versions(spark, paths.out)
    draft = store.next()
    pending = draft.state.get("pending", {})
    if pending:
        _run(_settle(store, draft, params, max(high for _, high in pending.values()) + 1, k))
        store.commit(draft)


# ------------------------------------------------------------------ the query

def run_pipeline(spark: SparkSession, lines_factory, paths: Paths, params: AdsParams, trigger: dict | None = None,
                 timeout: float | None = None, close: bool = False, k: int = ADS_PER_AREA) -> StreamingQuery:
    """Start the query over ``lines_factory()``, a streaming DataFrame of log lines (line, and
    arrival where it is known). It runs every ``batch_seconds``, a slot's length, unless
    ``trigger`` says otherwise. With an ``availableNow`` trigger it is waited for, and ``close``
    judges the last slots too.
    """
    store = Versions(spark, paths.out)
    query = (lines_factory().writeStream.outputMode("append")
             .option("checkpointLocation", paths.ckpt("ads"))
             .trigger(**(trigger or {"processingTime": f"{params.batch_seconds} seconds"}))
             .foreachBatch(lambda df, n: process(store, df, n, params, k)).start())
    if trigger and trigger.get("availableNow"):
        query.awaitTermination(timeout)
        if close:
            settle_rest(spark, paths, params, k)
    return query
