"""R7-R10 over a table of parsed ad clicks (batch twins of the streams).

The stream processes micro-batches; here a row's batch is the
``batch_seconds`` slot of its time, which is what a replay of the log at
that trigger interval produces. All results equal what the stream writes at
the end of the replay (see tests/test_streaming.py).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.core import TS_FORMAT, json_pairs
from shoplens.operators.common import top_k_per_group

DAY_USER_AD = ["day", "user_id", "ads_id"]


def with_batch(ads: DataFrame, batch_seconds: int) -> DataFrame:
    """The micro-batch a row falls in when the log is replayed at that interval."""
    return ads.withColumn("batch_id", F.floor(F.unix_millis("ts") / F.lit(batch_seconds * 1000)).cast("bigint"))


SLOT_KEYS = [*DAY_USER_AD, "batch_id"]


def slot_counts(ads: DataFrame, batch_seconds: int) -> DataFrame:
    """Clicks per (day, user, ad, batch), what bans are judged by. Partial
    aggregation reduces hot keys before the shuffle."""
    return with_batch(ads, batch_seconds).filter(F.col("user_id").isNotNull()) \
        .groupBy(*SLOT_KEYS).agg(F.count(F.lit(1)).alias("n"))


def ban_candidates(ads: DataFrame, threshold: int) -> DataFrame:
    """Users of any (day, user, ad) that reaches the threshold: nobody else can be
    banned. One partial aggregation of three keys; the list is short."""
    return ads.groupBy(*DAY_USER_AD).agg(F.count(F.lit(1)).alias("_total")) \
        .filter(F.col("_total") >= F.lit(threshold)).select("user_id").distinct()


def ban_batches(ads: DataFrame, threshold: int, batch_seconds: int) -> DataFrame:
    """Ban batch of each banned user; slots and their window are made for candidates only."""
    mine = ads.join(ban_candidates(ads, threshold), "user_id", "left_semi")
    return ban_batches_of(slot_counts(mine, batch_seconds), threshold)


def ban_batches_of(counts: DataFrame, threshold: int) -> DataFrame:
    """T9 closed form: the batch in which each banned user is banned.

    Until the ban nothing of a user is filtered, so a (day, user, ad) reaches
    the threshold in the first batch whose running count does; the user is
    banned in the earliest such batch, which still passes whole. The running
    count is a window over slot counts, so its size is bounded by the slots
    of the group's day, never by clicks.
    """
    # range frame: the running count of a batch includes every slot of that
    # batch (one row per area/city of it), so the rows per window partition are
    # bounded by (cities x batches per day)
    w = Window.partitionBy("day", "user_id", "ads_id").orderBy("batch_id") \
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reached = counts.withColumn("_run", F.sum("n").over(w)).filter(F.col("_run") >= F.lit(threshold))
    return reached.groupBy("user_id").agg(F.min("batch_id").alias("ban_batch"))


def ads_blacklist(ads: DataFrame, threshold: int, batch_seconds: int) -> DataFrame:
    """Banned users with the batch (and its start time) that banned them."""
    ban = ban_batches(ads, threshold, batch_seconds)
    return ban.select(
        "user_id", "ban_batch",
        F.date_format(F.timestamp_millis(F.col("ban_batch") * F.lit(batch_seconds * 1000)), TS_FORMAT)
        .alias("banned_from"),
    )


def _passes(df: DataFrame, ban: DataFrame) -> DataFrame:
    # the blacklist is joined by user; it is not assumed small (AQE may
    # broadcast it at run time and splits skewed users otherwise)
    return df.join(ban, "user_id", "left").filter(
        F.col("ban_batch").isNull() | (F.col("batch_id") <= F.col("ban_batch"))).drop("ban_batch")


def ads_filtered(ads: DataFrame, threshold: int, batch_seconds: int) -> DataFrame:
    """Rows that pass the blacklist (up to and including the ban batch)."""
    ban = ban_batches(ads, threshold, batch_seconds)
    kept = _passes(with_batch(ads, batch_seconds), ban)
    return kept.select("ts", "day", "area", "city", "user_id", "ads_id", "batch_id")


def kept_counts(ads: DataFrame, threshold: int, batch_seconds: int) -> DataFrame:
    """Rows that pass the blacklist, for totals: each total aggregates them at once
    (partially, before any shuffle), so no row travels by six keys first."""
    return _passes(with_batch(ads, batch_seconds).filter(F.col("user_id").isNotNull()),
                   ban_batches(ads, threshold, batch_seconds))


def _clicks(df: DataFrame):
    """Click total of a group: sum of slot counts, or a row count of rows."""
    return (F.sum("n") if "n" in df.columns else F.count(F.lit(1))).cast("bigint").alias("click_count")


def user_ads_day_counts(kept: DataFrame) -> DataFrame:
    """K9: clicks per (day, user, ad) that passed the blacklist (rows or slot counts)."""
    return kept.groupBy(*DAY_USER_AD).agg(_clicks(kept))


def area_city_ads_day(kept: DataFrame) -> DataFrame:
    """Daily total per (day, area, city, ad) (rows or slot counts)."""
    return kept.groupBy("day", "area", "city", "ads_id").agg(_clicks(kept))


def area_ads_day(counts: DataFrame) -> DataFrame:
    """Daily total per (day, area, ad): a roll-up of city totals, or
    straight from kept slot counts (the same sums, one shuffle fewer)."""
    total = F.sum("click_count").cast("bigint").alias("click_count") if "click_count" in counts.columns else _clicks(counts)
    return counts.groupBy("day", "area", "ads_id").agg(total)


def area_top_ads(area_totals: DataFrame, k: int) -> DataFrame:
    """Top k ads per (day, area) by clicks (ties: ad id)."""
    return top_k_per_group(area_totals, ["day", "area"], [F.desc("click_count"), F.asc("ads_id")], k)


def area_top_ads_json(top: DataFrame) -> DataFrame:
    """Per (day, area) the ranked ads as ``[{"ad":count},...]``."""
    pairs = F.array_sort(F.collect_list(F.struct("rank", F.col("ads_id").alias("k"), F.col("click_count").alias("v"))))
    return top.groupBy("day", "area").agg(json_pairs(pairs).alias("top3_json"))


def last_hour_ads_minutes(ads: DataFrame, minutes: int = 60) -> DataFrame:
    """Clicks per (ad, minute) in the newest ``minutes`` minute buckets,
    with the minute's label HH:mm and its time (minute_ms), which orders labels
    across midnight.

    The window ends with the minute of the newest row (a scalar subquery, one
    partial max per task) and spans that minute and the ``minutes - 1``
    before it, so a stream holding only per-minute counts yields the same.
    """
    minute = F.floor(F.unix_millis("ts") / F.lit(60_000)).cast("bigint")
    newest = ads.agg(F.max(minute)).scalar()
    recent = ads.filter(minute > newest - F.lit(int(minutes)))
    start = F.col("minute_ms")
    return recent.groupBy("ads_id", (minute * F.lit(60_000)).alias("minute_ms")) \
        .agg(F.count(F.lit(1)).alias("click_count")) \
        .select("ads_id", F.date_format(F.timestamp_millis(start), "HH:mm").alias("minute"), "click_count", start)


def last_hour_ads_trend(minute_counts: DataFrame) -> DataFrame:
    """Per ad ``[{"HH:mm":count},...]`` in time order (<= 60 entries)."""
    pairs = F.array_sort(F.collect_list(F.struct("minute_ms", F.col("minute").alias("k"), F.col("click_count").alias("v"))))
    return minute_counts.groupBy("ads_id").agg(json_pairs(pairs).alias("trend_json"))


def _interval_ms(text: str) -> int:
    n, unit = text.split()
    scale = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600}[unit.lower()]
    return int(n) * scale * 1000


def sliding_points(ads: DataFrame, window: str, slide: str, ts: str = "ts") -> DataFrame:
    """T11 as a difference array: (ads_id, start_ms, change), the change in an ad's count from
    one window start to the next. Clicks are counted per slide-long slot; a slot of n
    clicks adds n at the first window that holds it and takes n away past the last."""
    w_ms, s_ms = window_millis(window, slide)
    slot = (F.floor(F.unix_millis(ts) / F.lit(s_ms)) * F.lit(s_ms)).cast("bigint")
    slots = ads.groupBy("ads_id", slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    both = F.array(F.struct((F.col("slot") - F.lit(w_ms - s_ms)).alias("start_ms"), F.col("n").alias("change")),
                   F.struct((F.col("slot") + F.lit(s_ms)).alias("start_ms"), (-F.col("n")).alias("change")))
    return slots.select("ads_id", F.inline(both))


def window_millis(window: str, slide: str) -> tuple[int, int]:
    w_ms, s_ms = _interval_ms(window), _interval_ms(slide)
    if w_ms % s_ms:
        raise ValueError("window length must be a multiple of the slide")
    return w_ms, s_ms


SLIDING_BLOCK_MS = 86_400_000


def sliding_intervals(points: DataFrame, block_ms: int = SLIDING_BLOCK_MS) -> DataFrame:
    """(ads_id, from_ms, until_ms, click_count): stretches of window starts with one count.

    The prefix sum of the changes, in blocks: within (ad, block) by a window, and
    from block to block by a running sum of block totals, so that a hot ad is as many
    groups as it has blocks. Points travel once, two for a slot; ``until_ms`` is null
    after an ad's last point, where changes are still to come.
    """
    block = F.floor(F.col("start_ms") / F.lit(block_ms)).cast("bigint")
    placed = points.withColumn("_block", block).repartition("ads_id", "_block") \
        .groupBy("ads_id", "_block", "start_ms").agg(F.sum("change").alias("change"))
    inside = Window.partitionBy("ads_id", "_block").orderBy("start_ms")
    here = placed.select("ads_id", "_block", "start_ms", F.sum("change").over(inside).alias("_sum"),
                         F.lead("start_ms").over(inside).alias("_next"))
    blocks = Window.partitionBy("ads_id").orderBy("_block")  # one row a block of an ad
    carry = points.withColumn("_block", block).groupBy("ads_id", "_block") \
        .agg(F.sum("change").alias("_total"), F.min("start_ms").alias("_first")) \
        .select("ads_id", "_block", (F.sum("_total").over(blocks) - F.col("_total")).alias("_carry"),
                F.lead("_first").over(blocks).alias("_after"))
    return here.join(carry, ["ads_id", "_block"]).select(
        "ads_id", F.col("start_ms").alias("from_ms"), F.coalesce("_next", "_after").alias("until_ms"),
        (F.col("_sum") + F.col("_carry")).alias("click_count"))


def sliding_windows(intervals: DataFrame, window: str, slide: str) -> DataFrame:
    """One row per window and ad of the intervals that hold clicks; rows are made after all shuffles."""
    w_ms, s_ms = window_millis(window, slide)
    starts = F.sequence(F.col("from_ms"), F.col("until_ms") - F.lit(s_ms), F.lit(s_ms).cast("bigint"))
    each = intervals.filter("click_count > 0 and from_ms < until_ms").select("ads_id", "click_count", F.explode(starts).alias("_s"))
    # whole seconds print alike both ways, and a cast is cheaper than a pattern
    text = (lambda t: t.cast("string")) if s_ms % 1000 == 0 else (lambda t: F.date_format(t, TS_FORMAT))
    return each.select(text(F.timestamp_millis("_s")).alias("window_start"),
                       text(F.timestamp_millis(F.col("_s") + F.lit(w_ms))).alias("window_end"), "ads_id", "click_count")


def ads_sliding_counts(ads: DataFrame, window: str = "60 minutes", slide: str = "10 seconds") -> DataFrame:
    """T11 as event-time sliding windows: clicks per (window, ad). Equal to
    ``groupBy(window(ts, window, slide), ads_id).count()``, without a copy of a row or
    slot per window: see ``sliding_points``."""
    return sliding_windows(sliding_intervals(sliding_points(ads, window, slide)), window, slide)
