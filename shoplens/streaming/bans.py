"""The click-count feedback loop, judged by event time.

The log is cut into slots of the trigger's length. A slot is judged once the newest click is
some time past its end, whatever micro-batches its rows came in, so a backlog
read at once is judged as the same clicks are when they come one by one: a user is
banned from the slot after the one in which its clicks on one ad of a day reach the
threshold, for all ads and for good.

Counts, not rows, decide: clicks per (day, user, ad, slot), combined before they are
shuffled, on top of the day's counts so far. Rows meet the bans of their users by (user, salt), so the rows
of one user are spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.operators.ads import DAY_USER_AD, ban_batches_of

SALTS = 16
BANS_SCHEMA = "user_id string, ban_slot bigint"


def slot_clicks(due: DataFrame) -> DataFrame:
    """Clicks per (day, user, ad, slot)."""
    return due.groupBy(*DAY_USER_AD, F.col("slot").alias("batch_id")).agg(F.count(F.lit(1)).alias("n"))


def new_bans(due: DataFrame, so_far: DataFrame, banned: DataFrame, threshold: int, first_slot: int) -> DataFrame:
    """(user_id, ban_slot) of the users that the due slots ban. ``so_far`` holds the kept clicks
    of the days concerned (click_count), all before ``first_slot``; ``banned`` users are left out."""
    clicks = slot_clicks(due).join(banned, "user_id", "left_anti")
    users = clicks.select("user_id").distinct()
    before = so_far.join(users, "user_id", "left_semi").groupBy(*DAY_USER_AD).agg(F.sum("click_count").alias("n")) \
        .select(*DAY_USER_AD, F.lit(first_slot - 1).cast("bigint").alias("batch_id"), "n")
    counts = clicks.unionByName(before)
    reached = counts.groupBy(*DAY_USER_AD).agg(F.sum("n").alias("_total")).filter(F.col("_total") >= F.lit(threshold))
    mine = counts.join(reached.select("user_id").distinct(), "user_id", "left_semi")
    return ban_batches_of(mine, threshold).select("user_id", F.col("ban_batch").alias("ban_slot"))


def judged(due: DataFrame, bans: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of ``due`` up to and including their user's ban slot."""
    mine = bans.join(due.select("user_id").distinct(), "user_id", "left_semi") \
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    rows = due.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    return rows.join(mine, ["user_id", "_salt"], "left") \
        .filter(F.col("ban_slot").isNull() | (F.col("slot") <= F.col("ban_slot"))).drop("_salt", "ban_slot")
