"""Exercise: hot products, their top buyers and the buyers' visit trace.

Hot products are the k most clicked products (ties: product id). Buyers of
a product are users with pay actions listing it; per product the m users
with most such actions are picked, and their visits (of one day, if given)
are listed in time order with the product and user names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.core import fmt_ts, split_ids
from shoplens.operators.common import bounded, top_k_per_group


def hot_products(actions: DataFrame, k: int) -> DataFrame:
    """Top k products by clicks (TakeOrderedAndProject, no full sort)."""
    return actions.filter(F.col("click_product_id") > 0) \
        .groupBy(F.col("click_product_id").alias("product_id")) \
        .agg(F.count(F.lit(1)).alias("click_count")) \
        .orderBy(F.desc("click_count"), F.asc("product_id")).limit(k)


def hot_product_buyers(actions: DataFrame, hot: DataFrame) -> DataFrame:
    """A14 after F15/J5: pay actions per (hot product, user).

    The pay lists are exploded and semi-joined with the k hot ids
    (a bounded broadcast), then counted with map-side partial aggregation.
    """
    paid = actions.filter(F.col("pay_product_ids").isNotNull()).select(
        "user_id", F.explode(split_ids("pay_product_ids")).alias("_pid"))
    return paid.select("user_id", F.col("_pid").try_cast("bigint").alias("product_id")) \
        .filter(F.col("product_id").isNotNull()) \
        .join(bounded(hot.select("product_id")), "product_id", "left_semi") \
        .groupBy("product_id", "user_id").agg(F.count(F.lit(1)).alias("buy_count"))


def hot_product_top_buyers(actions: DataFrame, hot: DataFrame, m: int) -> DataFrame:
    """The m users with most purchases per hot product (ties: user id)."""
    return top_k_per_group(hot_product_buyers(actions, hot), ["product_id"],
                           [F.desc("buy_count"), F.asc("user_id")], m)


def top_buyers_in_one_pass(actions: DataFrame, k: int, m: int) -> DataFrame:
    """The top buyers of the k hot products from one scan: an action is a click of a
    product (no user kept) or a purchase of each product it lists, and both are
    counted by one partial aggregation whose exchange the two rankings share."""
    clicked = F.when(F.col("click_product_id") > 0, F.array(F.struct(
        F.col("click_product_id").cast("bigint").alias("product_id"), F.lit(None).cast("bigint").alias("user_id"))))
    bought = F.when(F.col("pay_product_ids").isNotNull(), F.transform(split_ids("pay_product_ids"), lambda p: F.struct(
        p.try_cast("bigint").alias("product_id"), F.col("user_id").cast("bigint").alias("user_id"))))
    none = F.array().cast("array<struct<product_id:bigint,user_id:bigint>>")
    counts = actions.select(F.explode(F.concat(F.coalesce(clicked, none), F.coalesce(bought, none))).alias("_e")) \
        .select("_e.*").filter(F.col("product_id").isNotNull()) \
        .groupBy("product_id", "user_id").agg(F.count(F.lit(1)).alias("n"))
    hot = counts.filter(F.col("user_id").isNull()).orderBy(F.desc("n"), F.asc("product_id")).limit(k)
    buyers = counts.filter(F.col("user_id").isNotNull()).withColumnRenamed("n", "buy_count") \
        .join(bounded(hot.select("product_id")), "product_id", "left_semi")
    return top_k_per_group(buyers, ["product_id"], [F.desc("buy_count"), F.asc("user_id")], m)


def action_type() -> F.Column:
    """click, search, order or pay (the one action kind a row carries)."""
    return (F.when(F.col("click_product_id") > 0, F.lit("click"))
            .when(F.col("search_keyword").isNotNull(), F.lit("search"))
            .when(F.col("order_product_ids").isNotNull(), F.lit("order"))
            .when(F.col("pay_product_ids").isNotNull(), F.lit("pay")))


def action_item() -> F.Column:
    """Product id(s) of the action, or the search keyword."""
    return (F.when(F.col("click_product_id") > 0, F.col("click_product_id").cast("string"))
            .when(F.col("search_keyword").isNotNull(), F.col("search_keyword"))
            .when(F.col("order_product_ids").isNotNull(), F.col("order_product_ids"))
            .when(F.col("pay_product_ids").isNotNull(), F.col("pay_product_ids")))


def visit_trace(visits: DataFrame, top_buyers: DataFrame, products: DataFrame,
                users: DataFrame, day: str | None = None) -> DataFrame:
    """J7 + O4: every visit of each picked buyer, with product and user names.

    The picks (at most k*m rows, by the two rankings) are computed once, here; their user
    and product ids are literals in the plan that is returned, so they prune the
    scans of the visits, products and users, and every join has a side of at most k*m rows.
    """
    picked = top_buyers.select("product_id", "user_id", F.col("rank").alias("buyer_rank"))
    rows = picked.collect()
    spark = visits.sparkSession
    chosen = bounded(spark.createDataFrame(rows, picked.schema))
    product_ids, user_ids = ({r[c] for r in rows} for c in ("product_id", "user_id"))
    if day is not None:
        visits = visits.filter(F.col("date") == F.lit(day))
    trace = visits.filter(F.col("user_id").isin(list(user_ids))).join(chosen, "user_id")
    names = bounded(products.filter(F.col("product_id").isin(list(product_ids))).select("product_id", "product_name"))
    people = bounded(users.filter(F.col("user_id").isin(list(user_ids))).select("user_id", "username"))
    return trace.join(names, "product_id", "left").join(people, "user_id", "left").select(
        "product_id", "product_name", "user_id", "username", "buyer_rank",
        fmt_ts("action_time").alias("action_time"),
        action_type().alias("action_type"),
        action_item().alias("item"),
        "event_id",
    ).orderBy("product_id", "buyer_rank", "action_time", "event_id")
