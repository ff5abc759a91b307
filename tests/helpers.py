"""Hand-written rows for golden and property tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

ACTION_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.TimestampNTZType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_ids", T.StringType()),
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
    T.StructField("event_id", T.LongType()),
])

BASE = dt.datetime(2024, 1, 10, 8, 0, 0)


def action(event_id, session="s1", user=1, seconds=0, page=1, keyword=None, click_cat=-1, click_prod=-1,
           order_cats=None, order_prods=None, pay_cats=None, pay_prods=None, city=1):
    t = BASE + dt.timedelta(seconds=seconds)
    return (t.strftime("%Y-%m-%d"), user, session, page, t, keyword, click_cat, click_prod,
            order_cats, order_prods, pay_cats, pay_prods, city, event_id)


def actions_df(spark, rows):
    return spark.createDataFrame(rows, ACTION_SCHEMA)


def users_df(spark, rows):
    return spark.createDataFrame(rows, "user_id bigint, username string, name string, age bigint, "
                                       "professional string, gender string")


def cities_df(spark, rows):
    return spark.createDataFrame(rows, "city_id bigint, city_name string, area string")


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "line string")
