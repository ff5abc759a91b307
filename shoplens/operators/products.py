"""Product clicks per area, the city-share remark and top products per area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.core import double_text, half_up
from shoplens.operators.common import top_k_per_group
from shoplens.params import OTHER_CITIES_LABEL, SHOWN_CITIES


def _area_clicks(actions: DataFrame, cities: DataFrame) -> DataFrame:
    clicks = actions.filter(F.col("click_product_id") > 0).select("city_id", "click_product_id")
    return clicks.join(cities.select("city_id", "city_name", "area"), "city_id")


def area_product_clicks(actions: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks per (area, product), J2 + F9."""
    return _area_clicks(actions, cities) \
        .groupBy("area", F.col("click_product_id").alias("product_id")) \
        .agg(F.count(F.lit(1)).alias("click_count"))


def _product_cities(actions: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks per (area, product) and the counts of its cities: at most one entry per city
    of the dimension."""
    per_city = _area_clicks(actions, cities) \
        .groupBy("area", F.col("click_product_id").alias("product_id"), "city_name") \
        .agg(F.count(F.lit(1)).alias("c"))
    return per_city.groupBy("area", "product_id").agg(
        F.sum("c").alias("click_count"),
        F.count(F.lit(1)).alias("city_count"),
        F.collect_list(F.struct("c", "city_name")).alias("_cities"),
    )


def _city_remark(other_label: str) -> Column:
    """The text ``a:50.0%,b:30.0%,<other>:20.0%`` of a row of ``_product_cities``.

    Share per city = round-half-up(c / n * 100, 1); cities by share desc (ties
    by name); the first two shown; with more than two cities the rest is one
    ``other`` entry of 100 - s1 - s2, rounded to one decimal.
    """
    total = F.col("click_count")
    shares = F.transform(
        "_cities",
        lambda x: F.struct(
            (-(F.floor(x["c"] / total * F.lit(1000.0) + F.lit(0.5)) / F.lit(10.0))).alias("neg_share"),
            x["city_name"].alias("city_name"),
        ),
    )
    top = F.slice(F.array_sort(shares), 1, SHOWN_CITIES)
    shown = F.transform(top, lambda x: F.concat(x["city_name"], F.lit(":"), double_text(-x["neg_share"]), F.lit("%")))
    # (100 - s1) - s2, as the original subtracts the two shown shares in turn
    neg_share_at = lambda i: F.try_element_at(top, F.lit(i)).getField("neg_share")
    rest = half_up(F.lit(100.0) + neg_share_at(1) + neg_share_at(2), 1)
    other = F.when(F.col("city_count") > SHOWN_CITIES,
                   F.concat(F.lit(other_label), F.lit(":"), double_text(rest), F.lit("%")))
    return F.concat_ws(",", shown, other).alias("city_remark")


def area_product_city_remark(actions: DataFrame, cities: DataFrame,
                             other_label: str = OTHER_CITIES_LABEL) -> DataFrame:
    """U1 as a two-level group-by."""
    return _product_cities(actions, cities).select("area", "product_id", "click_count", _city_remark(other_label))


def area_top_products(actions: DataFrame, cities: DataFrame, k: int,
                      other_label: str = OTHER_CITIES_LABEL) -> DataFrame:
    """Top k products per area by clicks (ties: product id), with remark. Products are ranked
    by their counts; texts are made afterwards, for the k of each area."""
    top = top_k_per_group(_product_cities(actions, cities), ["area"], [F.desc("click_count"), F.asc("product_id")], k)
    return top.select("area", "product_id", "click_count", _city_remark(other_label), "rank")
