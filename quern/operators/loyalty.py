"""Restaurant loyalty questions over sales, menu and members.

sales(customer_id, order_date, product_id), menu(product_id, product_name, price),
members(customer_id, join_date); menu and members have one row per key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.ordered import keep_extreme


def join_inner_dim(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Sales with name and price; Spark broadcasts the menu when its size allows."""
    return sales.join(menu, "product_id")


def join_after_event(sales: DataFrame, members: DataFrame) -> DataFrame:
    """Sales strictly after the customer joined."""
    return sales.join(members, "customer_id").where(F.col("order_date") > F.col("join_date"))


def join_before_event(sales: DataFrame, members: DataFrame) -> DataFrame:
    """Sales strictly before the customer joined."""
    return sales.join(members, "customer_id").where(F.col("order_date") < F.col("join_date"))


def join_full_outer(sales: DataFrame, members: DataFrame, menu: DataFrame) -> DataFrame:
    """Sales of members and non-members (NULL join date), then the menu."""
    return sales.join(members, "customer_id", "full").join(menu, "product_id")


def total_spent_by_customer(sales: DataFrame, menu: DataFrame) -> DataFrame:
    return (
        join_inner_dim(sales, menu)
        .groupBy("customer_id")
        .agg(F.sum("price").alias("total_spent"))
        .orderBy("customer_id")
    )


def visit_days(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("customer_id")
        .agg(F.count_distinct("order_date").alias("order_days"))
        .orderBy("customer_id")
    )


def first_items(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Everything bought on a customer's first day, repeated rows kept."""
    known = sales.join(menu.select("product_id"), "product_id", "left_semi")
    return keep_extreme(known, ["customer_id"], "order_date").join(menu, "product_id").select(
        "customer_id", "product_name", "order_date"
    )


def most_purchased_item(sales: DataFrame, menu: DataFrame, k: int = 1) -> DataFrame:
    """Best selling products; equal counts go to the lower product id."""
    counts = sales.groupBy("product_id").agg(F.count("customer_id").alias("purchases"))
    return (
        counts.join(menu, "product_id")
        .select("product_id", "product_name", "purchases")
        .orderBy(F.desc("purchases"), "product_id")
        .limit(k)
    )


def favourite_items(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Most bought item names per customer, ties kept."""
    counts = (
        join_inner_dim(sales, menu)
        .groupBy("customer_id", "product_name")
        .agg(F.count("product_id").alias("purchases"))
    )
    return keep_extreme(counts, ["customer_id"], "purchases", latest=True)


def _edge_purchase(
    dated: DataFrame, sales: DataFrame, menu: DataFrame, latest: bool
) -> DataFrame:
    edge = dated.groupBy("customer_id").agg(
        (F.max if latest else F.min)("order_date").alias("order_date")
    )
    return (
        sales.join(edge, ["customer_id", "order_date"])
        .join(menu, "product_id")
        .select("customer_id", "product_name", "order_date")
    )


def first_after_join(sales: DataFrame, members: DataFrame, menu: DataFrame) -> DataFrame:
    """Purchases on the first day after joining."""
    return _edge_purchase(join_after_event(sales, members), sales, menu, latest=False)


def last_before_join(
    sales: DataFrame, members: DataFrame, menu: DataFrame, as_written: bool = False
) -> DataFrame:
    """Purchases on the last day before joining; ``as_written`` takes the first day."""
    return _edge_purchase(join_before_event(sales, members), sales, menu, latest=not as_written)


def pre_member_totals(sales: DataFrame, members: DataFrame, menu: DataFrame) -> DataFrame:
    return (
        join_before_event(sales, members)
        .join(menu, "product_id")
        .groupBy("customer_id")
        .agg(F.count("product_id").alias("items"), F.sum("price").alias("total_spent"))
    )


def _points(doubled: Column, price: Column | str = "price") -> Column:
    """Ten points per unit of price, twenty when doubled."""
    value = F.col(price) if isinstance(price, str) else price
    return F.sum(F.when(doubled, 20 * value).otherwise(10 * value))


def loyalty_points(sales: DataFrame, menu: DataFrame, bonus_product: int) -> DataFrame:
    return (
        join_inner_dim(sales, menu)
        .groupBy("customer_id")
        .agg(_points(F.col("product_id") == bonus_product).alias("total_points"))
        .orderBy("customer_id")
    )


def loyalty_points_promo(
    sales: DataFrame,
    members: DataFrame,
    menu: DataFrame,
    bonus_product: int,
    until: dt.date | None = None,
    as_written: bool = False,
    promo_prices: Mapping[int, int] | None = None,
) -> DataFrame:
    """Points when everything counts double in the week from the join date on.

    By default only members count, and only orders up to ``until``. ``as_written``
    keeps every customer and date, and ``promo_prices`` may replace a product's
    price during the promotion week.
    """
    if as_written:
        orders = join_full_outer(sales, members, menu)
    else:
        dated = sales if until is None else sales.where(F.col("order_date") <= F.lit(until))
        orders = dated.join(members, "customer_id").join(menu, "product_id")
    in_week = F.coalesce(
        (F.col("order_date") >= F.col("join_date"))
        & (F.col("order_date") < F.date_add("join_date", 7)),
        F.lit(False),
    )
    bonus = F.col("product_id") == bonus_product
    price = F.col("price")
    for product, promo_price in (promo_prices or {}).items():
        swap = in_week & ~bonus & (F.col("product_id") == product)
        price = F.when(swap, F.lit(promo_price)).otherwise(price)
    return (
        orders.groupBy("customer_id")
        .agg(_points(bonus | in_week, price).alias("total_points"))
        .orderBy("customer_id")
    )
