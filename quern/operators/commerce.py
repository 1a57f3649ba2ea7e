"""Sales reports over an order-line table.

Columns: cid, product_category, purchase_method, location, discount_availed
('Yes' / 'No'), discount_name, discount_amount, gross_amount, net_amount,
purchase_date. Each report is one grouped aggregate, combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _availed() -> Column:
    return F.col("discount_availed") == "Yes"


def _total(df: DataFrame, key: str, measure: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(measure).alias(name))


def sales_by_category(ecom: DataFrame) -> DataFrame:
    return _total(ecom, "product_category", "net_amount", "total_sales").orderBy(
        F.desc("total_sales")
    )


def avg_discount_by_location(ecom: DataFrame) -> DataFrame:
    return (
        ecom.where(_availed())
        .groupBy("location")
        .agg(F.avg("discount_amount").alias("avg_discount"))
        .orderBy(F.desc("avg_discount"))
    )


def top_cities(ecom: DataFrame, k: int = 5) -> DataFrame:
    totals = _total(ecom, "location", "net_amount", "total_sales")
    return totals.orderBy(F.desc("total_sales"), "location").limit(k)


def top_customers(ecom: DataFrame, k: int = 10) -> DataFrame:
    totals = _total(ecom, "cid", "net_amount", "total_spending")
    return totals.orderBy(F.desc("total_spending"), "cid").limit(k)


def discount_usage(ecom: DataFrame, key: str) -> DataFrame:
    """Transactions, discounted transactions and their percentage per key."""
    used = F.count_if(_availed())
    return (
        ecom.groupBy(key)
        .agg(
            F.count("*").alias("transactions"),
            used.alias("discounted"),
            (used / F.count("*") * 100).alias("discounted_pct"),
        )
        .orderBy(F.desc("discounted_pct"))
    )


def revenue_before_after(ecom: DataFrame) -> DataFrame:
    return ecom.agg(
        F.sum("gross_amount").alias("gross_revenue"),
        F.sum("net_amount").alias("net_revenue"),
        F.sum(F.col("gross_amount") - F.col("net_amount")).alias("discount_given"),
    )


def popular_discounts(ecom: DataFrame) -> DataFrame:
    return (
        ecom.where(_availed())
        .groupBy("discount_name")
        .agg(F.count("*").alias("uses"))
        .orderBy(F.desc("uses"))
    )


def monthly_sales(ecom: DataFrame) -> DataFrame:
    month = F.date_format("purchase_date", "yyyy-MM").alias("month")
    return ecom.groupBy(month).agg(F.sum("net_amount").alias("total_sales")).orderBy("month")


def avg_gross_net_by_category(ecom: DataFrame) -> DataFrame:
    return (
        ecom.groupBy("product_category")
        .agg(F.avg("gross_amount").alias("avg_gross"), F.avg("net_amount").alias("avg_net"))
        .orderBy(F.desc("avg_net"))
    )


def discount_impact(ecom: DataFrame) -> DataFrame:
    return ecom.groupBy("discount_availed").agg(F.avg("net_amount").alias("avg_net"))


def discount_by_category(ecom: DataFrame) -> DataFrame:
    discounted = ecom.where(_availed())
    return _total(discounted, "product_category", "discount_amount", "total_discount").orderBy(
        F.desc("total_discount")
    )


def purchase_method_counts(ecom: DataFrame) -> DataFrame:
    return (
        ecom.groupBy("purchase_method")
        .agg(F.count("*").alias("transactions"))
        .orderBy(F.desc("transactions"))
    )


def sales_by_weekday(ecom: DataFrame) -> DataFrame:
    weekday = F.date_format("purchase_date", "EEEE").alias("weekday")
    return (
        ecom.groupBy(weekday)
        .agg(F.sum("net_amount").alias("total_sales"))
        .orderBy(F.desc("total_sales"))
    )


def discount_vs_gross(ecom: DataFrame, scale: int = 4) -> DataFrame:
    """Average gross amount per distinct discount amount.

    The amount is grouped as a decimal: floating point keys that print alike may differ.
    """
    amount = F.col("discount_amount").cast(f"decimal(18,{scale})").alias("discount_amount")
    return (
        ecom.where(_availed())
        .groupBy(amount)
        .agg(F.avg("gross_amount").alias("avg_gross"))
        .orderBy("discount_amount")
    )
