"""New versus returning customers per period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def new_versus_returning(
    df: DataFrame, customer: str, period: str, amount: Column
) -> DataFrame:
    """Per period: customers seen for the first time, customers seen before, and their amounts.

    Activity is first reduced to one row per customer and period, so a customer holds at most as many
    rows as there are periods, every later count is a plain one, and the first period comes from a
    window over that small set instead of a self-join.
    """
    active = (
        df.filter(F.col(customer).isNotNull())
        .groupBy(customer, period)
        .agg(F.sum(amount).alias("amount"))
    )
    first = F.min(period).over(Window.partitionBy(customer))
    marked = active.select(
        period,
        "amount",
        (F.col(period) == first).alias("is_new"),
        (F.col(period) > first).alias("is_returning"),
    )
    return marked.groupBy(period).agg(
        F.count_if("is_new").alias("new_customers"),
        F.count_if("is_returning").alias("returning_customers"),
        F.sum(F.when(F.col("is_new"), F.col("amount"))).alias("new_customer_revenue"),
        F.sum(F.when(F.col("is_returning"), F.col("amount"))).alias("returning_customer_revenue"),
    )
