"""Global month series with LAG (the marts' percentage change).

Input: one row per month with active and inactive listing counts. Months
where either count is missing are dropped *before* LAG (inner join of the two
series in the modelled SQL), so LAG reaches back over such gaps. The window
has no PARTITION BY; it runs on at most one row per month.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions import pct_change


def month_change_series(monthly: DataFrame, month: str = "s_date",
                        active: str = "active_listing_count",
                        inactive: str = "inactive_listing_count") -> DataFrame:
    both = monthly.filter(F.col(month).isNotNull()
                          & (F.col(active) > 0) & (F.col(inactive) > 0))
    by_month = Window.orderBy(F.col(month).asc())
    return (both
            .withColumn("active_before", F.lag(active, 1).over(by_month))
            .withColumn("inactive_before", F.lag(inactive, 1).over(by_month))
            .select(
                month,
                F.col(active).alias("active_now"),
                "active_before",
                pct_change(F.col(active), F.col("active_before"))
                 .alias("active_percentage_change"),
                F.col(inactive).alias("inactive_now"),
                "inactive_before",
                pct_change(F.col(inactive), F.col("inactive_before"))
                 .alias("inactive_percentage_change")))
