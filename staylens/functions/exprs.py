"""Column expressions shared by all plans.

Numbers follow the warehouse the modelled job ran on: integer / integer gives
a NUMBER(38,6) rounded half up, and the scale is kept when the quotient is
multiplied by 100 (so 1/3*100 = 33.333300, rounded *before* the multiply).
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = "decimal(38,0)"


def hundred() -> Column:
    """The literal 100 as a decimal, so the scale of a ratio is kept."""
    return F.lit(100).cast("decimal(3,0)")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_number(x) -> Column:
    """NUMBER(38,0): exact integer arithmetic for products of sums."""
    return _c(x).cast(NUMBER)


def ratio6(num, den) -> Column:
    """num / den as decimal(38,6), HALF_UP. A zero denominator yields null
    instead of failing the job (the host mart can divide by a zero distinct
    host count when every host name is null)."""
    return to_number(num) / F.nullif(to_number(den), F.lit(0).cast(NUMBER))


def pct_change(cur, prev) -> Column:
    """(cur - prev) / prev * 100 with the six-digit intermediate; null when
    there is no previous value."""
    return ratio6(_c(cur) - _c(prev), prev) * hundred()


def month_of(scraped_date) -> Column:
    """LEFT(text, 7): 'yyyy-MM-dd' -> 'yyyy-MM'."""
    return F.left(_c(scraped_date), F.lit(7))


def lga_code_of(raw_code) -> Column:
    """RIGHT(text, 5) cast to a number: 'LGA10050' -> 10050."""
    return F.right(_c(raw_code), F.lit(5)).cast(NUMBER).cast("bigint")


def stay_days(availability_30) -> Column:
    """Booked nights in the next 30 days: 30 - availability_30."""
    return F.lit(30) - _c(availability_30)


def is_true_flag(c) -> Column:
    return _c(c) == F.lit("t")


def is_false_flag(c) -> Column:
    return _c(c) == F.lit("f")
