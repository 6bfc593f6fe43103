"""Aggregate-expression helpers shared by marts, checks and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double; NULL when ``den`` is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def null_count(c: str) -> Column:
    return F.count_if(F.col(c).isNull())
