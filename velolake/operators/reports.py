"""Dashboard queries over the marts, as Spark batch queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType


def _num(df: DataFrame, c: str) -> Column | None:
    """A mart column with NULL as 0, or None when the table lacks it."""
    return F.coalesce(F.col(c), F.lit(0)) if c in df.columns else None


def _sum(df: DataFrame, c: str, kind: str) -> Column:
    """Sum of a column; 0 over no rows, and 0 for a column the table lacks."""
    x = _num(df, c)
    return (F.lit(0) if x is None else F.coalesce(F.sum(x), F.lit(0))).cast(kind).alias(c)


def kpi_revenue(mart_revenue: DataFrame) -> DataFrame:
    """Total revenue and completed rides, NULL counted as 0 (B1)."""
    return mart_revenue.agg(F.count(F.lit(1)).alias("windows"), _sum(mart_revenue, "total_revenue", "double"),
                            _sum(mart_revenue, "completed_rides", "long")).drop("windows")


def kpi_fleet(mart_fleet: DataFrame) -> DataFrame:
    """Mean of window battery averages (NULL as 0, unweighted; NULL, as there is no mean,
    when the column is absent), and summed low-battery and maintenance counts (B2)."""
    battery = _num(mart_fleet, "avg_battery_level")
    mean = F.lit(None).cast("double") if battery is None else F.avg(battery)
    return mart_fleet.agg(F.count(F.lit(1)).alias("windows"), mean.alias("avg_battery_level"),
                          _sum(mart_fleet, "low_battery_scooters", "long"),
                          _sum(mart_fleet, "scooters_in_maintenance", "long")).drop("windows")


# Accepted forms of a text time, tried in this order after Spark's own.
TIME_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm", "MM/dd/yyyy", "yyyyMMdd")


def lenient_time(df: DataFrame, time_col: str = "hour_start", formats: tuple[str, ...] = TIME_FORMATS) -> DataFrame:
    """Text time values -> TIMESTAMP, unparseable ones -> NULL (never raises); a column that
    is already a timestamp is left alone."""
    if time_col not in df.columns or isinstance(df.schema[time_col].dataType, (TimestampType, TimestampNTZType)):
        return df
    text = F.trim(F.col(time_col).cast("string"))
    return df.withColumn(time_col, F.coalesce(F.try_to_timestamp(text), *[
        F.try_to_timestamp(text, F.lit(form)) for form in formats]))


def series(mart: DataFrame, value: str, time_col: str = "hour_start") -> DataFrame:
    """``(time, value)`` pairs without NULLs, in time order (B3, B4); none when the mart
    lacks either column."""
    if value not in mart.columns or time_col not in mart.columns:
        return mart.sparkSession.createDataFrame([], f"{time_col} timestamp, {value} double")
    return lenient_time(mart, time_col).select(time_col, value).dropna().orderBy(time_col)


def last_n(mart: DataFrame, n: int = 10, time_col: str = "hour_start") -> DataFrame:
    """The last ``n`` rows of the mart in time order, NULL times last.

    The choice is a top-k (``TakeOrderedAndProject``): each task keeps ``n`` rows; the final
    order is over those ``n``."""
    newest = lenient_time(mart, time_col).orderBy(F.col(time_col).desc_nulls_first()).limit(n)
    return newest.orderBy(F.col(time_col).asc_nulls_last())


def latest_windows(mart: DataFrame, n: int = 3, time_col: str = "hour_start") -> DataFrame:
    """The newest ``n`` windows."""
    return mart.orderBy(F.col(time_col).desc()).limit(n)
