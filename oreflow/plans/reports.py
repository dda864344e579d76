"""Datasets behind the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trend(context: DataFrame) -> DataFrame:
    return context.select("year", F.col("value").alias("productivity_value"), "population").orderBy("year")


def stats(range_stats: DataFrame, start: int, end: int) -> DataFrame:
    """The figures of one range. The deviation shown is the population's, not the sample's."""
    one = range_stats.filter((F.col("start_year") == start) & (F.col("end_year") == end))
    return one.select("mean_population", F.col("stddev_pop_population").alias("stddev_population"))


def best_by_value(best: DataFrame) -> DataFrame:
    columns = ["series_id", "series_label", "best_year", "best_year_summed_value"]
    return best.select(*columns).orderBy(F.desc_nulls_last("best_year_summed_value"), "series_id")


def best_by_label(best: DataFrame) -> DataFrame:
    return best.groupBy("series_label").agg(F.sum("best_year_summed_value").alias("best_year_summed_value"))


def series_range(context: DataFrame, start: int, end: int) -> DataFrame:
    return trend(context.filter(F.col("year").between(start, end)))


def most_recent(df: DataFrame, n: int, *newest_first) -> DataFrame:
    """The n first rows of an order: each task keeps n, the driver merges those."""
    return df.orderBy(*newest_first).limit(n)
