"""The analytical questions in DataFrame form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreflow.layouts import QUARTERS, UNKNOWN_SERIES
from oreflow.operators.quality import Expectation, apply_expectations

# One rule list per question, shared by its SQL and its DataFrame form.
RANGE_STATS_RULES = [
    Expectation("stats_not_null", "mean_population IS NOT NULL AND stddev_samp_population IS NOT NULL", "fail"),
]
BEST_PERIOD_RULES = [
    Expectation("has_series_id", "series_id IS NOT NULL", "drop"),
    Expectation("has_best_year", "best_year IS NOT NULL", "drop"),
]
SERIES_CONTEXT_RULES = [
    Expectation("has_year", "year IS NOT NULL", "drop"),
    Expectation("has_value", "value IS NOT NULL", "drop"),
]


def completeness(periods: int) -> Expectation:
    """Fails the run unless exactly this many periods went into the statistics."""
    return Expectation("has_all_years", f"years_included = {periods}", "fail")


def range_stats(df: DataFrame, start: int, end: int, year: str = "year", value: str = "population") -> DataFrame:
    """Count, mean and both standard deviations over an inclusive range of years."""
    inside = df.filter(F.col(year).between(start, end))
    return inside.agg(
        F.count(F.lit(1)).alias("years_included"),
        F.avg(value).alias("mean_population"),
        F.stddev_samp(value).alias("stddev_samp_population"),
        F.stddev_pop(value).alias("stddev_pop_population"),
    ).select(F.lit(start).alias("start_year"), F.lit(end).alias("end_year"), "*")


def yearly_sums(obs: DataFrame, periods: list[str] = QUARTERS) -> DataFrame:
    """Sum (double) per series and year over the given periods; NULLs are skipped, all NULL gives NULL."""
    quarterly = obs.filter(F.col("period").isin(periods))
    return quarterly.groupBy("series_id", "year").agg(F.sum(F.col("value").cast("double")).alias("summed_value"))


def _labelled_best(best: DataFrame, dim: DataFrame) -> DataFrame:
    unknown = F.concat(F.lit(UNKNOWN_SERIES), "series_id")
    answer = best.join(dim.select("series_id", "series_label"), "series_id", "left").select(
        "series_id",
        F.coalesce("series_label", unknown).alias("series_label"),
        F.col("year").alias("best_year"),
        F.col("summed_value").alias("best_year_summed_value"),
    )
    return apply_expectations(answer, BEST_PERIOD_RULES).valid


def first_per_key(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """One row per key, the first in the order. Spark keeps one row per key and task before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def best_period_ranked(obs: DataFrame, dim: DataFrame, periods: list[str] = QUARTERS) -> DataFrame:
    """The answer of ``best_period`` by a rank within each series."""
    sums = yearly_sums(obs, periods)
    return _labelled_best(first_per_key(sums, ["series_id"], F.desc_nulls_last("summed_value"), F.asc("year")), dim)


def best_period(obs: DataFrame, dim: DataFrame, periods: list[str] = QUARTERS) -> DataFrame:
    """The year with the largest sum per series; of equal years the earliest.

    A struct compares field by field and NULL is smallest, so the maximum of
    (sum, -year) is the largest sum at its earliest year.
    """
    top = yearly_sums(obs, periods).groupBy("series_id").agg(
        F.max(F.struct("summed_value", (-F.col("year")).alias("back"))).alias("top")
    )
    best = top.select("series_id", (-F.col("top.back")).alias("year"), F.col("top.summed_value").alias("summed_value"))
    return _labelled_best(best, dim)


def series_context(obs: DataFrame, context: DataFrame, series_id: str, period: str) -> DataFrame:
    """One series and period by year, with the context value of that year where there is one."""
    one = obs.filter((F.col("series_id") == series_id) & (F.col("period") == period)).select("year", "value")
    joined = one.join(context.select("year", "population"), "year", "left").select("year", "value", "population")
    return apply_expectations(joined, SERIES_CONTEXT_RULES).valid
