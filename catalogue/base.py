"""Registration, and the shapes that several queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Catalogue:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def register(self, name: str, sql: str):
        def keep(run):
            self.queries[name] = run
            self.oracles[name] = sql
            return run

        return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)")


# --- observations: one series per customer, quarters of the order date, Q05 = average of the year ---
def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarterly = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("series_id"),
        F.year("o_orderdate").alias("year"),
        F.concat(F.lit("Q0"), F.quarter("o_orderdate")).alias("period"),
        F.col("o_totalprice").alias("value"),
    )
    average = F.sum(money("value")).cast("double") / F.count(F.lit(1))
    yearly = quarterly.groupBy("series_id", "year").agg(average.alias("value")).withColumn("period", F.lit("Q05"))
    return quarterly.unionByName(yearly)


OBSERVATIONS_SQL = """obs AS (
    SELECT CAST(o_custkey AS VARCHAR) AS series_id, CAST(year(o_orderdate) AS INTEGER) AS year,
           'Q0' || CAST(quarter(o_orderdate) AS VARCHAR) AS period, o_totalprice AS value
    FROM orders
    UNION ALL
    SELECT CAST(o_custkey AS VARCHAR), CAST(year(o_orderdate) AS INTEGER), 'Q05',
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*)
    FROM orders GROUP BY 1, 2
)"""


# --- labels: customers with a balance of at least zero; the others stay without one ---
def customer_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, sf_dir, "customer").filter("c_acctbal >= 0").join(nation, "c_nationkey", "left").select(
        F.col("c_custkey").cast("string").alias("series_id"),
        F.concat_ws(": ", "n_name", "c_mktsegment").alias("series_label"),
    )


LABELS_SQL = """dim AS (
    SELECT CAST(c_custkey AS VARCHAR) AS series_id, concat_ws(': ', n_name, c_mktsegment) AS series_label
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal >= 0
)"""


# --- yearly totals in the place of the population ---
def yearly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(
        F.floor(F.sum(money("o_totalprice"))).cast("bigint").alias("population")
    )


TOTALS_SQL = """totals AS (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18,2)))) AS BIGINT) AS population
    FROM orders GROUP BY 1
)"""


# --- one series per order priority, with a context that covers only some years ---
SERIES, PERIOD = "1-URGENT", "Q01"


def priority_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("series_id"),
        F.year("o_orderdate").alias("year"),
        F.concat(F.lit("Q0"), F.quarter("o_orderdate")).alias("period"),
    ).agg(F.sum(money("o_totalprice")).cast("double").alias("value"))


PRIORITY_SQL = """obs AS (
    SELECT o_orderpriority AS series_id, CAST(year(o_orderdate) AS INTEGER) AS year,
           'Q0' || CAST(quarter(o_orderdate) AS VARCHAR) AS period,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
    FROM orders GROUP BY 1, 2, 3
)"""


def shipped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shipped per year, for the years that the context covers."""
    year = F.year("l_shipdate")
    covered = table(spark, sf_dir, "lineitem").filter(year.between(1996, 2000))
    return covered.groupBy(year.alias("year")).agg(F.count(F.lit(1)).alias("population"))


SHIPPED_SQL = """context AS (
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS population
    FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 2000 GROUP BY 1
)"""
