"""Writers, each read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalogue.base import Catalogue, observations, table
from catalogue.gold import YEARLY, best_period_df, rounded
from oreflow.operators.analytics import yearly_sums
from oreflow import layouts
from oreflow.operators.quality import Expectation, apply_expectations
from oreflow.plans.medallion import Warehouse, silver_observations
from oreflow.session import work_dir
from oreflow.sinks import (
    append_evolved, append_merged, document_columns, overwrite_evolved, publish, read_evolved, read_merged, read_published,
    replace_table_as, save_table, table_comments, write_partitioned,
)

CATALOGUE = Catalogue()
register = CATALOGUE.register


def _fresh_name(label):
    return f"{label}_{uuid.uuid4().hex}"


@register("sink_overwrite", YEARLY)
def sink_overwrite(spark, sf_dir):
    """A derived table, computed from the orders up to 1999 and then again from all of them."""
    root = work_dir(spark, "overwrite")
    obs = observations(spark, sf_dir)
    rules = [Expectation("has_series_id", "series_id IS NOT NULL", "drop")]
    for source in (obs.filter("year < 2000"), obs):
        sums = document_columns(yearly_sums(source), {"summed_value": "sum of the quarters"})
        publish(apply_expectations(sums, rules), root)
    return rounded(read_published(spark, root))


@register(
    "sink_replace_table",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS orders, max(o_orderdate) AS last_order
       FROM orders GROUP BY 1, 2""",
)
def sink_replace_table(spark, sf_dir):
    """A table replaced by a query on itself."""
    name = _fresh_name("orders_by_status")
    wide = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    replace_table_as(spark, name, wide, work_dir(spark, "replace"), "orders as they came")
    summary = spark.sql(
        f"SELECT o_orderstatus, o_orderpriority, count(*) AS orders, max(o_orderdate) AS last_order FROM {name} GROUP BY 1, 2"
    )
    return replace_table_as(spark, name, summary, work_dir(spark, "replace"), "orders per status and priority")


@register("sink_save_table", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def sink_save_table(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return save_table(customer, _fresh_name("customer_copy"), work_dir(spark, "save-table"))


@register(
    "sink_merge_schema",
    """SELECT event_id, event_type, CASE WHEN ts >= '2024-01-15' THEN value END AS value,
              CASE WHEN ts >= '2024-01-15' THEN props END AS props FROM events""",
)
def sink_merge_schema(spark, sf_dir):
    """The source gains two columns half-way."""
    path = work_dir(spark, "merge-schema")
    events = table(spark, sf_dir, "events")
    append_merged(events.filter("ts < '2024-01-15'").select("event_id", "event_type"), path)
    append_merged(events.filter("ts >= '2024-01-15'").select("event_id", "event_type", "value", "props"), path)
    return read_merged(spark, path)


@register(
    "sink_partitioned",
    """SELECT event_id, event_type, user_id,
              CASE event_type WHEN 'purchase' THEN value * 2 ELSE value END AS value FROM events""",
)
def sink_partitioned(spark, sf_dir):
    """All partitions, then one of them anew; the others stay as they are."""
    path = work_dir(spark, "partitioned")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type")
    write_partitioned(events, path, ["event_type"])
    corrected = events.filter("event_type = 'purchase'").withColumn("value", F.col("value") * 2)
    write_partitioned(corrected, path, ["event_type"])
    return spark.read.parquet(path)


EARLY, MIDDLE, LATE = "ts < '2024-01-11'", "ts >= '2024-01-11' AND ts < '2024-01-21'", "ts >= '2024-01-21'"


@register(
    "sink_evolve_append",
    f"""SELECT event_id, CASE WHEN {LATE} THEN 'u' ELSE '' END || CAST(user_id AS VARCHAR) AS user_id,
              CASE WHEN {EARLY} THEN floor(value) ELSE value END AS value,
              CASE WHEN {EARLY} THEN event_type END AS event_type, CASE WHEN {EARLY} THEN NULL ELSE props END AS props FROM events""",
)
def sink_evolve_append(spark, sf_dir):
    """A value turns from int to double, a column vanishes, one comes, and a key turns from long to text."""
    root = work_dir(spark, "evolve-append")
    events = table(spark, sf_dir, "events")
    append_evolved(events.filter(EARLY).select("event_id", "user_id", F.floor("value").cast("int").alias("value"), "event_type"), root)
    append_evolved(events.filter(MIDDLE).select("props", "event_id", "user_id", "value"), root)
    late = F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("USER_ID")
    append_evolved(events.filter(LATE).select("event_id", late, "value", "props"), root)
    return read_evolved(spark, root)


@register(
    "sink_evolve_overwrite",
    """SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_orderstatus, CAST(o_totalprice AS VARCHAR) AS price, o_custkey FROM orders""",
)
def sink_evolve_overwrite(spark, sf_dir):
    """All rows replaced: a column that only the old rows had stays, a number becomes text, a column is new."""
    root = work_dir(spark, "evolve-overwrite")
    orders = table(spark, sf_dir, "orders")
    cents = F.col("o_totalprice").cast("decimal(18,2)")
    overwrite_evolved(orders.select("o_orderkey", "o_orderstatus", F.floor(cents).cast("int").alias("price")), root)
    overwrite_evolved(orders.select("o_custkey", F.col("o_totalprice").cast("string").alias("price"), "o_orderkey"), root)
    return read_evolved(spark, root)


OBSERVATION_FIELDS = ["series_id", "year", "period", "value", "footnote_codes"]
BEST_FIELDS = ["series_id", "series_label", "best_year", "best_year_summed_value"]
DESCRIBED = {"bronze_bls_data": OBSERVATION_FIELDS, "silver_bls_data": OBSERVATION_FIELDS, "gold_bls_best_year_per_series": BEST_FIELDS}


def _comments_sql() -> str:
    rows = []
    for name, fields in DESCRIBED.items():
        rows.append(f"('{name}', NULL, '{layouts.TABLE_COMMENTS[name]}')")
        rows += [f"('{name}', '{field}', '{layouts.COLUMN_COMMENTS[field]}')" for field in fields]
    return f"""WITH described(table_name, column_name, comment) AS (VALUES {", ".join(rows)})
        SELECT d.*, CASE WHEN table_name LIKE 'gold%' THEN (SELECT count(DISTINCT o_custkey) FROM orders)
                         ELSE (SELECT count(*) FROM orders) END AS rows FROM described d"""


@register("sink_comments", _comments_sql())
def sink_comments(spark, sf_dir):
    """A table of each layer in the catalog with its comments, read back from there with the rows that the name gives."""
    house = Warehouse(spark, work_dir(spark, "comments"))
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("series_id"), F.year("o_orderdate").cast("string").alias("year"),
        F.concat(F.lit("Q0"), F.quarter("o_orderdate")).alias("period"), F.col("o_totalprice").cast("string").alias("value"),
        F.lit(None).cast("string").alias("footnote_codes"),
    )
    raw.write.parquet(house.path("bronze", "bronze_bls_data"))
    house.publish("silver", "silver_bls_data", silver_observations(raw))
    house.publish("gold", "gold_bls_best_year_per_series", apply_expectations(best_period_df(spark, sf_dir), []))
    found = []
    for name in DESCRIBED:
        entered = _fresh_name(name)
        rows = house.describe(name.split("_")[0], name, entered).count()
        comments = table_comments(spark, [entered]).withColumn("table_name", F.lit(name))
        found.append(comments.withColumn("rows", F.lit(rows).cast("bigint")))
    return found[0].unionByName(found[1]).unionByName(found[2])
