"""Dimension labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import Catalogue, table
from oreflow.operators.dimension import case_label, label_series

CATALOGUE = Catalogue()
register = CATALOGUE.register


def part_series(part):
    """Parts as series. Codes are padded; sizes beyond the nations and brands beyond the regions have no text."""
    def padded(column):
        return F.rpad(column, 8, " ")

    name = F.when(F.col("p_name") != "red widget", F.col("p_name"))
    season = F.when(F.col("p_type") == "PROMO", "S").when(F.col("p_type") == "ECONOMY", "U").otherwise(F.col("p_type"))
    return part.select(
        padded(F.col("p_partkey").cast("string")).alias("series_id"),
        padded(F.lpad(F.col("p_size").cast("string"), 2, "0")).alias("sector_code"),
        padded(F.lpad(F.regexp_extract("p_brand", r"(\d+)", 1), 2, "0")).alias("measure_code"),
        padded(F.substring("p_type", 1, 3)).alias("duration_code"),
        name.alias("class_code"),
        season.alias("seasonal"),
    )


def part_lookups(spark, sf_dir, part):
    return {
        "sector_code": table(spark, sf_dir, "nation").select(
            F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("sector_code"), F.col("n_name").alias("sector_name")
        ),
        "measure_code": table(spark, sf_dir, "region").select(
            F.lpad(F.col("r_regionkey").cast("string"), 2, "0").alias("measure_code"), F.col("r_name").alias("measure_text")
        ),
        "duration_code": part.select("p_type").distinct().select(
            F.substring("p_type", 1, 3).alias("duration_code"), F.col("p_type").alias("duration_text")
        ),
        "class_code": part.select("p_name").distinct().select(
            F.col("p_name").alias("class_code"), F.upper("p_name").alias("class_text")
        ),
    }


@register(
    "dim_label",
    """WITH s AS (
        SELECT CAST(p_partkey AS VARCHAR) AS series_id, lpad(CAST(p_size AS VARCHAR), 2, '0') AS sector_code,
               lpad(regexp_extract(p_brand, '(\\d+)', 1), 2, '0') AS measure_code,
               substring(p_type, 1, 3) AS duration_code, nullif(p_name, 'red widget') AS class_code,
               CASE p_type WHEN 'PROMO' THEN 'S' WHEN 'ECONOMY' THEN 'U' ELSE p_type END AS seasonal
        FROM part),
    j AS (
        SELECT s.*, n_name AS sector_name, r_name AS measure_text, p_type AS duration_text, upper(c.p_name) AS class_text
        FROM s LEFT JOIN nation ON lpad(CAST(n_nationkey AS VARCHAR), 2, '0') = sector_code
        LEFT JOIN region ON lpad(CAST(r_regionkey AS VARCHAR), 2, '0') = measure_code
        LEFT JOIN (SELECT DISTINCT p_type FROM part) d ON substring(d.p_type, 1, 3) = duration_code
        LEFT JOIN (SELECT DISTINCT p_name FROM part) c ON c.p_name = class_code)
    SELECT series_id, sector_code, sector_name, measure_code, measure_text, duration_code, duration_text,
           class_code, class_text, seasonal,
           concat_ws(': ', coalesce(sector_name, 'Unknown sector'),
               concat_ws(', ', coalesce(measure_text, 'Unknown measure'), duration_text, class_text,
                   CASE seasonal WHEN 'S' THEN 'Seasonally Adjusted' WHEN 'U' THEN 'Not Seasonally Adjusted'
                        ELSE seasonal END)) AS series_label
    FROM j""",
)
def dim_label(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return label_series(part_series(part), part_lookups(spark, sf_dir, part))


@register(
    "dim_case_label",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE o_orderstatus END
       AS status_label FROM orders""",
)
def dim_case_label(spark, sf_dir):
    label = case_label(F.col("o_orderstatus"), {"F": "Finished", "O": "Open"})
    return table(spark, sf_dir, "orders").select("o_orderkey", label.alias("status_label"))
