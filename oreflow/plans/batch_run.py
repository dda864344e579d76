"""The batch variant: plainly named files are read whole and every table is recomputed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from oreflow import layouts
from oreflow.functions.names import sanitize_names
from oreflow.operators.quality import Checked, apply_expectations
from oreflow.plans.medallion import (
    BRONZE_OBSERVATION_RULES, BRONZE_POPULATION_RULES, BRONZE_SERIES_RULES, Warehouse, run_gold, run_silver,
)
from oreflow.sources.delimited import read_delimited, read_lookups
from oreflow.sources.documents import explode_records, read_envelopes, read_lines
from oreflow.sources.lineage import with_lineage


def batch_bronze(spark: SparkSession, raw: str, population_raw: str) -> dict[str, Checked]:
    """Every bronze table as a lazy batch scan with its rules."""

    def delimited(name: str, columns: list[str]) -> DataFrame:
        scan = read_delimited(spark, f"{raw}/{name}", layouts.text_schema(columns))
        return with_lineage(scan, source_file=True)

    lookups = read_lookups(spark, raw, layouts.LOOKUP_FILES)
    population = explode_records(read_envelopes(spark, f"{population_raw}/{layouts.POPULATION_FILE}"))
    tables = {
        "bronze_bls_data": (delimited(layouts.CURRENT_FILE, layouts.OBSERVATION_COLUMNS), BRONZE_OBSERVATION_RULES),
        "bronze_bls_data_alldata": (delimited(layouts.ALL_DATA_FILE, layouts.OBSERVATION_COLUMNS), []),
        "bronze_bls_series": (delimited(layouts.SERIES_FILE, layouts.SERIES_COLUMNS), BRONZE_SERIES_RULES),
        "bronze_bls_pr_txt": (with_lineage(read_lines(spark, f"{raw}/{layouts.NOTES_FILE}")), []),
        "bronze_population": (with_lineage(population), BRONZE_POPULATION_RULES),
        **{name: (lookup, []) for name, lookup in lookups.items()},
    }
    return {name: apply_expectations(sanitize_names(df), rules) for name, (df, rules) in tables.items()}


def run_batch(house: Warehouse, raw: str, population_raw: str, **asked) -> None:
    """Bronze, silver and gold in one go."""
    for name, checked in batch_bronze(house.spark, raw, population_raw).items():
        house.publish("bronze_batch", name, checked)
    run_silver(house, bronze=lambda table: house.read("bronze_batch", table))
    run_gold(house, **asked)
