"""Change detection on file listings, as joins."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.operators.dedup import dedup_latest

# --- fixed values: the manifest's columns ---
MANIFEST_SCHEMA = (
    "file_name STRING NOT NULL, size_bytes BIGINT NOT NULL, "
    "last_modified STRING NOT NULL, ingested_at TIMESTAMP NOT NULL"
)


def plan_pull(
    remote: DataFrame, manifest: DataFrame,
    key: str = "file_name", compare: tuple[str, ...] = ("size_bytes", "last_modified"),
) -> DataFrame:
    """Every file of either side with the status new, changed, unchanged or removed."""
    r = remote.select(key, *compare, F.lit(True).alias("_remote"))
    m = manifest.select(key, *[F.col(c).alias(f"known_{c}") for c in compare], F.lit(True).alias("_known"))
    differs = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"known_{c}")) for c in compare])
    status = (
        F.when(F.col("_known").isNull(), "new")
        .when(F.col("_remote").isNull(), "removed")
        .when(differs, "changed")
        .otherwise("unchanged")
    )
    return r.join(m, key, "full_outer").withColumn("status", status).drop("_remote", "_known")


def to_pull(plan: DataFrame, key: str = "file_name", compare: tuple[str, ...] = ("size_bytes", "last_modified")) -> DataFrame:
    """New and changed files. Removed ones stay in the manifest and in storage."""
    return plan.filter(F.col("status").isin("new", "changed")).select(key, *compare)


def merge_manifest(
    manifest: DataFrame, updates: DataFrame, key: str = "file_name", newest_first: list[Column] | None = None
) -> DataFrame:
    """Upsert: a row of ``updates`` replaces the one with its key or is added.

    Both sides are read once and meet in one shuffle, which also settles keys
    that the updates hold more than once.
    """
    rows = manifest.withColumn("_update", F.lit(0)).unionByName(updates.withColumn("_update", F.lit(1)))
    order = [F.desc("_update"), *(newest_first or [F.desc_nulls_last("ingested_at")])]
    return dedup_latest(rows, [key], order).drop("_update")


def run_summary(plan: DataFrame, failed: DataFrame | None = None, key: str = "file_name") -> DataFrame:
    """Counts of one run. ``failed`` names the files whose download did not succeed."""
    if failed is None:
        plan = plan.withColumn("_failed", F.lit(False))
    else:
        bad = failed.select(key).distinct().withColumn("_failed", F.lit(True))
        plan = plan.join(bad, key, "left").fillna(False, ["_failed"])
    pulled = F.col("status").isin("new", "changed")
    return plan.agg(
        F.count_if(F.col("status") != "removed").alias("remote_file_count"),
        F.count_if(F.col("status") == "unchanged").alias("already_current"),
        F.count_if(pulled & ~F.col("_failed")).alias("downloaded"),
        F.count_if(pulled & F.col("_failed")).alias("failed"),
        F.count_if(F.col("status") == "removed").alias("removed"),
    )
