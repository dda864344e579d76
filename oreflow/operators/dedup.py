"""Deterministic deduplication and snapshot selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: list[str], newest_first: list[Column] | None = None) -> DataFrame:
    """One row per key: the first in the given order, the remaining columns settling ties.

    The filter on the rank lets Spark keep one row per key and task before the
    shuffle, so a key with very many rows sends few of them.
    """
    rest = [F.col(f"`{c}`").desc_nulls_last() for c in df.columns if c not in keys]
    order = [*(newest_first or []), *rest] or [F.lit(1)]
    rank = F.row_number().over(Window.partitionBy(*[f"`{k}`" for k in keys]).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_snapshot(df: DataFrame, file: str = "file_name", version: str = "version") -> DataFrame:
    """Only the rows of each file's newest version, so that rows a revision removed are gone.

    The list of newest versions has a row per file. Spark broadcasts it while
    it is below the session's threshold and shuffles beyond that, splitting
    files with very many rows.
    """
    newest = df.groupBy(file).agg(F.max(version).alias(version))
    return df.join(newest, [file, version], "left_semi")
