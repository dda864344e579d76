"""Recomputed tables behind a gate: stage, check, publish.

Layout below a table's root::

    data/version=N        the rows
    metrics/version=N     what the rules found in them, and the rows that drop rules took out
    published/version=N   a marker, written only once version N has passed
    claims/version=N      the writer that works on version N

A reader takes the newest marked version, so it never sees a version that is
being written or that failed, and a table can be rebuilt from itself.

Of two writers at the same time one is refused: a writer claims its version by a
file that only one of them can create, and gives it back when it fails. A writer
that dies keeps its claim; it can be taken over once it is ``CLAIM_HOURS`` old.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from oreflow.operators.quality import Checked, apply_expectations, assertions, counted_rules, observed, rule_counts, violations
from oreflow.session import only_absent


#: A claim this old belongs to a writer that died.
CLAIM_HOURS = 6.0


class VersionClaimed(RuntimeError):
    """Another writer works on this version."""


class ExpectationFailed(RuntimeError):
    """Fail or table rules were violated; nothing was published."""


def published_version(spark: SparkSession, root: str) -> int | None:
    try:
        marked = spark.read.schema("version BIGINT").parquet(f"{root}/published")
    except AnalysisException as error:
        only_absent(error)
        return None
    return marked.agg(F.max("version")).first()[0]


def read_published(spark: SparkSession, root: str) -> DataFrame:
    version = published_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no published version below {root}")
    return read_version(spark, root, version)


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{root}/data/version={version}")


def mark_published(spark: SparkSession, root: str, version: int) -> None:
    spark.range(1).select(F.current_timestamp().alias("published_at")).write.mode("overwrite").parquet(
        f"{root}/published/version={version}"
    )


@contextmanager
def claimed(spark: SparkSession, root: str, version: int, hours: float = CLAIM_HOURS) -> Iterator[None]:
    """The version is this writer's alone for the length of the block."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/claims/version={version}")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.createNewFile(path):
        age = time.time() * 1000 - files.getFileStatus(path).getModificationTime()
        if age < hours * 3_600_000:
            raise VersionClaimed(f"version {version} of {root} is being written since {age / 60_000:.0f} minutes")
        files.delete(path, False)
        if not files.createNewFile(path):
            raise VersionClaimed(f"version {version} of {root} was taken over by another writer")
    try:
        yield
    finally:  # once the version is marked, nobody asks for it again
        files.delete(path, False)


def publish(
    checked: Checked, root: str, cluster_by: tuple[str, ...] = (), table_rules: dict[str, str] | None = None
) -> int:
    """Write the valid rows as the next version and make it current if every fail and table rule holds.

    ``cluster_by`` sorts the table by range, so that a filter on its first
    columns skips files and row groups. The columns should tell rows apart
    well: a value with very many rows is then still cut into several ranges.

    Rows that drop rules take out are counted on their way, by ``observe``, behind
    the last shuffle: there each row passes once. The other rules are judged on what
    was stored, by one aggregate that reads only the columns they name. Raising
    inside the plan would not do: Spark may prune or reorder such an expression
    away. ``table_rules`` are aggregate predicates over the whole staged version,
    such as ``count(*) = 1``. Metrics are written before the marker, under the
    version's name, so a run that is repeated replaces them.

    Another writer at work on the same version raises ``VersionClaimed``.
    """
    spark = checked.df.sparkSession
    version = (published_version(spark, root) or 0) + 1
    with claimed(spark, root, version):
        if (published_version(spark, root) or 0) >= version:
            raise VersionClaimed(f"version {version} of {root} was published meanwhile")
        _publish(checked, root, version, cluster_by, table_rules)
    return version


def _publish(checked: Checked, root: str, version: int, cluster_by: tuple[str, ...], table_rules: dict[str, str] | None) -> None:
    spark = checked.df.sparkSession
    target = f"{root}/data/version={version}"
    drops = [rule for rule in checked.rules if rule.action == "drop"]
    rows = checked.df.repartitionByRange(*cluster_by) if cluster_by else checked.df
    dropped = Observation()
    if drops:
        rows = rows.observe(dropped, *rule_counts(drops))
    rows = apply_expectations(rows, drops).valid
    if cluster_by:
        rows = rows.sortWithinPartitions(*cluster_by)
    rows.write.mode("overwrite").parquet(target)
    found = [counted_rules(spark, observed(dropped, checked.df, rule_counts(drops)), drops)] if drops else []
    judged = [rule for rule in checked.rules if rule.action != "drop"]
    stored = read_version(spark, root, version)
    if judged:
        found.append(violations(stored, judged))
    if table_rules:
        broken = F.when(F.col("passed"), 0).otherwise(1).cast("bigint")
        found.append(assertions(stored, table_rules).select(
            F.col("check_name").alias("rule"), F.lit("table").alias("action"), F.lit(1).cast("bigint").alias("rows"), broken.alias("violations")
        ))
    if found:
        metrics = f"{root}/metrics/version={version}"
        reduce(DataFrame.unionByName, found).coalesce(1).write.mode("overwrite").parquet(metrics)
        # one row per rule at most
        broken = spark.read.parquet(metrics).filter("action IN ('fail', 'table') AND violations > 0").collect()
        if broken:
            faults = ", ".join(f"{row['rule']}: {row['violations']} of {row['rows']} rows" for row in broken)
            raise ExpectationFailed(f"{root} not published ({faults})")
    mark_published(spark, root, version)


def rule_history(spark: SparkSession, root: str) -> DataFrame:
    """What each rule found in each version, failed ones included."""
    found = spark.read.parquet(f"{root}/metrics")
    share = 1 - F.col("violations") / F.col("rows")
    return found.withColumn("pass_rate", F.when(F.col("rows") > 0, share))
