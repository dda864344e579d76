"""Change data: upserts and deletes where the newest sequence wins.

Layout below the target::

    changes/batch=N          newest row per key of micro-batch N
    base/data/version=N      all keys up to and including batch N, compacted
    base/published/version=N marker of a finished compaction

A micro-batch writes only what changed. Its path is named by its id, so a
batch that is run again replaces itself. Readers merge the newest base with
the batches after it, and compaction keeps that tail short.

A delete is kept as a row like any other, marked in ``_deleted``, also through
compaction: an upsert with an older sequence that comes later can't revive the key.
Readers leave marked rows out. At an equal sequence the delete wins.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.operators.dedup import dedup_latest
from oreflow.session import only_absent
from oreflow.sinks.publish import mark_published, published_version, read_version

MARK = "_deleted"


def _tail(spark: SparkSession, target: str, after: int | None, upto: int | None = None) -> DataFrame | None:
    try:
        changes = spark.read.option("basePath", f"{target}/changes").option("mergeSchema", "true").parquet(f"{target}/changes/batch=*")
    except AnalysisException as error:
        only_absent(error)
        return None
    # a filter on the partition column: Spark lists but does not open the other batches
    wanted = F.lit(True) if after is None else F.col("batch") > after
    return changes.filter(wanted if upto is None else wanted & (F.col("batch") <= upto)).drop("batch")


def _newest(spark: SparkSession, target: str, keys: list[str], sequence: str, upto: int | None = None) -> DataFrame:
    """The newest change of each key, deletes included."""
    base = published_version(spark, f"{target}/base")
    tail = _tail(spark, target, base, upto)
    parts = [p for p in (None if base is None else read_version(spark, f"{target}/base", base), tail) if p is not None]
    if not parts:
        raise FileNotFoundError(f"no changes below {target}")
    # what was written before deletes were known has no mark
    parts = [p if MARK in p.columns else p.withColumn(MARK, F.lit(False)) for p in parts]
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return dedup_latest(rows.withColumn(MARK, F.coalesce(MARK, F.lit(False))), keys, _order(sequence))


def _order(sequence: str) -> list[Column]:
    return [F.desc_nulls_last(sequence), F.desc(MARK)]


def read_current(
    spark: SparkSession, target: str, keys: list[str], sequence: str, upto: int | None = None
) -> DataFrame:
    """The newest row of each key that is not deleted."""
    return _newest(spark, target, keys, sequence, upto).filter(~F.col(MARK)).drop(MARK)


def compact_changes(spark: SparkSession, target: str, keys: list[str], sequence: str, upto: int) -> None:
    """Fold the batches up to ``upto`` into a new base, deletes included."""
    done = published_version(spark, f"{target}/base")
    if done is not None and done >= upto:
        return
    _newest(spark, target, keys, sequence, upto).write.mode("overwrite").parquet(f"{target}/base/data/version={upto}")
    mark_published(spark, f"{target}/base", upto)


def apply_changes(
    stream: DataFrame, target: str, checkpoint: str, keys: list[str], sequence: str, compact_every: int = 20,
    deleted: str = "false",
) -> None:
    """Upsert everything that has arrived since the last run; rows where ``deleted`` holds delete their key."""

    def upsert(batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn(MARK, F.coalesce(F.expr(deleted), F.lit(False)))
        newest = dedup_latest(marked, keys, _order(sequence))
        newest.write.mode("overwrite").parquet(f"{target}/changes/batch={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            compact_changes(batch.sparkSession, target, keys, sequence, batch_id)

    query = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
