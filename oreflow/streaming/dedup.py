"""Streaming deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_within_watermark(
    stream: DataFrame, keys: list[str], time: str, delay: str, spread: Column | None = None, ways: int = 16
) -> DataFrame:
    """The first row of each key; a key is forgotten once the watermark is ``delay`` past it.

    ``time`` may be without a zone: the watermark runs on a copy of it.
    ``spread``, an expression that is constant for a row on every retry (the
    file it came from, say), drops copies in ``ways`` groups per key first, so
    that a key with very many copies does not pass whole through one task.
    """
    columns = stream.columns
    timed = stream.withColumn("_event_time", F.col(time).cast("timestamp")).withWatermark("_event_time", delay)
    if spread is not None:
        timed = timed.withColumn("_way", F.pmod(F.xxhash64(spread), F.lit(ways)))
        timed = timed.dropDuplicatesWithinWatermark([*keys, "_way"])
    return timed.dropDuplicatesWithinWatermark(keys).select(*columns)
