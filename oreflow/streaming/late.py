"""Deduplication that keeps what comes too late.

Spark's stateful operators drop rows behind the watermark; here they go to a side
table, counted. Layout below the target::

    kept/batch=N      first row of each key of micro-batch N that no earlier batch has
    late/batch=N      rows behind the watermark that held when batch N began
    progress/batch=N  one row: rows, late, kept, and the newest event time so far

A batch reads only what batches before it wrote and writes under its own id, so a
run that is repeated after a loss writes the same again. The kept rows are the
state: only those within the delay of the watermark are compared.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from oreflow.operators.dedup import dedup_latest
from oreflow.operators.quality import observed
from oreflow.session import only_absent

PROGRESS = "batch BIGINT, rows BIGINT, late BIGINT, kept BIGINT, newest TIMESTAMP"


def _before(spark: SparkSession, path: str, batch_id: int, schema: str | None = None) -> DataFrame | None:
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path).filter(F.col("batch") < batch_id)
    except AnalysisException as error:
        only_absent(error)
        return None


def read_progress(spark: SparkSession, target: str) -> DataFrame:
    """Rows, late rows and kept rows of each batch."""
    return spark.read.schema(PROGRESS).parquet(f"{target}/progress")


def read_kept(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/kept").drop("batch")


def read_late(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/late").drop("batch")


def dedup_with_late(stream: DataFrame, target: str, checkpoint: str, keys: list[str], time: str, delay: str) -> None:
    """The first row of each key of everything that has arrived; late rows beside it.

    The watermark is the newest event time of earlier batches less ``delay``. A row is
    late if its time lies before it. A key is forgotten once the watermark is
    ``delay`` past its first row. Rows without a time are never late or forgotten.
    """
    span = F.expr(f"INTERVAL {delay}")
    at = F.col(f"`{time}`").cast("timestamp")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = _before(spark, f"{target}/progress", batch_id, PROGRESS)
        newest = done.agg(F.max("newest")).first()[0] if done is not None else None
        watermark = F.lit(newest).cast("timestamp") - span
        is_late = F.coalesce(at < watermark, F.lit(False))
        seen, left = Observation(), Observation()
        # counted behind no shuffle, so that each row counts once
        facts = [F.count(F.lit(1)).alias("rows"), F.count_if(is_late).alias("late"), F.max(at).alias("newest")]
        batch.observe(seen, *facts).filter(is_late).write.mode("overwrite").parquet(f"{target}/late/batch={batch_id}")
        once = dedup_latest(batch.filter(~is_late), keys, [at.asc_nulls_last()])
        known = _before(spark, f"{target}/kept", batch_id)
        if known is not None and newest is not None:
            known = known.filter(at.isNull() | (at + span >= watermark)).select(*[F.col(f"`{k}`").alias(f"_known_{k}") for k in keys])
            same = F.lit(True)
            for k in keys:
                same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"`_known_{k}`"))
            once = once.join(known, same, "left_anti")
        once.observe(left, F.count(F.lit(1)).alias("kept")).write.mode("overwrite").parquet(f"{target}/kept/batch={batch_id}")
        counts = observed(seen, batch, facts)
        latest = max((t for t in (newest, counts.get("newest")) if t is not None), default=None)
        kept = observed(left, spark.read.parquet(f"{target}/kept/batch={batch_id}"), [F.count(F.lit(1)).alias("kept")])["kept"]
        row = (counts["rows"], counts["late"], kept, latest)
        progress = spark.createDataFrame([row], PROGRESS.split(", ", 1)[1])
        progress.coalesce(1).write.mode("overwrite").parquet(f"{target}/progress/batch={batch_id}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
