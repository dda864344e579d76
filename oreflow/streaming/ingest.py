"""Incremental append: each file is read once, however often the run is repeated."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from oreflow.operators.quality import Checked, apply_expectations, counted_rules, observed, rule_counts


def start_available_now(
    stream: DataFrame, out: str, checkpoint: str, partition_by: tuple[str, ...] = ()
) -> StreamingQuery:
    """Start appending everything that has arrived since the last run; the query stops by itself."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(out)


def start_checked(
    checked: Checked, out: str, metrics: str, checkpoint: str, partition_by: tuple[str, ...] = ()
) -> StreamingQuery:
    """Append the valid rows of everything that has arrived, and count what each rule finds, batch by batch.

    A batch writes ``<out>/batch=N`` and ``<metrics>/batch=N``. Both are named by its id, so
    a batch that is run again replaces what it wrote. Rows are counted by
    ``observe`` while they are written, in the same pass.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        rows = batch.observe(seen, *rule_counts(checked.rules)) if checked.rules else batch
        writer = apply_expectations(rows, checked.rules).valid.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{out}/batch={batch_id}")
        if checked.rules:
            counts = counted_rules(batch.sparkSession, observed(seen, batch, rule_counts(checked.rules)), checked.rules)
            counts.write.mode("overwrite").parquet(f"{metrics}/batch={batch_id}")

    query = checked.df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return query.trigger(availableNow=True).start()


def read_rule_counts(spark: SparkSession, metrics: str) -> DataFrame:
    """Rows seen and violations of each rule over all batches."""
    found = spark.read.parquet(metrics).groupBy("rule", "action")
    return found.agg(F.sum("rows").alias("rows"), F.sum("violations").alias("violations"))


def await_all(queries: Iterable[StreamingQuery]) -> None:
    """Wait for every query, then report the first failure."""
    failure = None
    for query in queries:
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            failure = failure or error
    if failure:
        raise failure


def run_available_now(stream: DataFrame, out: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> None:
    await_all([start_available_now(stream, out, checkpoint, partition_by)])
