"""What several operators need: cutting lineage, held-out rows, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.session import work_dir


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed now and kept in the shared checkpoint folder.

    The cluster names the folder in ``spark.checkpoint.dir``; only where that is
    unset, as in tests, a folder of the session's warehouse takes its place.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


#: Narrow rows (some numbers each) that make a partition worth a task of its own.
ROWS_PER_PARTITION = 200_000


def checkpointed_narrow(df: DataFrame) -> DataFrame:
    """``df`` checkpointed, in as many partitions as its narrow rows fill: further shuffles write no files for empty ones."""
    kept = checkpointed(df)
    return kept.coalesce(1 + kept.count() // ROWS_PER_PARTITION)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs of this block hand Python at most so many rows at once: for rows that are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def held_out(doc_id: Column | str) -> Column:
    """Rows kept out of training: crc32 of the id as text, modulo 5, is 0. A null id is held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def typed(df: DataFrame, name: str, kind: str) -> Column:
    """The column as it is where it has this type, else cast. (An alias would keep Spark from seeing equal plans.)"""
    return F.col(name) if dict(df.dtypes).get(name) == kind else F.col(name).cast(kind).alias(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: long); the component is its smallest node.

    Alternates large-star and small-star steps: each replaces edges by edges to the
    smallest neighbour, which keeps components and makes every one a star in a
    number of steps that grows with the logarithm of its size. The smallest
    neighbour is an aggregate, so no neighbourhood is ever gathered in one place;
    hot nodes only make a skewed join, which Spark splits.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = checkpointed_narrow(pairs)
    seen = None
    for _ in range(rounds):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("low").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")
        ).select("e.*").filter("a <> b").distinct()
        pairs = checkpointed_narrow(small)
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
