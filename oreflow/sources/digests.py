"""Digests of the bytes of files, so that any revision shows: a header, an order, an encoding.

A file up to ``LARGE_BYTES`` is read whole and hashed. A larger one is hashed in
parallel: its lines are numbered over all splits, every ``LINES_PER_BLOCK`` of them make
a block, and the digest is that of its size and the block digests. It does not depend
on how Spark splits the file. Files without a byte are not listed by the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LARGE_BYTES = 256 << 20
LINES_PER_BLOCK = 1 << 16


def _joined_digest(place: str, digest: str) -> Column:
    """Digest of the digests of a group, in the order of their places."""
    ordered = F.array_sort(F.collect_list(F.struct(place, digest)))
    return F.sha2(F.array_join(F.transform(ordered, lambda x: x[digest]), ","), 256)


def _line_digests(lines: DataFrame, block_lines: int) -> DataFrame:
    """(file, blocks): the digest of each file's lines.

    The line reader drops an opening byte-order mark and the last line's end; the
    size that goes into a file's digest tells these apart.
    """
    split = ["file", "split"]
    numbered = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"), F.sha2(F.col("value").cast("binary"), 256).alias("digest"),
    )
    # one row per split of a file
    starts = numbered.groupBy(*split).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("lines"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("before", F.coalesce(F.sum("lines").over(before), F.lit(0))).drop("lines")
    placed = numbered.join(starts, split).select("file", "digest", (F.col("id") - F.col("first") + F.col("before")).alias("line"))
    blocks = placed.groupBy("file", F.floor(F.col("line") / block_lines).alias("block")).agg(_joined_digest("line", "digest").alias("digest"))
    return blocks.groupBy("file").agg(_joined_digest("block", "digest").alias("blocks"))


def file_digests(
    spark: SparkSession, path: str, names: list[str] | None = None, large: int = LARGE_BYTES, block_lines: int = LINES_PER_BLOCK
) -> DataFrame:
    """(file, file_name, size_bytes, digest) of every file below ``path``, or of those with the given names.

    Filters on name and size keep Spark from opening other files.
    """
    wanted = F.lit(True) if names is None else F.col("_metadata.file_name").isin(names)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).filter(wanted)
    facts = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"), F.col("length").alias("size_bytes")]
    small = listed.filter(F.col("length") <= large).select(*facts, F.sha2("content", 256).alias("digest"))
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    lines = lines.filter(wanted & (F.col("_metadata.file_size") > large))
    sizes = listed.filter(F.col("length") > large).select(*facts)
    in_blocks = sizes.join(_line_digests(lines, block_lines), "file", "left")
    return small.unionByName(in_blocks.select("file", "file_name", "size_bytes", F.sha2(F.concat_ws("|", "size_bytes", "blocks"), 256).alias("digest")))


def content_digest(spark: SparkSession, path: str) -> str:
    """One digest of a file, or of the data files of a folder in the order of their names."""
    files = file_digests(spark, path).filter(~F.col("file_name").rlike("^[._]"))
    return files.agg(_joined_digest("file_name", "digest").alias("digest")).first()["digest"]
