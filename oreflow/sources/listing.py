"""File listings as a DataFrame, the input of the pull plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Name, size and date of every file directly in ``path``; those in its folders are not listed.

    The content column is not selected, so no file is opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    folder = F.element_at(F.split(F.lit(path.rstrip("/")), "/"), -1)
    return reader.load(path).filter(F.element_at(F.split("path", "/"), -2) == folder).select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("size_bytes"),
        F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("last_modified"),
    )
