from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_lineage(df: DataFrame, source_file: bool = False) -> DataFrame:
    """Add the time of ingestion and, on request, the path of the file a row came from."""
    df = df.withColumn("_ingested_at", F.current_timestamp())
    return df.withColumn("_source_file", F.col("_metadata.file_path")) if source_file else df
