"""Table writers: overwrite, replace from a query, merged schemas, partitions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from oreflow.session import only_absent
from oreflow.sinks.evolution import aligned, merged_schema


def save_table(df: DataFrame, name: str, path: str | None = None, merge_schema: bool = False) -> DataFrame:
    """Overwrite a managed table, or an external one at ``path``.

    With ``merge_schema`` the columns that the table had before stay: those that ``df`` lacks
    are NULL, and a column of two types gets the wider one.
    """
    spark = df.sparkSession
    if merge_schema and spark.catalog.tableExists(name):
        df = aligned(df, merged_schema(spark.read.table(name).schema, df.schema))
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return spark.read.table(name)


def replace_table_as(spark: SparkSession, name: str, query: DataFrame, path: str, comment: str = "") -> DataFrame:
    """Create or replace a table from a query.

    The rows go to a fresh ``path`` first, so the query may read the table it
    replaces; the name is switched once they are complete.
    """
    query.write.mode("errorifexists").parquet(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path, source="parquet", description=comment)
    return spark.read.table(name)


def document_columns(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column comments; Parquet keeps them with the schema."""
    return df.select(
        *[F.col(f"`{c}`").alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(f"`{c}`")
          for c in df.columns]
    )


def ensure_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, created empty with the given schema where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        only_absent(error)
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
        return spark.read.schema(schema).parquet(path)


def append_merged(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read files of different column sets as one table; absent columns are NULL."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_partitioned(df: DataFrame, path: str, keys: list[str]) -> None:
    """Overwrite only the partitions that ``df`` holds.

    Rows are gathered per partition key so that tasks do not each open every
    partition, and AQE splits a key with very many rows over several tasks.
    """
    gathered = df.hint("rebalance", *keys)
    gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def describe_table(
    spark: SparkSession, name: str, path: str, comment: str, columns: dict[str, str] | None = None
) -> DataFrame:
    """Enter the files at ``path`` in the catalog as a table, with comments on it and its columns; the files stay as they are."""
    columns = columns or {}
    schema = spark.read.parquet(path).schema
    unknown = sorted(set(columns) - set(schema.names))
    if unknown:
        raise ValueError(f"{name} has no columns {unknown} to comment on")
    commented = StructType([StructField(f.name, f.dataType, True, {"comment": columns[f.name]} if f.name in columns else {}) for f in schema])
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path, source="parquet", schema=commented, description=comment)
    return spark.read.table(name)


def table_comments(spark: SparkSession, names: list[str]) -> DataFrame:
    """(table_name, column_name, comment): what the catalog says of tables (column NULL) and of their columns."""
    rows = []
    for name in names:
        rows.append((name, None, spark.catalog.getTable(name).description))
        rows += [(name, column.name, column.description) for column in spark.catalog.listColumns(name)]
    return spark.createDataFrame(rows, "table_name STRING, column_name STRING, comment STRING")
