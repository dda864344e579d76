"""Delimited files with a header line: batch, stream, lookup sets, drift checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.sources.lineage import with_lineage


def _options(sep: str, glob: str | None, strict: bool) -> dict[str, str]:
    options = {"sep": sep, "header": "true", "inferSchema": "false"}
    if glob:
        options["pathGlobFilter"] = glob
    if strict:
        # Spark then compares each file's own header with the schema and stops on a difference
        options["enforceSchema"] = "false"
    return options


def read_delimited(
    spark: SparkSession, path: str | list[str], schema: str | None = None,
    glob: str | None = None, sep: str = "\t", strict: bool = False,
) -> DataFrame:
    """Batch scan. Without a schema the names come from the header and every column is text."""
    reader = spark.read.options(**_options(sep, glob, strict))
    return (reader.schema(schema) if schema else reader).csv(path)


def stream_delimited(
    spark: SparkSession, path: str, schema: str,
    glob: str | None = None, sep: str = "\t", strict: bool = False, files_per_batch: int | None = None,
) -> DataFrame:
    """Incremental scan: the checkpoint of the query that uses it remembers the files read."""
    reader = spark.readStream.options(**_options(sep, glob, strict)).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path)


def read_lookups(
    spark: SparkSession, root: str, files: list[str], prefix: str = "bronze_bls_", sep: str = "\t"
) -> dict[str, DataFrame]:
    """One table per lookup file, dots in the name replaced; codes stay text."""
    return {
        prefix + name.replace(".", "_"): with_lineage(read_delimited(spark, f"{root}/{name}", sep=sep))
        for name in files
    }


def file_headers(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """(part_file, line): the first line of every file, from the first block of each."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("part_file"), F.col("_metadata.file_block_start").alias("_start"), "value"
    )
    first = lines.filter("_start = 0").withColumn("_at", F.monotonically_increasing_id())
    return first.groupBy("part_file").agg(F.min_by("value", "_at").alias("line"))


def require_headers(spark: SparkSession, path: str | list[str], expected: list[str] | None = None, sep: str = "\t") -> list[str]:
    """The trimmed column names that all files under ``path`` have; stops where one differs from the others or from ``expected``."""
    names = F.transform(F.split("line", sep), lambda name: F.trim(name))
    found = [row["names"] for row in file_headers(spark, path).select(names.alias("names")).distinct().limit(3).collect()]
    if expected is not None:
        found = [expected, *[names for names in found if names != expected]]
    if len(found) != 1:
        raise ValueError(f"headers of {path} differ: {found}")
    return found[0]


def header_drift(spark: SparkSession, files: dict[str, str], expected: list[str], sep: str = "\t") -> DataFrame:
    """Compare the header line of every part file of each named file with the expected columns.

    One row per part file and column: ``ok``, ``moved``, ``missing`` or ``extra``,
    positions counting from 1.
    """
    heads = reduce(
        DataFrame.unionByName,
        [file_headers(spark, path).withColumn("file", F.lit(name)) for name, path in files.items()],
    )
    actual = heads.select("file", "part_file", F.posexplode(F.split("line", sep)).alias("_pos", "_name")).select(
        "file", "part_file", F.trim("_name").alias("column_name"), (F.col("_pos") + 1).alias("actual_position")
    )
    columns = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(i).alias("expected_position")) for i, n in enumerate(expected, 1)])
    wanted = heads.select("file", "part_file", F.inline(columns))
    status = (
        F.when(F.col("expected_position").isNull(), "extra")
        .when(F.col("actual_position").isNull(), "missing")
        .when(F.col("expected_position") != F.col("actual_position"), "moved")
        .otherwise("ok")
    )
    return wanted.join(actual, ["file", "part_file", "column_name"], "full_outer").select(
        "file", "part_file", "column_name", "expected_position", "actual_position", status.alias("status")
    )


def row_widths(
    spark: SparkSession, path: str | list[str], sep: str = "\t", glob: str | None = None,
    skip_header_of: str | None = None,
) -> DataFrame:
    """How many lines have how many fields: shifted rows show as an odd width.

    ``skip_header_of`` leaves out lines whose first field is that name.
    """
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    lines = reader.text(path)
    if skip_header_of:
        lines = lines.filter(F.trim(F.substring_index("value", sep, 1)) != skip_header_of)
    fields = F.length("value") - F.length(F.translate("value", sep, "")) + 1
    return lines.groupBy(fields.alias("fields")).agg(F.count(F.lit(1)).alias("lines"))
