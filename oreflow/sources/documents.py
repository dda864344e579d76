"""Text files by line and JSON envelopes that hold an array of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return reader.option("lineSep", "\n").text(path).withColumnRenamed("value", "line")


def stream_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    reader = spark.readStream.option("pathGlobFilter", glob) if glob else spark.readStream
    return reader.option("lineSep", "\n").text(path).withColumnRenamed("value", "line")


def _envelope(record: str, field: str) -> str:
    return f"`{field}` ARRAY<STRUCT<{record}>>"


def read_envelopes(
    spark: SparkSession, path: str | list[str], record: str | None = None,
    field: str = "data", glob: str | None = None,
) -> DataFrame:
    """Whole-file JSON documents. ``record`` pins the field types as DDL; without it they are inferred."""
    reader = spark.read.option("multiLine", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return (reader.schema(_envelope(record, field)) if record else reader).json(path)


def stream_envelopes(
    spark: SparkSession, path: str, record: str, field: str = "data", glob: str | None = None
) -> DataFrame:
    reader = spark.readStream.option("multiLine", "true").schema(_envelope(record, field))
    return (reader.option("pathGlobFilter", glob) if glob else reader).json(path)


#: A record of any fields, each value as text: numbers as they are written, nested values as JSON.
OPEN_RECORD = "MAP<STRING, STRING>"


def read_open_envelopes(spark: SparkSession, path: str | list[str], field: str = "data", glob: str | None = None) -> DataFrame:
    """Whole-file JSON documents whose records keep whatever fields they have."""
    reader = spark.read.option("multiLine", "true").schema(f"`{field}` ARRAY<{OPEN_RECORD}>")
    return (reader.option("pathGlobFilter", glob) if glob else reader).json(path)


def stream_open_envelopes(spark: SparkSession, path: str, field: str = "data", glob: str | None = None) -> DataFrame:
    reader = spark.readStream.option("multiLine", "true").schema(f"`{field}` ARRAY<{OPEN_RECORD}>")
    return (reader.option("pathGlobFilter", glob) if glob else reader).json(path)


def record_field(record: str, *candidates: str) -> Column:
    """The first of the fields that this record has a value for, in any case of its name.

    Names are resolved record by record: those of one stream may differ.
    """
    entries = F.map_entries(record)

    def named(name: str) -> Column:
        return F.get(F.filter(entries, lambda e: (F.lower(e["key"]) == name.lower()) & e["value"].isNotNull()), F.lit(0))["value"]

    return F.coalesce(*[named(name) for name in candidates])


def pinned_records(df: DataFrame, fields: dict[str, tuple[str, ...]], record: str = "record") -> DataFrame:
    """Open records as text columns with fixed names; the record stays beside them under ``_record``."""
    others = [F.col(f"`{c}`") for c in df.columns if c != record]
    return df.select(*[record_field(record, *names).alias(name) for name, names in fields.items()], *others, F.col(record).alias("_record"))


def explode_records(df: DataFrame, field: str = "data") -> DataFrame:
    """One row per array element, its fields as columns. An empty or NULL array gives no row."""
    return df.select(F.explode(field).alias("record")).select("record.*")
