"""Content-addressed versions and envelope validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed value: length of the hash in a version's name ---
HASH_LENGTH = 16


def content_hash(digest: Column) -> Column:
    return F.substring(digest, 1, HASH_LENGTH)


def content_versions(
    df: DataFrame, content: str, version: str, known: DataFrame | None = None, known_content: str | None = None
) -> DataFrame:
    """Each distinct content once: its hash, when it was first seen, how often it occurs.

    Contents are told apart by the whole digest; the short hash only names
    them. ``known`` holds contents that are stored already: those are left out.
    """
    digest = F.sha2(F.col(content), 256)
    seen = (
        df.filter(F.col(content).isNotNull())
        .groupBy(digest.alias("digest"))
        .agg(F.min(version).alias("first_version"), F.count(F.lit(1)).alias("copies"))
    )
    if known is not None:
        stored = known.select(F.sha2(F.col(known_content or content), 256).alias("digest"))
        seen = seen.join(stored, "digest", "left_anti")
    return seen.select(content_hash(F.col("digest")).alias("content_hash"), "digest", "first_version", "copies")


def content_latest(df: DataFrame, file: str, version: str, content: str) -> DataFrame:
    """The newest content of each file.

    The newest version is found on the two narrow columns first, so contents
    are neither sorted nor carried through the aggregate.
    """
    newest = df.groupBy(file).agg(F.max(version).alias(version))
    return df.select(file, version, content).join(newest, [file, version], "left_semi").select(
        file, version, content_hash(F.sha2(F.col(content), 256)).alias("content_hash"), content
    )


def envelope_status(payload: Column, field: str = "data") -> Column:
    """``ok`` where the payload is an object whose field is a non-empty array, else the fault."""
    value = F.get_json_object(payload, f"$.{field}")
    items = F.json_array_length(value)
    return (
        F.when(value.isNull(), "missing")
        .when(items.isNull(), "not an array")
        .when(items == 0, "empty")
        .otherwise("ok")
    )


def envelope_records(payload: Column, field: str = "data") -> Column:
    """Number of records in the envelope, NULL where it is not valid."""
    return F.json_array_length(F.get_json_object(payload, f"$.{field}"))
