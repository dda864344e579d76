"""Landing whole-file snapshots under versioned names.

A file source never reads a path twice, so a revision under the same name
would go unseen. Each version is landed as ``<name>__<version>_<hash>``, and
readers take name and version back from the path of the row.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.operators.content import HASH_LENGTH, content_hash
from oreflow.session import only_absent

MARK = "__"


def snapshot_of(path: Column) -> dict[str, Column]:
    """Name, version and content hash encoded in the path of a landed file.

    This runs on every row of a scan, so it cuts the text at fixed marks: a
    regular expression over long paths costs more than all the rest.
    """
    after = F.substring_index(path, MARK, -1)
    before = F.left(path, F.length(path) - F.length(after) - F.lit(len(MARK)))
    version = F.substring_index(after, "_", 1)
    return {
        "file_name": F.substring_index(before, "/", -1),
        "version": version.try_cast("bigint"),
        "content_hash": F.substring(after, F.length(version) + 2, F.lit(HASH_LENGTH)),
    }


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: a hash of the column names and of the rows, which have no order.

    For rows that come from a file, ``content_digest`` of its bytes tells more.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    # the hash passes over NULLs, so where they are is hashed as well
    row_hash = F.xxhash64(*columns, *[c.isNull() for c in columns]).cast("decimal(38,0)")
    mixed = F.concat_ws("|", F.lit(json.dumps(df.columns)), F.count(F.lit(1)), F.coalesce(F.sum(row_hash), F.lit(0)).cast("string"))
    return df.agg(content_hash(F.sha2(mixed, 256)).alias("content_hash"))


LOG_SCHEMA = "file_name STRING, version BIGINT, content_hash STRING"


def newest_landed(spark: SparkSession, root: str, name: str) -> tuple[int, str] | None:
    """Version and hash of the newest complete snapshot, from the log beside the snapshots."""
    try:
        log = spark.read.schema(LOG_SCHEMA).parquet(f"{root}/_landed")
    except AnalysisException as error:
        only_absent(error)
        return None
    newest = log.filter(F.col("file_name") == name).agg(F.max(F.struct("version", "content_hash")).alias("s")).first()["s"]
    return (newest["version"], newest["content_hash"]) if newest else None


def land_snapshot(
    df: DataFrame, root: str, name: str, kind: str = "delimited", sep: str = "\t", digest: str | None = None
) -> bool:
    """Write a snapshot as the next version, unless the newest one has the same content.

    ``digest`` is that of the bytes the rows were read from; without it the rows and
    column names are compared. Returns whether it was written. An earlier
    version's content may come back: only the newest one counts as unchanged. A
    run that dies half-way leaves no log entry, and the next one writes the
    version again. ``kind`` is ``delimited`` or ``text``.
    """
    spark = df.sparkSession
    hash16 = digest[:HASH_LENGTH] if digest else fingerprint(df).first()["content_hash"]
    newest = newest_landed(spark, root, name)
    if newest and newest[1] == hash16:
        return False
    version = newest[0] + 1 if newest else 1
    target = f"{root}/{name}{MARK}{version:08d}_{hash16}"
    if kind == "text":
        df.write.mode("overwrite").text(target)
    else:
        write_delimited(df, target, sep, "overwrite")
    spark.createDataFrame([(name, version, hash16)], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/_landed")
    return True


def write_delimited(df: DataFrame, path: str, sep: str = "\t", mode: str = "errorifexists") -> None:
    """Header and rows as they are: padding is part of the format and is kept."""
    df.write.mode(mode).options(
        sep=sep, header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", emptyValue=""
    ).csv(path)
