"""Landing a folder of plainly named files as versioned snapshots.

The folder stands for what a downloader left behind: files that are revised
under the same name. Each run lists it once, compares with the manifest, lands what
is new or changed and updates the manifest. Files that disappear stay landed.

The listing is stored before anything is copied, and the manifest records what it
said, so a file that is revised meanwhile is seen as changed by the next run. A
file that cannot be landed whole is refused: an envelope that is not valid, or
rows with more fields than the header. It stays out of the manifest, the others go
on, and the run raises at its end.

What counts as a new version is the digest of a file's bytes: a new header, order
or encoding shows as well as a new value. Digests and checks are one job each for
all files of a run.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow import layouts
from oreflow.operators.content import envelope_status
from oreflow.operators.manifest import MANIFEST_SCHEMA, merge_manifest, plan_pull, run_summary, to_pull
from oreflow.operators.quality import Expectation, apply_expectations
from oreflow.session import work_dir
from oreflow.sinks.landing import land_snapshot
from oreflow.sinks.publish import publish, published_version, read_published
from oreflow.sources.delimited import read_delimited
from oreflow.sources.digests import file_digests
from oreflow.sources.listing import list_files


# the manifest's columns are NOT NULL: a file format keeps no such constraint, a fail rule does
MANIFEST_RULES = [
    Expectation(f"{column.split()[0]}_not_null", f"{column.split()[0]} IS NOT NULL", "fail") for column in MANIFEST_SCHEMA.split(", ")
]


def load_manifest(spark: SparkSession, root: str) -> DataFrame:
    if published_version(spark, root) is None:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return read_published(spark, root)


def _snapshot(spark: SparkSession, path: str, name: str) -> tuple[DataFrame, str]:
    """Rows of a raw file and the format they are landed in."""
    if name.endswith(".json"):
        return spark.read.text(path, wholetext=True), "text"
    if name == layouts.NOTES_FILE:
        return spark.read.option("lineSep", "\n").text(path), "text"
    return read_delimited(spark, path), "delimited"


class LandingFailed(RuntimeError):
    """Some files were not landed. ``summary`` has the counts of the run, ``failed`` names and reasons."""

    def __init__(self, summary: dict[str, int], failed: list[tuple[str, str]]):
        super().__init__(f"{len(failed)} files were not landed: {failed[:3]}")
        self.summary, self.failed = summary, failed


def _faults(spark: SparkSession, raw: str, names: list[str]) -> dict[str, str]:
    """Why files must not be landed: of the delimited ones and the envelopes in one job each."""
    file_name = F.col("_metadata.file_name")
    found = {}
    envelopes = [name for name in names if name.endswith(".json")]
    if envelopes:
        status = spark.read.text([f"{raw}/{name}" for name in envelopes], wholetext=True).select(
            file_name.alias("name"), envelope_status(F.col("value")).alias("status")
        )
        found |= {row["name"]: f"envelope is {row['status']}" for row in status.filter("status <> 'ok'").collect()}
    delimited = [name for name in names if name not in envelopes and name != layouts.NOTES_FILE]
    if delimited:
        lines = spark.read.text([f"{raw}/{name}" for name in delimited]).select(
            file_name.alias("name"), (F.length("value") - F.length(F.translate("value", "\t", "")) + 1).alias("fields"),
            F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
        )
        widths = lines.groupBy("name").agg(F.min_by("fields", "place").alias("header"), F.max("fields").alias("widest"))
        for row in widths.filter("widest > header").collect():
            found[row["name"]] = f"a row has {row['widest']} fields, the header {row['header']}"
    return found


def _one_by_one(spark: SparkSession, raw: str, names: list[str]) -> tuple[dict[str, str], dict[str, str]]:
    """Digests and faults of files some of which can't be read: these are faults, the others are judged."""
    digests, faults = {}, {}
    for name in names:
        try:
            digests |= _digests(spark, raw, [name])
            faults |= _faults(spark, raw, [name])
        except PySparkException as error:
            faults[name] = str(error)[:300]
    return digests, faults


def _digests(spark: SparkSession, raw: str, names: list[str]) -> dict[str, str]:
    return {row["file_name"]: row["digest"] for row in file_digests(spark, raw, names).collect()}


def land_folder(spark: SparkSession, raw: str, landing: str, manifest_root: str) -> DataFrame:
    """One run. Returns its summary: files seen, current, landed, failed, removed.

    Files are copied one after the other, each by all tasks: meant for a folder of
    some large files, not for millions of small ones.
    """
    manifest = load_manifest(spark, manifest_root)
    stored = work_dir(spark, "pull-plan")
    plan_pull(list_files(spark, raw), manifest).write.parquet(stored)
    plan = spark.read.parquet(stored)
    pulled = to_pull(plan)
    names = sorted(row["file_name"] for row in pulled.select("file_name").collect())
    try:
        digests, faults = (_digests(spark, raw, names), _faults(spark, raw, names)) if names else ({}, {})
    except PySparkException:
        digests, faults = _one_by_one(spark, raw, names)
    failed: list[tuple[str, str]] = list(faults.items())
    for name in names:
        if name in faults:
            continue
        try:
            rows, kind = _snapshot(spark, f"{raw}/{name}", name)
            land_snapshot(rows, landing, name, kind=kind, digest=digests.get(name))
        except PySparkException as error:  # one file's trouble must not keep the others out
            failed.append((name, str(error)[:300]))
    bad = spark.createDataFrame(failed, "file_name STRING, reason STRING")
    updates = pulled.join(bad, "file_name", "left_anti").withColumn("ingested_at", F.current_timestamp())
    publish(apply_expectations(merge_manifest(manifest, updates), MANIFEST_RULES), manifest_root)
    summary = run_summary(plan, bad)
    if failed:
        raise LandingFailed(summary.first().asDict(), failed)
    return summary
