import pytest
from pyspark.sql import functions as F

from oreflow.operators.manifest import MANIFEST_SCHEMA, merge_manifest, plan_pull, run_summary, to_pull
from oreflow.sinks.tables import ensure_table

LISTING = "file_name STRING, size_bytes BIGINT, last_modified STRING"


def plan(spark, remote, manifest):
    return plan_pull(spark.createDataFrame(remote, LISTING), spark.createDataFrame(manifest, LISTING))


@pytest.mark.parametrize(
    "remote, manifest, pulled",
    [
        ([("s", 100, "Mon")], [], ["s"]),
        ([("s", 100, "Mon")], [("s", 100, "Mon")], []),
        ([("s", 200, "Mon")], [("s", 100, "Mon")], ["s"]),
        ([("s", 100, "Tue")], [("s", 100, "Mon")], ["s"]),
        ([], [("s", 100, "Mon")], []),
        ([("same", 1, "Mon"), ("changed", 2, "Mon"), ("new", 3, "Mon")], [("same", 1, "Mon"), ("changed", 1, "Mon")], ["changed", "new"]),
        ([("s", None, "Mon")], [("s", 1, "Mon")], ["s"]),
        ([("s", None, "Mon")], [("s", None, "Mon")], []),
    ],
)
def test_pull_plan(spark, rows, remote, manifest, pulled):
    assert [r[0] for r in rows(to_pull(plan(spark, remote, manifest)))] == pulled


def test_statuses_and_summary(spark, rows):
    p = plan(
        spark,
        [("same", 1, "Mon"), ("changed", 2, "Mon"), ("new", 3, "Mon")],
        [("same", 1, "Mon"), ("changed", 1, "Mon"), ("gone", 1, "Mon")],
    )
    assert rows(p, "file_name", "status") == [("changed", "changed"), ("gone", "removed"), ("new", "new"), ("same", "unchanged")]
    assert rows(run_summary(p)) == [(3, 1, 2, 0, 1)]
    failed = spark.createDataFrame([("new",), ("new",)], "file_name STRING")
    assert rows(run_summary(p, failed)) == [(3, 1, 1, 1, 1)]


def test_merge_updates_and_inserts_once_per_key(spark, rows, tmp_path):
    manifest = ensure_table(spark, str(tmp_path / "manifest"), MANIFEST_SCHEMA)
    assert manifest.count() == 0

    def stamped(data):
        return spark.createDataFrame(data, "file_name STRING, size_bytes BIGINT, last_modified STRING, t STRING").select(
            "file_name", "size_bytes", "last_modified", F.col("t").cast("timestamp").alias("ingested_at")
        )

    first = merge_manifest(manifest, stamped([("a", 1, "Mon", "2024-01-01"), ("b", 1, "Mon", "2024-01-01")]))
    second = merge_manifest(first, stamped([("b", 2, "Tue", "2024-01-02"), ("b", 3, "Wed", "2024-01-03"), ("c", 1, "Mon", "2024-01-02")]))
    assert rows(second, "file_name", "size_bytes", "last_modified") == [("a", 1, "Mon"), ("b", 3, "Wed"), ("c", 1, "Mon")]
    # an update wins even where its own time is older than the manifest's
    third = merge_manifest(second, stamped([("b", 9, "Sun", "2020-01-01")]))
    assert ("b", 9, "Sun") in rows(third, "file_name", "size_bytes", "last_modified")


def test_ensure_table_keeps_what_is_there(spark, tmp_path):
    path = str(tmp_path / "t")
    ensure_table(spark, path, "k INT")
    spark.createDataFrame([(1,)], "k INT").write.mode("append").parquet(path)
    assert ensure_table(spark, path, "k INT").count() == 1
