import pytest
from pyspark.sql import functions as F

from oreflow.operators.quality import Expectation, apply_expectations
from oreflow.sources import pinned_records, read_open_envelopes
from oreflow.streaming import (
    apply_changes, await_all, compact_changes, dedup_with_late, dedup_within_watermark, read_current, read_kept, read_late, read_progress,
    read_rule_counts, run_available_now, start_checked,
)

EVENTS = "k INT, ts TIMESTAMP_NTZ, v STRING"


def events(spark, data):
    return spark.createDataFrame([(k, t, v) for k, t, v in data], "k INT, t STRING, v STRING").select(
        "k", F.col("t").cast("timestamp_ntz").alias("ts"), "v"
    )


@pytest.mark.parametrize("spread", [False, True])
def test_copies_are_dropped_within_and_across_batches(spark, tmp_path, rows, spread):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    data = [(1, "2024-01-01 00:00:00", "a"), (2, "2024-01-01 00:01:00", "b")]

    def run():
        stream = spark.readStream.schema(events(spark, data).schema).parquet(folder)
        by = F.col("_metadata.file_path") if spread else None
        run_available_now(dedup_within_watermark(stream, ["k"], "ts", "1 hour", by), out, mark)
        return rows(spark.read.parquet(out), "k", "v")

    for _ in range(3):
        events(spark, data * 5).write.mode("append").parquet(folder)
    assert run() == [(1, "a"), (2, "b")]
    events(spark, [*data, (3, "2024-01-01 00:02:00", "c")]).write.mode("append").parquet(folder)
    assert run() == [(1, "a"), (2, "b"), (3, "c")]
    assert spark.read.parquet(out).columns == ["k", "ts", "v"]


def test_upserts_newest_sequence_wins(spark, tmp_path, rows):
    folder, target, mark = (str(tmp_path / n) for n in ("in", "users", "mark"))

    def run(data):
        df = events(spark, data)
        df.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(df.schema).parquet(folder)
        apply_changes(stream, target, mark, ["k"], "ts", compact_every=2)
        return rows(read_current(spark, target, ["k"], "ts"), "k", "v")

    assert run([(1, "2024-01-01", "old"), (1, "2024-01-02", "new"), (2, "2024-01-01", "x")]) == [(1, "new"), (2, "x")]
    assert run([(1, "2023-12-31", "late"), (3, "2024-01-01", "z")]) == [(1, "new"), (2, "x"), (3, "z")]
    assert run([(2, "2024-02-01", "y")]) == [(1, "new"), (2, "y"), (3, "z")]
    # compacting again, or up to a batch that is folded in already, changes nothing
    compact_changes(spark, target, ["k"], "ts", 2)
    compact_changes(spark, target, ["k"], "ts", 1)
    assert rows(read_current(spark, target, ["k"], "ts"), "k", "v") == [(1, "new"), (2, "y"), (3, "z")]


def test_a_repeated_batch_replaces_itself(spark, tmp_path, rows):
    target = str(tmp_path / "users")
    batch = events(spark, [(1, "2024-01-01", "a")])
    for _ in range(2):
        batch.write.mode("overwrite").parquet(f"{target}/changes/batch=0")
    assert rows(read_current(spark, target, ["k"], "ts"), "k", "v") == [(1, "a")]


def test_nothing_there(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_current(spark, str(tmp_path / "none"), ["k"], "ts")


def test_a_delete_outlives_compaction(spark, tmp_path, rows):
    folder, target, mark = (str(tmp_path / n) for n in ("in", "users", "mark"))

    def run(data, every=1):
        df = events(spark, data)
        df.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(df.schema).parquet(folder)
        apply_changes(stream, target, mark, ["k"], "ts", compact_every=every, deleted="v = 'gone'")
        return rows(read_current(spark, target, ["k"], "ts"), "k", "v")

    assert run([(1, "2024-01-05", "gone"), (2, "2024-01-01", "x")]) == [(2, "x")]
    assert run([(1, "2024-01-03", "older"), (2, "2024-01-02", "gone"), (2, "2024-01-02", "same time")]) == []
    assert run([(1, "2024-01-07", "back"), (3, "2024-01-01", None)]) == [(1, "back"), (3, None)]
    assert run([(3, "2023-01-01", "gone")], every=100) == [(1, "back"), (3, None)]


def test_late_rows_go_aside(spark, tmp_path, rows):
    folder, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def run(data):
        df = events(spark, data)
        df.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(df.schema).parquet(folder)
        dedup_with_late(stream, target, mark, ["k"], "ts", "1 hour")

    run([(1, "2024-01-01 10:00:00", "a"), (1, "2024-01-01 09:59:00", "first"), (2, "2024-01-01 12:00:00", "b"), (9, None, "no time")])
    # the watermark is 11:00 now
    run([(1, "2024-01-01 10:59:00", "late"), (3, "2024-01-01 11:00:00", "c"), (2, "2024-01-01 13:00:00", "copy"), (9, None, "copy")])
    # 12:00: the first row of 2 still counts, that of 1 at 09:59 is forgotten
    run([(2, "2024-01-01 12:30:00", "copy"), (1, "2024-01-01 12:30:00", "again")])
    assert rows(read_kept(spark, target), "k", "v") == [(1, "again"), (1, "first"), (2, "b"), (3, "c"), (9, "no time")]
    assert rows(read_late(spark, target), "k", "v") == [(1, "late")]
    assert rows(read_progress(spark, target), "batch", "rows", "late", "kept") == [(0, 4, 0, 3), (1, 4, 1, 1), (2, 2, 0, 1)]


def test_a_late_batch_that_is_repeated_changes_nothing(spark, tmp_path, rows):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    df = events(spark, [(1, "2024-01-01 10:00:00", "a")])
    df.write.parquet(folder)
    for mark in ("one", "two"):  # a lost checkpoint: batch 0 comes again
        dedup_with_late(spark.readStream.schema(df.schema).parquet(folder), target, str(tmp_path / mark), ["k"], "ts", "1 hour")
    assert rows(read_kept(spark, target), "k", "v") == [(1, "a")]
    assert rows(read_progress(spark, target), "rows", "late", "kept") == [(1, 0, 1)]


RULES = [Expectation("has_key", "k IS NOT NULL", "drop"), Expectation("small", "k < 3"), Expectation("never", "false")]


def test_rules_are_counted_batch_by_batch(spark, tmp_path, rows):
    folder, out, metrics, mark = (str(tmp_path / n) for n in ("in", "out", "metrics", "mark"))
    schema = "k INT, v STRING"

    def run():
        stream = spark.readStream.schema(schema).parquet(folder)
        await_all([start_checked(apply_expectations(stream, RULES), out, metrics, mark)])
        return rows(read_rule_counts(spark, metrics), "rule", "rows", "violations")

    spark.createDataFrame([(1, "a"), (None, "b"), (5, "c")], schema).write.parquet(folder)
    assert run() == [("has_key", 3, 1), ("never", 2, 2), ("small", 2, 1)]
    assert run() == [("has_key", 3, 1), ("never", 2, 2), ("small", 2, 1)]
    spark.createDataFrame([(None, "d"), (2, "e")], schema).write.mode("append").parquet(folder)
    assert run() == [("has_key", 5, 2), ("never", 3, 3), ("small", 3, 1)]
    assert rows(spark.read.parquet(out), "k", "v") == [(1, "a"), (2, "e"), (5, "c")]


def test_a_rule_that_drops_all_is_counted(spark, tmp_path, rows):
    folder, out, metrics, mark = (str(tmp_path / n) for n in ("in", "out", "metrics", "mark"))
    spark.createDataFrame([(1,), (2,)], "k INT").write.parquet(folder)
    stream = spark.readStream.schema("k INT").parquet(folder)
    await_all([start_checked(apply_expectations(stream, [Expectation("none", "false", "drop")]), out, metrics, mark)])
    assert rows(read_rule_counts(spark, metrics), "rule", "rows", "violations") == [("none", 2, 2)]


def test_open_records_are_resolved_one_by_one(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text(
        '{"data": [{"Year": 1, "n": {"x": [1]}}, {"ID Year": "2", "year": null}, {"year": 3.5, "ID Year": 9}, {"other": true}, null]}'
    )
    records = read_open_envelopes(spark, str(tmp_path / "a.json")).selectExpr("explode(data) AS record")
    pinned = pinned_records(records, {"Year": ("Year", "ID Year"), "n": ("N",)})
    assert rows(pinned, "Year", "n") == [("1", '{"x": [1]}'), ("2", None), ("3.5", None), (None, None), (None, None)]
