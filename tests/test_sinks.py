from pyspark.sql import functions as F

from oreflow.sinks import (
    append_merged, document_columns, land_snapshot, read_merged, replace_table_as, save_table, write_partitioned,
)
from oreflow.sinks.landing import fingerprint, newest_landed, snapshot_of
from oreflow.streaming import run_available_now


def test_save_and_replace(spark, tmp_path, rows):
    first = save_table(spark.createDataFrame([(1,)], "v INT"), "saved", str(tmp_path / "a"))
    assert rows(first) == [(1,)]
    assert rows(save_table(spark.createDataFrame([(2, "x")], "v INT, w STRING"), "saved", str(tmp_path / "a"))) == [(2, "x")]
    again = replace_table_as(spark, "saved", spark.table("saved").select((F.col("v") + 1).alias("v")), str(tmp_path / "b"), "one more")
    assert rows(again) == [(3,)]
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED saved").collect()}
    assert described["Comment"] == "one more"


def test_column_comments_are_stored(spark, tmp_path):
    path = str(tmp_path / "t")
    document_columns(spark.createDataFrame([(1, 2)], "a INT, b INT"), {"a": "the first"}).write.parquet(path)
    assert spark.read.parquet(path).schema["a"].metadata == {"comment": "the first"}


def test_merged_schema(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    append_merged(spark.createDataFrame([(1,)], "a INT"), path)
    append_merged(spark.createDataFrame([(2, "x")], "a INT, b STRING"), path)
    assert rows(read_merged(spark, path), "a", "b") == [(1, None), (2, "x")]


def test_partitions_are_replaced_one_by_one(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    write_partitioned(spark.createDataFrame([("a", 1), ("b", 2)], "k STRING, v INT"), path, ["k"])
    write_partitioned(spark.createDataFrame([("b", 3), ("c", 4)], "k STRING, v INT"), path, ["k"])
    assert rows(spark.read.parquet(path), "k", "v") == [("a", 1), ("b", 3), ("c", 4)]
    plan = spark.read.parquet(path).filter("k = 'a'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(k" in plan


def test_snapshots_are_landed_once_per_change(spark, tmp_path, rows):
    root = str(tmp_path)
    a, b = (spark.createDataFrame([(v, "q\tt")], "v STRING, w STRING") for v in ("1", "2"))
    assert land_snapshot(a, root, "f") and not land_snapshot(a.repartition(3), root, "f")
    assert land_snapshot(b, root, "f")
    assert land_snapshot(a, root, "f"), "an earlier content came back: that is a change"
    assert newest_landed(spark, root, "f") == (3, fingerprint(a).first()[0])
    read = spark.read.csv(f"{root}/f__*", sep="\t", header=True, schema="v STRING, w STRING")
    parts = snapshot_of(F.col("_metadata.file_path"))
    got = rows(read.select("v", "w", parts["file_name"].alias("f"), parts["version"].alias("n")))
    assert got == [("1", "q\tt", "f", 1), ("1", "q\tt", "f", 3), ("2", "q\tt", "f", 2)]


def test_a_landing_that_died_is_repeated(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([("1",)], "v STRING")
    half = f"{root}/f__00000001_{fingerprint(df).first()[0]}"
    df.limit(0).write.csv(half)  # a snapshot without its log entry
    assert land_snapshot(df, root, "f") and not land_snapshot(df, root, "f")
    assert spark.read.csv(half, header=True).count() == 1


def test_name_of_a_single_landed_file(spark):
    df = spark.createDataFrame([("s3://b/x/pr.data.0.Current__00000012_0123456789abcdef",), ("s3://b/x/plain",)], "p STRING")
    parts = snapshot_of(F.col("p"))
    got = [tuple(r) for r in df.select(parts["file_name"].alias("f"), parts["version"].alias("v"), parts["content_hash"].alias("h")).collect()]
    assert got[0] == ("pr.data.0.Current", 12, "0123456789abcdef") and got[1][1] is None


def test_fingerprint_counts_copies(spark):
    one, two = (spark.createDataFrame([("x",)] * n, "v STRING") for n in (1, 2))
    assert fingerprint(one).first()[0] != fingerprint(two).first()[0]
    assert fingerprint(spark.createDataFrame([], "v STRING")).first()[0] is not None


def test_fingerprint_sees_a_value_change_columns(spark):
    left, right = (spark.createDataFrame([row], "a STRING, b STRING") for row in (("x", None), (None, "x")))
    assert fingerprint(left).first()[0] != fingerprint(right).first()[0]


def test_stream_reads_each_file_once(spark, tmp_path, rows):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "v STRING"

    def run():
        run_available_now(spark.readStream.schema(schema).csv(folder), out, mark)
        return rows(spark.read.parquet(out))

    spark.createDataFrame([("1",)], schema).write.csv(folder)
    assert run() == [("1",)] and run() == [("1",)]
    spark.createDataFrame([("2",)], schema).write.mode("append").csv(folder)
    assert run() == [("1",), ("2",)]
