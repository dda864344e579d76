import pytest
from pyspark.sql import functions as F

from oreflow.operators import verify


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("b", None), ("c", 3)], "k STRING, v INT")
    right = spark.createDataFrame([("a", 1), ("b", None), ("d", 4)], "k STRING, v INT")
    return left, right


def test_difference_equals_both_set_differences(sides):
    left, right = sides
    expected = left.exceptAll(right).count() + right.exceptAll(left).count()
    assert verify.diff_count(left, right).first()[0] == expected == 4
    assert verify.diff_count(right, left).first()[0] == expected
    assert verify.diff_count(left, left.repartition(3)).first()[0] == 0


def test_columns_are_matched_by_name(sides):
    left, _ = sides
    assert verify.diff_count(left, left.select("v", "k")).first()[0] == 0
    with pytest.raises(ValueError):
        verify.diff_count(left, left.select("k"))


def test_empty_sides(spark):
    empty = spark.createDataFrame([], "k STRING")
    assert verify.diff_count(empty, empty).first()[0] == 0
    assert verify.diff_count(empty, spark.createDataFrame([("x",)], "k STRING")).first()[0] == 1


@pytest.mark.parametrize("x, y, alike", [
    (0.1 + 0.2, 0.3, True), (1.0000000000005, 1.0000000000005002, True), (0.0, -0.0, True), (1e300, 1.0000000001e300, True),
    (float("nan"), float("nan"), True), (float("inf"), float("inf"), True), (None, None, True),
    (0.3, 0.31, False), (None, 0.0, False), (float("nan"), 1.0, False), (float("inf"), 1e300, False), (1e-300, 2e-300, False),
])
def test_tolerance_hides_the_last_bits_only(spark, x, y, alike):
    left, right = (spark.createDataFrame([("k", v), ("other", 1.0)], "k STRING, v DOUBLE") for v in (x, y))
    assert verify.diff_count(left, right, tolerance=1e-9).first()[0] == (0 if alike else 2)


def test_tolerance_counts_rows_that_one_side_lacks(spark):
    left = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0)], "k STRING, v DOUBLE")
    right = spark.createDataFrame([("a", 1.0), ("a", 2.0 + 1e-12)], "k STRING, v DOUBLE")
    assert verify.diff_count(left, right, tolerance=1e-9).first()[0] == 1
    assert verify.diff_count(left.select("v"), right.select("v"), tolerance=1e-9).first()[0] == 1


def test_tolerance_compares_every_row(spark):
    schema = "k STRING, v DOUBLE"
    left = spark.createDataFrame([("k", 1.0), ("k", 2.0), ("k", 3.0)], schema)
    assert verify.diff_count(left, spark.createDataFrame([("k", 1.0), ("k", 2.5), ("k", 3.0)], schema), 1e-9).first()[0] == 2
    assert verify.diff_count(left, spark.createDataFrame([("k", 2.0 + 1e-12), ("k", 3.0)], schema), 1e-9).first()[0] == 1
    assert verify.diff_count(left, spark.createDataFrame([("k", x * (1 + 1e-12)) for x in (3.0, 1.0, 2.0)], schema), 1e-9).first()[0] == 0


def test_tolerance_pairs_values_of_one_row(spark):
    schema = "x DOUBLE, y FLOAT, k INT"
    left = spark.createDataFrame([(1.0, 5.0, 1), (2.0, 6.0, 1), (None, 6.0, 1)], schema)
    right = spark.createDataFrame([(1.0 + 1e-12, 6.0, 1), (2.0, 5.0, 1), (None, 6.0, 1)], schema)
    assert verify.diff_count(left, right, 1e-9).first()[0] == 4
    assert verify.diff_count(left.drop("k"), left.drop("k").repartition(3), 1e-9).first()[0] == 0


def test_except_all_equals_the_builtin(sides, rows):
    left, right = sides
    assert rows(verify.except_all(left, right)) == rows(left.exceptAll(right))
    assert rows(verify.except_all(right, left)) == rows(right.exceptAll(left))


def test_many_copies_are_written_in_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(verify, "COPIES_PER_BLOCK", 10)
    left = spark.range(2057).selectExpr("'hot' AS k").unionByName(spark.createDataFrame([("cold",)] * 10, "k STRING"))
    right = spark.range(4).selectExpr("'hot' AS k")
    got = verify.except_all(left, right)
    assert {r["k"]: r["count"] for r in got.groupBy("k").count().collect()} == {"hot": 2053, "cold": 10}
    tasks = {r[0]: r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()}
    assert len(tasks) == 4 and max(tasks.values()) < 0.5 * 2063


def test_overlap(spark, rows):
    current = spark.createDataFrame([(1,), (2,), (2,)], "k INT")
    everything = spark.createDataFrame([(2,), (3,), (4,)], "k INT")
    assert rows(verify.overlap_audit(current, everything, ["k"])) == [("all data only", 2), ("both", 1), ("current only", 1)]
