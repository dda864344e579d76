import pytest
from pyspark.sql.types import StructType

from oreflow.sinks import append_evolved, describe_table, overwrite_evolved, read_evolved, save_table, table_comments
from oreflow.sinks.evolution import aligned, merged_schema, wider
from oreflow.sinks.publish import published_version


def kind(text):
    return StructType.fromDDL(f"x {text}")["x"].dataType


@pytest.mark.parametrize("a, b, both", [
    ("INT", "INT", "int"), ("TINYINT", "INT", "int"), ("INT", "BIGINT", "bigint"), ("BIGINT", "DOUBLE", "double"), ("FLOAT", "INT", "double"),
    ("DOUBLE", "STRING", "string"), ("BOOLEAN", "INT", "string"), ("DATE", "TIMESTAMP", "timestamp"), ("DATE", "INT", "string"),
    ("DECIMAL(10,2)", "INT", "decimal(12,2)"), ("DECIMAL(10,2)", "DECIMAL(8,4)", "decimal(12,4)"), ("DECIMAL(38,0)", "DECIMAL(10,9)", "double"),
    ("DECIMAL(10,2)", "DOUBLE", "double"), ("ARRAY<INT>", "ARRAY<BIGINT>", "array<bigint>"), ("VOID", "INT", "int"),
])
def test_the_wider_type(a, b, both):
    assert wider(kind(a), kind(b)).simpleString() == wider(kind(b), kind(a)).simpleString() == both


def test_no_common_type():
    with pytest.raises(ValueError, match="no type holds both"):
        wider(kind("ARRAY<INT>"), kind("STRING"))


def test_names_and_order(spark, rows):
    stored, arriving = StructType.fromDDL("a INT, B STRING"), StructType.fromDDL("b INT, c DATE, A BIGINT")
    merged = merged_schema(stored, arriving)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in merged] == ["a bigint", "B string", "c date"]
    assert rows(aligned(spark.createDataFrame([(7, 1)], "b INT, A BIGINT"), merged)) == [(1, "7", None)]


def test_appends_rewrite_only_for_a_wider_type(spark, tmp_path, rows):
    root = str(tmp_path)
    assert append_evolved(spark.createDataFrame([(1, "x")], "k INT, old STRING"), root) == 1
    assert append_evolved(spark.createDataFrame([(2.5, 2)], "fresh DOUBLE, k SMALLINT"), root) == 1
    assert rows(read_evolved(spark, root), "k", "old", "fresh") == [(1, "x", None), (2, None, 2.5)]
    assert append_evolved(spark.createDataFrame([(1 << 40,)], "k BIGINT"), root) == 2
    assert append_evolved(spark.createDataFrame([("three",)], "K STRING"), root) == 3 == published_version(spark, root)
    assert sorted(r["k"] for r in read_evolved(spark, root).collect()) == ["1", "1099511627776", "2", "three"]


def test_overwrites_keep_columns(spark, tmp_path, rows):
    root = str(tmp_path)
    overwrite_evolved(spark.createDataFrame([(1, "x")], "k INT, old STRING"), root)
    overwrite_evolved(spark.createDataFrame([(2.5, True)], "k DOUBLE, fresh BOOLEAN"), root)
    assert rows(read_evolved(spark, root)) == [(2.5, None, True)]
    with pytest.raises(FileNotFoundError):
        read_evolved(spark, str(tmp_path / "none"))


def test_saved_tables_merge_on_request(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    save_table(spark.createDataFrame([(1, "x")], "v INT, w STRING"), "merging", path)
    merged = save_table(spark.createDataFrame([(2.5, 1)], "v DOUBLE, u INT"), "merging", path, merge_schema=True)
    assert merged.columns == ["v", "w", "u"] and rows(merged) == [(2.5, None, 1)]


def test_comments_in_the_catalog(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 2)], "a INT, b INT").write.parquet(path)
    assert rows(describe_table(spark, "described", path, "it's a table", {"a": "the first"})) == [(1, 2)]
    got = {(r.column_name, r.comment) for r in table_comments(spark, ["described"]).collect()}
    assert got == {(None, "it's a table"), ("a", "the first"), ("b", None)}
    with pytest.raises(ValueError, match="no columns"):
        describe_table(spark, "described", path, "", {"c": "none"})
