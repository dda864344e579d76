import pytest
from pyspark.sql import functions as F

from oreflow.functions.names import resolve_column, sanitize_names
from oreflow.operators.dedup import dedup_latest, latest_snapshot
from oreflow.plans.medallion import silver_observations, silver_population

RAW = "series_id STRING, year STRING, period STRING, value STRING, footnote_codes STRING"


def silver(spark, data, **kw):
    return silver_observations(spark.createDataFrame(data, RAW), **kw)


def test_padding_and_types(spark, rows):
    got = rows(silver(spark, [("PRS1     ", " 1995", "Q01 ", "   2.5", " x ")]).valid)
    assert got == [("PRS1", 1995, "Q01", 2.5, "x")]


def test_bad_values_become_null_and_stay(spark, rows):
    data = [("a", "1995", f"Q0{i}", v, None) for i, v in enumerate(["-", "", "   ", None, "1e2"], 1)]
    assert [r[3] for r in rows(silver(spark, data).valid)] == [None, None, None, None, 100.0]


@pytest.mark.parametrize("year, kept", [("1900", 1), ("2100", 1), ("1899", 0), ("2101", 0), ("abcd", 0), (None, 0), ("", 0)])
def test_years(spark, year, kept):
    assert silver(spark, [("a", year, "Q01", "1", None)]).valid.count() == kept


@pytest.mark.parametrize(
    "period, kept", [("Q01", 1), ("Q05", 1), ("Q06", 0), ("Q00", 0), ("S03", 0), ("M13", 0), (None, 0), ("xQ01", 0), ("Q011", 0)]
)
def test_periods(spark, period, kept):
    assert silver(spark, [("a", "1995", period, "1", None)]).valid.count() == kept


@pytest.mark.parametrize("series", [None, "", "   "])
def test_series_without_id_is_dropped(spark, series):
    checked = silver(spark, [(series, "1995", "Q01", "1", None)])
    assert checked.valid.count() == 0 and checked.quarantine.count() == 1


def test_same_key_twice(spark, rows):
    data = [("a", "1995", "Q01", "1", None), ("a ", "1995", "Q01", "1", None), ("a", "1995", "Q01", "3", None)]
    assert [r[3] for r in rows(silver(spark, data).valid)] == [3.0]
    oldest_value_first = [-F.col("value").cast("int")]
    assert [r[3] for r in rows(silver(spark, data, newest_first=oldest_value_first).valid)] == [1.0]


def test_dedup_is_deterministic_and_groups_nulls(spark, rows):
    data = [(None, 1, "x"), (None, 2, "y"), ("k", 1, "b"), ("k", 1, "a"), ("k", None, "z")]
    df = spark.createDataFrame(data, "k STRING, t INT, v STRING").repartition(4)
    assert rows(dedup_latest(df, ["k"], [F.desc_nulls_last("t")])) == [("k", 1, "b"), (None, 2, "y")]


def test_dedup_on_all_columns(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k INT")
    assert dedup_latest(df, ["k"]).count() == 2


def test_snapshot_drops_keys_the_revision_removed(spark, rows):
    data = [("f", 1, "kept", 1), ("f", 1, "gone", 1), ("f", 2, "kept", 9), ("g", 1, "x", 5)]
    df = spark.createDataFrame(data, "file_name STRING, version INT, k STRING, v INT")
    assert rows(latest_snapshot(df), "file_name", "k", "v") == [("f", "kept", 9), ("g", "x", 5)]


def test_resolve_column(spark):
    df = spark.createDataFrame([(1, 2)], "`ID Year` INT, POPULATION INT")
    assert resolve_column(df, "Year", "ID Year") == "ID Year"
    assert resolve_column(df, "population") == "POPULATION"
    assert resolve_column(df, "Nation", required=False) is None
    with pytest.raises(ValueError, match="ID Year"):
        resolve_column(df, "Month")


def test_population_columns_by_any_name(spark, rows):
    df = spark.createDataFrame([("2013", "5", "US"), ("2014", "0", "US"), ("x", "1", "US"), ("2015", "-3", "US"), ("2016", None, "US")], "year STRING, Population STRING, `Nation ID` STRING")
    assert rows(silver_population(df).valid) == [(2013, 5, "US")]
    plain = spark.createDataFrame([(2013, 5)], "Year INT, Population BIGINT")
    assert silver_population(plain).valid.columns == ["year", "population"]


def test_population_key_is_a_parameter(spark):
    df = spark.createDataFrame([(2013, 5, "US"), (2013, 7, "CA")], "Year INT, Population BIGINT, Nation STRING")
    assert silver_population(df).valid.count() == 1
    assert silver_population(df, keys=("year", "nation")).valid.count() == 2


def test_sanitize(spark):
    df = spark.createDataFrame([(1,) * 4], "a INT, b INT, c INT, d INT").toDF("series_id   ", "a b", "x,;{}()\n\t=%-?y", "Plain")
    assert sanitize_names(df).columns == ["series_id", "a_b", "x____________y", "Plain"]
    with pytest.raises(ValueError, match="collide"):
        sanitize_names(df.toDF("a b", "a-b", "c", "d"))
