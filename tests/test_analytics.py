import math

import pytest

from oreflow.operators import analytics, verify
from oreflow.plans import questions_sql, reports

OBS = "series_id STRING, year INT, period STRING, value DOUBLE"
BEST = [analytics.best_period, questions_sql.best_period_sql, analytics.best_period_ranked]
STATS = [analytics.range_stats, questions_sql.range_stats_sql]
CONTEXT = [analytics.series_context, questions_sql.series_context_sql]


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("s", "Label"), ("unused", "Nobody")], "series_id STRING, series_label STRING")


def best(spark, form, dim, data):
    out = form(spark.createDataFrame(data, OBS), dim)
    return sorted(tuple(r) for r in out.collect())


def quarters(series, year, *values):
    return [(series, year, f"Q0{i}", v) for i, v in enumerate(values, 1)]


@pytest.mark.parametrize("form", BEST)
class TestBestPeriod:
    def test_golden_example(self, spark, form, dim):
        data = quarters("s", 1995, 1.0, 2.0) + quarters("s", 1996, 3.0, 4.0)
        assert best(spark, form, dim, data) == [("s", "Label", 1996, 7.0)]

    def test_yearly_average_does_not_count(self, spark, form, dim):
        data = quarters("s", 1995, 3.0, 4.0) + quarters("s", 1996, 1.0, 1.0) + [("s", 1996, "Q05", 100.0), ("s", 1996, "M13", 100.0)]
        assert best(spark, form, dim, data) == [("s", "Label", 1995, 7.0)]

    def test_tie_goes_to_the_earliest_year(self, spark, form, dim):
        data = quarters("s", 1997, 2.0) + quarters("s", 1996, 1.0, 1.0) + quarters("s", 1998, 2.0)
        assert best(spark, form, dim, data) == [("s", "Label", 1996, 2.0)]

    def test_all_null_keeps_the_earliest_year(self, spark, form, dim):
        data = quarters("s", 1997, None) + quarters("s", 1996, None, None)
        assert best(spark, form, dim, data) == [("s", "Label", 1996, None)]

    def test_null_loses_to_negative_and_nulls_are_skipped(self, spark, form, dim):
        data = quarters("s", 1995, None) + quarters("s", 1996, -5.0, None) + quarters("s", 1997, -6.0)
        assert best(spark, form, dim, data) == [("s", "Label", 1996, -5.0)]

    def test_unlabelled_series_stays(self, spark, form, dim):
        assert best(spark, form, dim, quarters("new", 1995, 1.0)) == [("new", "Unknown series: new", 1995, 1.0)]

    def test_incomplete_year_competes(self, spark, form, dim):
        data = quarters("s", 1995, 1.0, 1.0, 1.0, 1.0) + quarters("s", 1996, 9.0)
        assert best(spark, form, dim, data) == [("s", "Label", 1996, 9.0)]

    def test_rows_without_key_are_dropped(self, spark, form, dim):
        data = quarters(None, 1995, 1.0) + quarters("s", None, 1.0)
        assert best(spark, form, dim, data) == []

    @pytest.mark.parametrize("small, large", [(1e-7, 3e-7), (1e-300, 2e-300), (1e22, 1e23), (1e300, 1.5e300), (0.1, 1e17), (-1e22, -1.0)])
    def test_any_magnitude(self, spark, form, dim, small, large):
        data = quarters("s", 1995, small, None) + quarters("s", 1996, large)
        assert best(spark, form, dim, data) == [("s", "Label", 1996, large)]

    def test_nan_and_infinity_add_up_as_doubles_do(self, spark, form, dim):
        data = quarters("s", 1995, 1.0, float("inf")) + quarters("s", 1996, 1e300)
        assert best(spark, form, dim, data) == [("s", "Label", 1995, float("inf"))]
        found = best(spark, form, dim, quarters("s", 1995, 1.0, float("nan")))
        assert math.isnan(found[0][3])


@pytest.mark.parametrize("form", STATS)
class TestRangeStats:
    def one(self, spark, form, data, start=2013, end=2018):
        return form(spark.createDataFrame(data, "year INT, population BIGINT"), start, end).first().asDict()

    def test_bounds_are_inclusive(self, spark, form):
        got = self.one(spark, form, [(y, v) for y, v in zip(range(2012, 2020), [999, 1, 2, 3, 4, 5, 6, 999])])
        assert (got["start_year"], got["end_year"], got["years_included"], got["mean_population"]) == (2013, 2018, 6, 3.5)
        assert math.isclose(got["stddev_samp_population"], math.sqrt(3.5))
        assert math.isclose(got["stddev_pop_population"], math.sqrt(17.5 / 6))

    def test_empty_range_has_one_row(self, spark, form):
        got = self.one(spark, form, [(1990, 1)])
        assert got["years_included"] == 0 and got["mean_population"] is None and got["stddev_pop_population"] is None

    def test_single_row(self, spark, form):
        got = self.one(spark, form, [(2013, 7)])
        assert got["stddev_samp_population"] is None and got["stddev_pop_population"] == 0.0


@pytest.mark.parametrize("form", CONTEXT)
class TestSeriesContext:
    def test_every_year_stays(self, spark, form):
        obs = spark.createDataFrame(
            [("s", 1996, "Q01", 2.0), ("s", 1995, "Q01", 1.0), ("s", 1995, "Q02", 9.0), ("t", 1995, "Q01", 9.0), ("s", 1997, "Q01", None)], OBS
        )
        context = spark.createDataFrame([(1996, 50), (1990, 1)], "year INT, population BIGINT")
        assert [tuple(r) for r in form(obs, context, "s", "Q01").orderBy("year").collect()] == [(1995, 1.0, None), (1996, 2.0, 50)]


def test_forms_agree_and_a_seeded_fault_shows(spark, dim):
    obs = spark.createDataFrame(quarters("s", 1995, 1.0) + quarters("t", 1995, 1.0), OBS)
    sql, twin = questions_sql.best_period_sql(obs, dim), analytics.best_period(obs, dim)
    assert verify.diff_count(sql, twin).first()[0] == 0
    assert verify.diff_count(sql, twin.filter("series_id = 's'")).first()[0] == 1


def test_reports(spark, dim):
    obs = spark.createDataFrame(quarters("s", 1995, 1.0) + quarters("t", 1995, 5.0) + quarters("u", 1995, None), OBS)
    best_rows = analytics.best_period(obs, dim.withColumn("series_label", dim.series_label).unionByName(
        spark.createDataFrame([("t", "Label")], dim.schema)))
    assert [r.series_id for r in reports.best_by_value(best_rows).collect()] == ["t", "s", "u"]
    totals = {r.series_label: r.best_year_summed_value for r in reports.best_by_label(best_rows).collect()}
    assert totals == {"Label": 6.0, "Unknown series: u": None}
    stats = analytics.range_stats(spark.createDataFrame([(2013, 1), (2014, 3)], "year INT, population BIGINT"), 2013, 2014)
    assert tuple(reports.stats(stats, 2013, 2014).first()) == (2.0, 1.0)
    assert reports.stats(stats, 2013, 2015).count() == 0
