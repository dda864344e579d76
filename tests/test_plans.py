"""Shapes of physical plans that large inputs depend on."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from oreflow.operators import analytics, verify
from oreflow.operators.dedup import dedup_latest
from oreflow.operators.quality import apply_expectations
from oreflow.plans import questions_sql
from oreflow.sinks.publish import publish, read_published

ROOT = Path(__file__).resolve().parents[1]
SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")
OBS = "series_id STRING, year INT, period STRING, value DOUBLE, note STRING"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def obs(spark, tmp_path):
    spark.createDataFrame([("s", 1995, "Q01", 1.0, "x")], OBS).write.parquet(str(tmp_path / "obs"))
    return spark.read.parquet(str(tmp_path / "obs"))


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("s", "Label")], "series_id STRING, series_label STRING")


@pytest.mark.parametrize("form, partial", [
    (analytics.best_period, "partial_max"), (questions_sql.best_period_sql, "partial_max_by"),
    (analytics.best_period_ranked, "row_number(), 1, Partial"),
])
def test_best_period(obs, dim, form, partial):
    text = plan(form(obs, dim))
    # one row per series and task leaves for the shuffle, sums are partial, only needed columns are read
    assert partial in text and "partial_sum" in text
    assert re.search(r"PushedFilters: \[In\(period, \[Q01,Q02,Q03,Q04\]\)", text)
    assert "note" not in text.split("ReadSchema:")[1].split("\n")[0]
    # two shuffles of observations: by series and year, then by series
    assert text.count("Exchange hashpartitioning(series_id") <= 3


@pytest.mark.parametrize("form", [analytics.series_context, questions_sql.series_context_sql])
def test_series_filter_reaches_the_scan(spark, obs, form):
    context = spark.createDataFrame([(1995, 1)], "year INT, population BIGINT")
    text = plan(form(obs, context, "s", "Q01"))
    assert "EqualTo(series_id,s)" in text and "EqualTo(period,Q01)" in text


def test_dedup_limits_each_key_before_the_shuffle(obs):
    assert "row_number(), 1, Partial" in plan(dedup_latest(obs, ["series_id"]))


def test_all_rules_need_one_scan(obs):
    rules = analytics.SERIES_CONTEXT_RULES + [analytics.BEST_PERIOD_RULES[0]]
    assert plan(apply_expectations(obs, rules).metrics).count("FileScan") == 1


def test_difference_needs_one_pass_per_side(obs):
    text = plan(verify.diff_count(obs, obs.filter("year > 0")))
    assert text.count("FileScan") == 2 and "partial_sum" in text and "Join" not in text


def test_sums_are_partial(obs):
    text = plan(analytics.yearly_sums(obs))
    assert "partial_sum" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_partitioned_write_splits_skew(spark, obs):
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(obs.hint("rebalance", "series_id"))


def test_clustered_tables_skip_files(spark, tmp_path):
    df = spark.range(0, 40_000, 1, 4).selectExpr("cast(id % 100 AS string) AS series_id", "cast(id AS int) AS year")
    root = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        publish(apply_expectations(df, []), root, cluster_by=("series_id", "year"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    holders = read_published(spark, root).selectExpr("_metadata.file_name AS f", "series_id").distinct().groupBy("series_id").count()
    assert holders.agg({"count": "max"}).first()[0] <= 2


@needs_tables
@pytest.mark.parametrize("name", [n for n in entry.queries() if not n.startswith(("stream_", "bronze_", "sink_"))])
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|ArrowEval|MapInPandas", text)


def test_sources_force_no_broadcast_and_cut_no_lineage():
    for path in [*ROOT.glob("oreflow/**/*.py"), *ROOT.glob("catalogue/*.py")]:
        if "llm" in path.parts:  # sends models of a checked size
            continue
        text = path.read_text()
        assert not re.search(r"broadcast\(|localCheckpoint|toPandas|\.rdd\b|crossJoin|\budf\(", text), path
