from threading import Thread

import pytest
from pyspark.sql import functions as F

from oreflow.operators.quality import Expectation, apply_expectations, assertions, key_repeats, pass_rates
from oreflow.sinks.publish import ExpectationFailed, VersionClaimed, claimed, publish, published_version, read_published, rule_history

RULES = [
    Expectation("has_key", "k IS NOT NULL AND k != ''", "drop"),
    Expectation("in_range", "v BETWEEN 1 AND 10", "drop"),
    Expectation("small", "v < 5"),
    Expectation("placeholder", "true"),
]
DATA = [("a", 1), ("", 2), (None, 3), ("b", None), ("c", 11), (None, 99), ("d", 7)]


@pytest.fixture
def checked(spark):
    return apply_expectations(spark.createDataFrame(DATA, "k STRING, v INT"), RULES)


def test_drop_treats_null_as_violation(checked, rows):
    assert rows(checked.valid) == [("a", 1), ("d", 7)]


def test_quarantine_names_the_rules(checked, rows):
    got = rows(checked.quarantine)
    assert (None, 99, ["has_key", "in_range"]) in got and ("b", None, ["in_range"]) in got
    assert len(got) + checked.valid.count() == len(DATA)


def test_metrics_count_every_rule(checked, rows):
    assert rows(checked.metrics) == [
        ("has_key", "drop", 7, 3), ("in_range", "drop", 7, 3), ("placeholder", "warn", 7, 0), ("small", "warn", 7, 4),
    ]


def test_metrics_of_an_empty_table(spark, rows):
    empty = spark.createDataFrame([], "k STRING, v INT")
    assert {r[2:] for r in rows(apply_expectations(empty, RULES).metrics)} == {(0, 0)}


def test_without_drop_rules_nothing_is_quarantined(spark):
    df = spark.createDataFrame(DATA, "k STRING, v INT")
    only_warn = apply_expectations(df, RULES[2:])
    assert only_warn.quarantine.count() == 0 and only_warn.valid.count() == len(DATA)


def test_unknown_action_is_refused():
    with pytest.raises(ValueError):
        Expectation("x", "true", "ignore")


def test_pass_rate_per_group(spark, rows):
    df = spark.createDataFrame([("d1", 1), ("d1", 20), ("d2", None)], "d STRING, v INT")
    got = rows(pass_rates(df, [Expectation("small", "v < 5")], {"day": F.col("d")}), "day", "rule", "rows", "passed", "pass_rate")
    assert got == [("d1", "small", 2, 1, 0.5), ("d2", "small", 1, 0, 0.0)]


def test_assertions_report_each_check(spark, rows):
    df = spark.createDataFrame([(1,), (None,)], "k INT")
    got = rows(assertions(df, {"one": "count(*) = 1", "two": "count(*) = 2", "nulls": "max(k) > NULL"}), "check_name", "passed")
    assert got == [("nulls", False), ("one", False), ("two", True)]


def test_key_repeats(spark, rows):
    df = spark.createDataFrame([("01",), ("1",), ("01",)], "code STRING")
    assert rows(key_repeats(df, ["code"])) == [("01", 2)]


def test_failed_rule_publishes_nothing(spark, rows, tmp_path):
    root = str(tmp_path / "t")
    good = spark.createDataFrame([(6,)], "years INT")
    rule = [Expectation("complete", "years = 6", "fail")]
    publish(apply_expectations(good, rule), root)
    with pytest.raises(ExpectationFailed, match="complete: 1 of 1"):
        publish(apply_expectations(spark.createDataFrame([(5,)], "years INT"), rule), root)
    with pytest.raises(ExpectationFailed):
        publish(apply_expectations(spark.createDataFrame([(None,)], "years INT"), rule), root)
    assert rows(read_published(spark, root)) == [(6,)] and published_version(spark, root) == 1
    # the failed attempts shared the number of the version that never came to be
    assert rows(rule_history(spark, root), "version", "rule", "violations", "pass_rate") == [
        (1, "complete", 0, 1.0), (2, "complete", 1, 0.0),
    ]


def test_a_table_can_be_rebuilt_from_itself(spark, rows, tmp_path):
    root = str(tmp_path / "t")
    publish(apply_expectations(spark.createDataFrame([(1,)], "v INT"), []), root)
    publish(apply_expectations(read_published(spark, root).select((F.col("v") + 1).alias("v")), []), root)
    assert rows(read_published(spark, root)) == [(2,)] and published_version(spark, root) == 2


def test_reading_an_unpublished_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("cluster_by", [(), ("v",)])
def test_dropped_rows_are_counted_in_each_version(checked, spark, rows, tmp_path, cluster_by):
    root = str(tmp_path / "t")
    for _ in range(2):
        publish(checked, root, cluster_by)
    found = [("has_key", "drop", 7, 3), ("in_range", "drop", 7, 3), ("placeholder", "warn", 2, 0), ("small", "warn", 2, 1)]
    got = rows(rule_history(spark, root), "version", "rule", "action", "rows", "violations")
    assert got == [(version, *row) for version in (1, 2) for row in found]
    assert rows(read_published(spark, root)) == [("a", 1), ("d", 7)]


def test_a_broken_table_rule_publishes_nothing(spark, rows, tmp_path):
    root = str(tmp_path / "t")
    once = {"keys_once": "count(*) = count(DISTINCT k)", "has_rows": "count(*) > 0"}
    publish(apply_expectations(spark.createDataFrame([(1,), (2,)], "k INT"), []), root, table_rules=once)
    for data, fault in (([(1,), (1,)], "keys_once"), ([], "has_rows")):
        with pytest.raises(ExpectationFailed, match=fault):
            publish(apply_expectations(spark.createDataFrame(data, "k INT"), []), root, table_rules=once)
    assert rows(read_published(spark, root)) == [(1,), (2,)]
    assert ("has_rows", "table", 1, 1) in rows(rule_history(spark, root), "rule", "action", "rows", "violations")


def test_of_two_writers_one_is_refused(spark, rows, tmp_path):
    root = str(tmp_path / "t")
    one, two = (apply_expectations(spark.createDataFrame([(v,)], "v INT"), []) for v in (1, 2))
    with claimed(spark, root, 1):
        with pytest.raises(VersionClaimed, match="version 1"):
            publish(two, root)
        with claimed(spark, root, 1, hours=0):  # left by a writer that died
            pass
    assert published_version(spark, root) is None
    assert publish(one, root) == 1 and publish(two, root) == 2 and rows(read_published(spark, root)) == [(2,)]


def test_writers_at_the_same_time(spark, rows, tmp_path):
    root = str(tmp_path / "t")
    results = []

    def write(value):
        try:
            results.append(("done", publish(apply_expectations(spark.createDataFrame([(value,)] * 50, "v INT"), []), root), value))
        except VersionClaimed:
            results.append(("refused", None, value))

    writers = [Thread(target=write, args=(value,)) for value in range(4)]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    done = sorted((version, value) for state, version, value in results if state == "done")
    assert done and [version for version, _ in done] == list(range(1, len(done) + 1))
    assert rows(read_published(spark, root)) == [(done[-1][1],)] * 50
