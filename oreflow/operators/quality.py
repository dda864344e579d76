"""Declarative data-quality rules.

A rule holds where its predicate is TRUE; NULL counts as a violation. All
rules of a dataset are judged in one pass, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ACTIONS = ("warn", "drop", "fail")


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"{self.action!r} is not one of {ACTIONS}")

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))

    @property
    def sql(self) -> str:
        """The rule as a WHERE predicate, for the SQL form of a query."""
        return f"coalesce(({self.predicate}), false)"


@dataclass(frozen=True)
class Checked:
    """A dataset with its rules. Each view of it is lazy."""

    df: DataFrame
    rules: tuple[Expectation, ...]

    def _with(self, action: str) -> list[Expectation]:
        return [rule for rule in self.rules if rule.action == action]

    @property
    def valid(self) -> DataFrame:
        """Rows that pass every drop rule."""
        kept = self.df
        for rule in self._with("drop"):
            kept = kept.filter(rule.holds)
        return kept

    @property
    def quarantine(self) -> DataFrame:
        """Rows that fail a drop rule, with the names of the rules they fail."""
        failed = failed_rules(self._with("drop"))
        return self.df.withColumn("failed_rules", failed).filter(F.size("failed_rules") > 0)

    @property
    def metrics(self) -> DataFrame:
        """One row per rule: rows seen, rows in violation."""
        return violations(self.df, self.rules)


def apply_expectations(df: DataFrame, rules: Iterable[Expectation]) -> Checked:
    return Checked(df, tuple(rules))


def failed_rules(rules: Iterable[Expectation]) -> Column:
    names = [F.when(~rule.holds, F.lit(rule.name)) for rule in rules]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def _per_rule(df: DataFrame, rules: list[Expectation], fields: list[str], keys: list[str]) -> DataFrame:
    """Turn the columns ``<field>_<i>`` of an aggregate into one row per rule."""
    rows = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.action).alias("action"),
            F.col("rows"),
            *[F.col(f"{field}_{i}").alias(field) for field in fields],
        )
        for i, rule in enumerate(rules)
    ]
    return df.select(*keys, F.inline(F.array(*rows)))


def violations(df: DataFrame, rules: Iterable[Expectation]) -> DataFrame:
    rules = list(rules)
    counts = [F.count_if(~rule.holds).alias(f"violations_{i}") for i, rule in enumerate(rules)]
    return _per_rule(df.agg(F.count(F.lit(1)).alias("rows"), *counts), rules, ["violations"], [])


def rule_counts(rules: Iterable[Expectation]) -> list[Column]:
    """Aggregates for ``observe``: all rows, kept rows, and each rule's violations.

    A drop rule is judged on every row, the others on the rows that the drop rules keep.
    """
    rules = list(rules)
    kept = F.lit(True)
    for rule in rules:
        kept = kept & rule.holds if rule.action == "drop" else kept
    found = [
        F.count_if(~rule.holds if rule.action == "drop" else kept & ~rule.holds).alias(f"violations_{i}")
        for i, rule in enumerate(rules)
    ]
    return [F.count(F.lit(1)).alias("rows"), F.count_if(kept).alias("kept"), *found]


def observed(seen: Observation, df: DataFrame, aggregates: list[Column]) -> dict:
    """What an observation of ``df`` has found; counted anew where the optimizer left nothing to observe.

    A filter that folds to false empties the plan, and the observation goes with it.
    """
    try:
        return seen.get
    except Py4JJavaError:
        return df.agg(*aggregates).first().asDict()


def counted_rules(spark: SparkSession, counts: dict[str, int], rules: Iterable[Expectation]) -> DataFrame:
    """What ``rule_counts`` observed as one row per rule."""
    rows = [
        (rule.name, rule.action, counts.get("rows" if rule.action == "drop" else "kept", 0), counts.get(f"violations_{i}", 0))
        for i, rule in enumerate(rules)
    ]
    return spark.createDataFrame(rows, "rule STRING, action STRING, rows BIGINT, violations BIGINT").coalesce(1)


def pass_rates(df: DataFrame, rules: Iterable[Expectation], by: dict[str, Column]) -> DataFrame:
    """Share of rows that pass each rule, per group (a day, a load, a source)."""
    rules = list(rules)
    passed = [F.count_if(rule.holds).alias(f"passed_{i}") for i, rule in enumerate(rules)]
    grouped = df.groupBy(*[column.alias(name) for name, column in by.items()])
    rows = _per_rule(grouped.agg(F.count(F.lit(1)).alias("rows"), *passed), rules, ["passed"], list(by))
    return rows.withColumn("pass_rate", F.col("passed") / F.col("rows"))


def assertions(df: DataFrame, checks: dict[str, str]) -> DataFrame:
    """Whole-table checks, each an aggregate predicate such as ``count(*) = 1``: one row per check."""
    measured = df.agg(*[F.coalesce(F.expr(sql), F.lit(False)).alias(f"c{i}") for i, sql in enumerate(checks.values())])
    rows = [
        F.struct(F.lit(name).alias("check_name"), F.lit(sql).alias("predicate"), F.col(f"c{i}").alias("passed"))
        for i, (name, sql) in enumerate(checks.items())
    ]
    return measured.select(F.inline(F.array(*rows)))


def key_repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once: a lookup with any would multiply the rows it labels."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def rule_catalog(spark: SparkSession, datasets: dict[str, Iterable[Expectation]]) -> DataFrame:
    """The rules themselves as a table."""
    rows = [(name, r.name, r.predicate, r.action) for name, rules in datasets.items() for r in rules]
    return spark.createDataFrame(rows, "dataset STRING, rule STRING, predicate STRING, action STRING")
