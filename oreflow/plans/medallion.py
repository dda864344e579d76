"""The layered tables: rules, bronze scans, silver cleaning, gold questions, one full run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from oreflow import layouts
from oreflow.functions.names import resolve_column, resolve_values
from oreflow.functions.text import to_double, to_int, to_long, trimmed
from oreflow.operators import analytics, verify
from oreflow.operators.dedup import dedup_latest
from oreflow.operators.dimension import label_series
from oreflow.operators.quality import Checked, Expectation, apply_expectations, key_repeats
from oreflow.plans import questions_sql
from oreflow.sinks.landing import snapshot_of
from oreflow.sinks.publish import publish, published_version, read_published, rule_history
from oreflow.sinks.tables import describe_table
from oreflow.sources.delimited import require_headers, stream_delimited
from oreflow.sources.documents import pinned_records, stream_lines, stream_open_envelopes
from oreflow.sources.lineage import with_lineage
from oreflow.streaming.ingest import await_all, read_rule_counts, start_checked

# --- rules of each layer ---
BRONZE_OBSERVATION_RULES = [
    Expectation("has_series_id", "series_id IS NOT NULL", "drop"),
    Expectation("has_year", "year IS NOT NULL", "drop"),
    Expectation("has_period", "period IS NOT NULL", "drop"),
    Expectation("has_value", "value IS NOT NULL"),
]
BRONZE_SERIES_RULES = [Expectation("has_series_id", "series_id IS NOT NULL", "drop")]
BRONZE_POPULATION_RULES = [Expectation("has_data_row", "true")]
SILVER_OBSERVATION_RULES = [
    Expectation("valid_series_id", "series_id IS NOT NULL AND series_id != ''", "drop"),
    Expectation(
        "valid_year", f"year IS NOT NULL AND year BETWEEN {layouts.FIRST_YEAR} AND {layouts.LAST_YEAR}", "drop"
    ),
    Expectation("valid_period", f"period RLIKE '{layouts.PERIOD_PATTERN}'", "drop"),
    Expectation("has_value", "value IS NOT NULL"),
    Expectation("value_is_a_number", "value IS NULL OR NOT isnan(value)"),
]
SILVER_SERIES_RULES = [Expectation("valid_series_id", "series_id IS NOT NULL AND series_id != ''", "drop")]
SILVER_POPULATION_RULES = [
    Expectation("valid_year", "year IS NOT NULL", "drop"),
    Expectation("valid_population", "population IS NOT NULL AND population > 0", "drop"),
]
AGREEMENT_RULE = Expectation("sql_and_dataframe_agree", "diff_row_count = 0", "fail")


# --- silver ---
def silver_observations(bronze: DataFrame, newest_first: list | None = None) -> Checked:
    """Trimmed, typed, one row per series, year and period, then judged.

    A row's value is not part of the key, so of several versions the one that
    comes first in ``newest_first`` is kept. That order may use any column of
    the bronze table.
    """
    typed = bronze.select(
        trimmed("series_id"),
        to_int("year").alias("year"),
        trimmed("period"),
        to_double("value").alias("value"),
        trimmed("footnote_codes"),
        *[order.alias(f"_order_{i}") for i, order in enumerate(newest_first or [])],
    )
    order = [F.col(c).desc_nulls_last() for c in typed.columns if c.startswith("_order_")]
    once = dedup_latest(typed, ["series_id", "year", "period"], order)
    return apply_expectations(once.drop(*[f"_order_{i}" for i in range(len(order))]), SILVER_OBSERVATION_RULES)


def silver_series(bronze_series: DataFrame, lookups: dict[str, DataFrame]) -> Checked:
    return apply_expectations(label_series(bronze_series, lookups), SILVER_SERIES_RULES)


def silver_population(bronze: DataFrame, keys: tuple[str, ...] = ("year",)) -> Checked:
    """Year, population and, where the source has it, nation, whatever the case of the names."""
    names = layouts.POPULATION_FIELDS
    columns = [
        to_int(resolve_values(bronze, *names["Year"])).alias("year"),
        to_long(resolve_values(bronze, *names["Population"])).alias("population"),
    ]
    if resolve_column(bronze, *names["Nation"], required=False):
        columns.append(resolve_values(bronze, *names["Nation"]).alias("nation"))
    once = dedup_latest(bronze.select(*columns), list(keys))
    return apply_expectations(once, SILVER_POPULATION_RULES)


# --- gold ---
@dataclass(frozen=True)
class Question:
    """One question in both forms, with the one list of rules for its answer."""

    name: str
    sql: DataFrame
    dataframe: DataFrame
    rules: list[Expectation]
    table_rules: dict[str, str]  # aggregate predicates over the whole answer
    tolerance: float | None = 1e-9  # of floating columns: sums and means depend on partition order in their last bits

    @property
    def difference(self) -> DataFrame:
        return verify.diff_count(self.sql, self.dataframe, self.tolerance)


def questions(
    observations: DataFrame, series: DataFrame, population: DataFrame,
    start: int = layouts.STATS_START, end: int = layouts.STATS_END,
    series_id: str = layouts.CONTEXT_SERIES, period: str = layouts.CONTEXT_PERIOD,
) -> list[Question]:
    stats_rules = [analytics.completeness(end - start + 1), *analytics.RANGE_STATS_RULES]
    return [
        Question(
            "gold_population_stats",
            questions_sql.range_stats_sql(population, start, end),
            analytics.range_stats(population, start, end),
            stats_rules,
            {"one_row": "count(*) = 1"},
        ),
        Question(
            "gold_bls_best_year_per_series",
            questions_sql.best_period_sql(observations, series),
            analytics.best_period(observations, series),
            analytics.BEST_PERIOD_RULES,
            {
                "one_row_per_series": "count(*) = count(DISTINCT series_id)",
                "series_and_year_known": "count_if(series_id IS NULL OR best_year IS NULL) = 0",
            },
        ),
        Question(
            f"gold_{series_id.lower()}_{period.lower()}_population",
            questions_sql.series_context_sql(observations, population, series_id, period),
            analytics.series_context(observations, population, series_id, period),
            analytics.SERIES_CONTEXT_RULES,
            {
                "one_row_per_year": "count(*) = count(DISTINCT year)",
                "year_and_value_known": "count_if(year IS NULL OR value IS NULL) = 0",
            },
        ),
    ]


# --- one full run over a landing folder ---
VERSION = "_version"


def versioned_lineage(scan: DataFrame) -> DataFrame:
    """Lineage columns and the version in the name of the landed file."""
    lined = with_lineage(scan, source_file=True)
    return lined.withColumn(VERSION, snapshot_of(F.col("_source_file"))["version"])


class Warehouse:
    """Tables below one shared root: ``<root>/<layer>/<table>``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def bronze(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path("bronze", table)).drop("batch")

    def bronze_counts(self, table: str) -> DataFrame:
        """What each rule of a bronze table has found in all batches so far."""
        return read_rule_counts(self.spark, self.path("_metrics", table))

    def read(self, layer: str, table: str) -> DataFrame:
        return read_published(self.spark, self.path(layer, table))

    def append(self, table: str, checked: Checked) -> StreamingQuery:
        places = (self.path(layer, table) for layer in ("bronze", "_metrics", "_checkpoints"))
        return start_checked(checked, *places, (VERSION,))

    def publish(
        self, layer: str, table: str, checked: Checked, cluster_by: tuple[str, ...] = (), table_rules: dict[str, str] | None = None
    ) -> DataFrame:
        publish(checked, self.path(layer, table), cluster_by, table_rules)
        return self.read(layer, table)

    def history(self, layer: str, table: str) -> DataFrame:
        """What each rule found in each version of a published table."""
        return rule_history(self.spark, self.path(layer, table))

    def describe(self, layer: str, table: str, name: str | None = None) -> DataFrame:
        """Enter the newest version in the catalog, with the comments of ``layouts``."""
        if layer == "bronze":
            path = self.path(layer, table)
        else:
            root = self.path(layer, table)
            path = f"{root}/data/version={published_version(self.spark, root)}"
        columns = set(self.spark.read.parquet(path).columns)
        comments = {c: text for c, text in layouts.COLUMN_COMMENTS.items() if c in columns}
        return describe_table(self.spark, name or table, path, layouts.TABLE_COMMENTS.get(table, ""), comments)


def run_bronze(house: Warehouse, landing: str, population_landing: str) -> None:
    """Append what is new in the landing folders, all tables at the same time.

    Files carry their version in the name.
    """
    spark = house.spark

    def versioned(folder: str, name: str) -> str:
        return f"{folder}/{name}__*"

    def delimited(name: str, columns: list[str] | None = None) -> DataFrame:
        # columns go by place in a stream: the header of every file must say the same names
        columns = require_headers(spark, versioned(landing, name), columns)
        return versioned_lineage(stream_delimited(spark, versioned(landing, name), layouts.text_schema(columns)))

    # records keep the fields they have: names and types are settled afterwards, record by record
    envelopes = stream_open_envelopes(spark, versioned(population_landing, layouts.POPULATION_FILE))
    lineage = ["_ingested_at", "_source_file", VERSION]
    records = versioned_lineage(envelopes).select(F.explode("data").alias("record"), *lineage)
    records = pinned_records(records, layouts.POPULATION_FIELDS)
    tables = {
        "bronze_bls_data": (delimited(layouts.CURRENT_FILE, layouts.OBSERVATION_COLUMNS), BRONZE_OBSERVATION_RULES),
        "bronze_bls_data_alldata": (delimited(layouts.ALL_DATA_FILE, layouts.OBSERVATION_COLUMNS), []),
        "bronze_bls_series": (delimited(layouts.SERIES_FILE, layouts.SERIES_COLUMNS), BRONZE_SERIES_RULES),
        "bronze_bls_pr_txt": (versioned_lineage(stream_lines(spark, versioned(landing, layouts.NOTES_FILE))), []),
        "bronze_population": (records, BRONZE_POPULATION_RULES),
        **{"bronze_bls_" + name.replace(".", "_"): (delimited(name), []) for name in layouts.LOOKUP_FILES},
    }
    await_all([house.append(name, apply_expectations(scan, rules)) for name, (scan, rules) in tables.items()])


def current_snapshot(bronze: DataFrame) -> DataFrame:
    """Rows of the newest version of a table that holds one logical file.

    The table is partitioned by version, so older ones are not opened.
    """
    newest = bronze.agg(F.max(VERSION)).scalar()
    return bronze.filter(F.col(VERSION) == newest).drop(VERSION)


def require_unique(df: DataFrame, keys: list[str], what: str) -> None:
    """Stop where a key repeats: joined to it, rows would multiply."""
    repeated = key_repeats(df, keys).limit(3).collect()
    if repeated:
        raise ValueError(f"{what} repeats the keys {[tuple(row[k] for k in keys) for row in repeated]}")


def run_silver(
    house: Warehouse, bronze: Callable[[str], DataFrame] | None = None, keep_rejected: bool = False
) -> None:
    """Silver from the newest files of bronze, or from the tables that ``bronze`` names.

    ``keep_rejected`` also publishes the rows that the rules drop, with the rules they fail.
    """
    current = bronze or (lambda table: current_snapshot(house.bronze(table)))
    lookups = {f"{kind}_code": current(f"bronze_bls_pr_{kind}") for kind in ("sector", "measure", "duration", "class")}
    for code, lookup in lookups.items():
        require_unique(lookup.select(trimmed(code)), [code], f"the lookup of {code}")
    # one series is asked for by id, and all are summed by series and year: keep them together
    observations = silver_observations(current("bronze_bls_data"), [F.col("_ingested_at")])
    house.publish("silver", "silver_bls_data", observations, cluster_by=("series_id", "year", "period"))
    if keep_rejected:
        house.publish("silver", "silver_bls_data_rejected", apply_expectations(observations.quarantine, []))
    series = house.publish("silver", "silver_bls_series", silver_series(current("bronze_bls_series"), lookups))
    population = house.publish("silver", "silver_population", silver_population(current("bronze_population")))
    # a repeat on either side of the joins to come would multiply answers
    require_unique(series, ["series_id"], "the series")
    require_unique(population, ["year"], "the population")


def run_gold(house: Warehouse, **asked) -> None:
    """Both forms of each question, then their comparison; any broken fail rule stops the run."""
    silver = [house.read("silver", t) for t in ("silver_bls_data", "silver_bls_series", "silver_population")]
    for number, question in enumerate(questions(*silver, **asked), 1):
        primary, twin = (
            house.publish("gold", name, apply_expectations(form, question.rules), table_rules=question.table_rules)
            for name, form in ((question.name, question.sql), (f"{question.name}_pyspark_alt", question.dataframe))
        )
        difference = verify.diff_count(primary, twin, question.tolerance)
        house.publish("gold", f"gold_verification_q{number}", apply_expectations(difference, [AGREEMENT_RULE]))


def run_all(house: Warehouse, landing: str, population_landing: str, **asked) -> None:
    run_bronze(house, landing, population_landing)
    run_silver(house)
    run_gold(house, **asked)
