"""The three questions in all forms, their verification, and the reports on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import (
    LABELS_SQL, OBSERVATIONS_SQL, PERIOD, PRIORITY_SQL, SERIES, SHIPPED_SQL, TOTALS_SQL, Catalogue,
    customer_labels, observations, priority_observations, shipped_lines, table, yearly_totals,
)
from oreflow.layouts import QUARTERS
from oreflow.operators import analytics, verify
from oreflow.operators.quality import apply_expectations
from oreflow.plans import questions_sql, reports
from oreflow.plans.medallion import silver_observations
from oreflow.sinks.publish import publish, read_published
from oreflow.session import work_dir

CATALOGUE = Catalogue()
register = CATALOGUE.register

START, END = 1995, 2000
TOLERANCE = 1e-9
YEARS = END - START + 1


# --- best period per series ---
def sums_sql(name: str, periods: list[str]) -> str:
    listed = ", ".join(f"'{p}'" for p in periods)
    return f"""{name}_sums AS (
    SELECT series_id, year, sum(value) AS summed_value
    FROM obs WHERE period IN ({listed}) GROUP BY 1, 2
)"""


def best_sql(name: str, periods: list[str]) -> str:
    return f"""{sums_sql(name, periods)},
{name} AS (
    SELECT s.series_id, coalesce(d.series_label, 'Unknown series: ' || s.series_id) AS series_label,
           s.year AS best_year, round(s.summed_value, 2) AS best_year_summed_value
    FROM (SELECT *, row_number() OVER (
              PARTITION BY series_id ORDER BY summed_value DESC NULLS LAST, year) AS place FROM {name}_sums) s
    LEFT JOIN dim d ON d.series_id = s.series_id WHERE s.place = 1
)"""


WITH_BEST = f"WITH {OBSERVATIONS_SQL}, {LABELS_SQL}, {best_sql('best', QUARTERS)}"
BEST = f"{WITH_BEST} SELECT * FROM best"


def rounded(df):
    """Doubles to the cent: sums and means depend on partition order in their last bits."""
    return df.select(*[F.round(c, 2).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def _best(spark, sf_dir, form, periods=QUARTERS):
    return form(observations(spark, sf_dir), customer_labels(spark, sf_dir), periods)


@register("best_period_df", BEST)
def best_period_df(spark, sf_dir):
    return rounded(_best(spark, sf_dir, analytics.best_period_ranked))


@register("best_period_sql", BEST)
def best_period_sql(spark, sf_dir):
    return rounded(_best(spark, sf_dir, questions_sql.best_period_sql))


@register("best_period_maxstruct", BEST)
def best_period_maxstruct(spark, sf_dir):
    return rounded(_best(spark, sf_dir, analytics.best_period))


YEARLY = f"WITH {OBSERVATIONS_SQL}, {sums_sql('all', QUARTERS)} SELECT series_id, year, round(summed_value, 2) AS summed_value FROM all_sums"


@register("yearly_sums", YEARLY)
def yearly_sums(spark, sf_dir):
    return rounded(analytics.yearly_sums(observations(spark, sf_dir)))


# --- statistics over a range of years ---
STATS = f"""WITH {TOTALS_SQL}
SELECT CAST({START} AS INTEGER) AS start_year, CAST({END} AS INTEGER) AS end_year, count(*) AS years_included,
       round(avg(population), 2) AS mean_population,
       round(stddev_samp(population), 2) AS stddev_samp_population,
       round(stddev_pop(population), 2) AS stddev_pop_population
FROM totals WHERE year BETWEEN {START} AND {END}"""


@register("range_stats_df", STATS)
def range_stats_df(spark, sf_dir):
    return rounded(analytics.range_stats(yearly_totals(spark, sf_dir), START, END))


@register("range_stats_sql", STATS)
def range_stats_sql(spark, sf_dir):
    return rounded(questions_sql.range_stats_sql(yearly_totals(spark, sf_dir), START, END))


@register("range_stats_complete", STATS)
def range_stats_complete(spark, sf_dir):
    """Published only if every year of the range is there."""
    answer = questions_sql.range_stats_sql(yearly_totals(spark, sf_dir), START, END)
    root = work_dir(spark, "range-stats")
    publish(apply_expectations(answer, [analytics.completeness(YEARS), *analytics.RANGE_STATS_RULES]), root)
    return rounded(read_published(spark, root))


# --- one series with context ---
CONTEXT = f"""WITH {PRIORITY_SQL}, {SHIPPED_SQL}
SELECT o.year, o.value, c.population FROM obs o LEFT JOIN context c ON c.year = o.year
WHERE o.series_id = '{SERIES}' AND o.period = '{PERIOD}'"""


def _context(spark, sf_dir, form):
    return form(priority_observations(spark, sf_dir), shipped_lines(spark, sf_dir), SERIES, PERIOD)


@register("series_context_df", CONTEXT)
def series_context_df(spark, sf_dir):
    return _context(spark, sf_dir, analytics.series_context)


@register("series_context_sql", CONTEXT)
def series_context_sql(spark, sf_dir):
    return _context(spark, sf_dir, questions_sql.series_context_sql)


# --- verification ---
def difference_sql(left: str, right: str) -> str:
    return f"""SELECT CAST((SELECT count(*) FROM ({left} EXCEPT ALL {right}))
       + (SELECT count(*) FROM ({right} EXCEPT ALL {left})) AS BIGINT) AS diff_row_count"""


def close_sql(*pairs: tuple[str, str]) -> str:
    return " AND ".join(f"(({a} IS NULL AND {b} IS NULL) OR abs({a} - {b}) <= {TOLERANCE} * greatest(abs({a}), abs({b})))" for a, b in pairs)


# each question in two forms, compared row by row: the built-in statistics and their definitions
STATS_FORMS = f"""WITH {TOTALS_SQL}, wanted AS (SELECT population FROM totals WHERE year BETWEEN {START} AND {END}),
center AS (SELECT CAST(sum(population) AS DOUBLE) / count(*) AS mu, count(*) AS n FROM wanted),
a AS (SELECT count(*) AS n, avg(population) AS m, stddev_samp(population) AS s, stddev_pop(population) AS p FROM wanted),
b AS (SELECT max(n) AS n, max(mu) AS m, sqrt(sum((population - mu) * (population - mu)) / (max(n) - 1)) AS s,
             sqrt(sum((population - mu) * (population - mu)) / max(n)) AS p FROM wanted, center)
SELECT CAST(2 * count(*) FILTER (WHERE NOT (a.n = b.n AND {close_sql(("a.m", "b.m"), ("a.s", "b.s"), ("a.p", "b.p"))})) AS BIGINT)
       AS diff_row_count FROM a, b"""
# the first place of a ranking, and the earliest of the years that reach the largest sum
BEST_FORMS = f"""{WITH_BEST}, largest AS (SELECT series_id, max(summed_value) AS top FROM best_sums GROUP BY 1),
other AS (
    SELECT s.series_id, coalesce(min(d.series_label), 'Unknown series: ' || s.series_id) AS series_label, min(s.year) AS best_year,
           round(min(l.top), 2) AS best_year_summed_value
    FROM best_sums s JOIN largest l ON l.series_id = s.series_id AND s.summed_value IS NOT DISTINCT FROM l.top
    LEFT JOIN dim d ON d.series_id = s.series_id GROUP BY s.series_id
)
SELECT CAST(coalesce(sum(CASE WHEN a.series_id IS NULL OR b.series_id IS NULL THEN 1
            WHEN a.series_label = b.series_label AND a.best_year = b.best_year
                 AND {close_sql(("a.best_year_summed_value", "b.best_year_summed_value"))} THEN 0 ELSE 2 END), 0) AS BIGINT) AS diff_row_count
FROM best a FULL OUTER JOIN other b ON a.series_id = b.series_id"""
# a join, and a lookup per row
CONTEXT_LOOKUP = f"""WITH {PRIORITY_SQL}, {SHIPPED_SQL}
SELECT o.year, o.value, (SELECT c.population FROM context c WHERE c.year = o.year) AS population
FROM obs o WHERE o.series_id = '{SERIES}' AND o.period = '{PERIOD}'"""


@register("verify_q1", STATS_FORMS)
def verify_q1(spark, sf_dir):
    totals = yearly_totals(spark, sf_dir)
    return verify.diff_count(
        questions_sql.range_stats_sql(totals, START, END), analytics.range_stats(totals, START, END), TOLERANCE
    )


@register("verify_q2", BEST_FORMS)
def verify_q2(spark, sf_dir):
    forms = (questions_sql.best_period_sql, analytics.best_period)
    return verify.diff_count(*[_best(spark, sf_dir, form) for form in forms], TOLERANCE)


@register("verify_q3", difference_sql(f"({CONTEXT})", f"({CONTEXT_LOOKUP})"))
def verify_q3(spark, sf_dir):
    return verify.diff_count(series_context_sql(spark, sf_dir), series_context_df(spark, sf_dir))


WITH_AVERAGE = [*QUARTERS, "Q05"]


@register(
    "verify_mismatch",
    f"{WITH_BEST}, {best_sql('wrong', WITH_AVERAGE)} " + difference_sql("SELECT * FROM best", "SELECT * FROM wrong"),
)
def verify_mismatch(spark, sf_dir):
    """The comparison must see what counting the yearly average as a fifth quarter does."""
    wrong = _best(spark, sf_dir, analytics.best_period, WITH_AVERAGE)
    return verify.diff_count(best_period_df(spark, sf_dir), rounded(wrong))


@register("verify_tolerance", f"SELECT CAST(2 * count(*) AS BIGINT) AS diff_row_count FROM ({YEARLY}) WHERE year = 1997")
def verify_tolerance(spark, sf_dir):
    """Many values under one key: half of them differ in the last bits, those of a year by half a cent."""
    sums = analytics.yearly_sums(observations(spark, sf_dir))
    even = F.col("series_id").cast("long") % 2 == 0
    shifted = F.when(F.col("year") == 1997, F.col("summed_value") + 0.005).when(even, F.col("summed_value") * (1 + 1e-14))
    other = sums.select("year", F.coalesce(shifted, "summed_value").alias("summed_value"))
    return verify.diff_count(sums.select("year", "summed_value"), other, 1e-10)


@register(
    "verify_except_all",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_quantity FROM lineitem
       EXCEPT ALL
       SELECT CAST(year(l_shipdate) AS INTEGER), l_quantity FROM lineitem WHERE l_returnflag = 'R'""",
)
def verify_except_all(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"), "l_quantity", "l_returnflag")
    returned = lines.filter("l_returnflag = 'R'")
    return verify.except_all(lines.drop("l_returnflag"), returned.drop("l_returnflag"))


# --- reports ---
@register(
    "report_trend",
    f"SELECT year, value AS productivity_value, population FROM ({CONTEXT})",
)
def report_trend(spark, sf_dir):
    return reports.trend(series_context_sql(spark, sf_dir))


@register(
    "report_series_range",
    f"SELECT year, value AS productivity_value, population FROM ({CONTEXT}) WHERE year BETWEEN 1997 AND 2000",
)
def report_series_range(spark, sf_dir):
    return reports.series_range(series_context_sql(spark, sf_dir), 1997, 2000)


@register(
    "report_stats",
    f"""SELECT mean_population, stddev_pop_population AS stddev_population FROM ({STATS})
        WHERE start_year = {START} AND end_year = {END}""",
)
def report_stats(spark, sf_dir):
    return reports.stats(range_stats_sql(spark, sf_dir), START, END)


@register("report_best_by_value", BEST)
def report_best_by_value(spark, sf_dir):
    return reports.best_by_value(best_period_sql(spark, sf_dir))


@register(
    "report_best_by_label",
    f"""{WITH_BEST} SELECT series_label,
        round(sum(best_year_summed_value), 2) AS best_year_summed_value
        FROM best GROUP BY 1""",
)
def report_best_by_label(spark, sf_dir):
    return rounded(reports.best_by_label(best_period_sql(spark, sf_dir)))


@register(
    "recent_periods_topk",
    f"SELECT * FROM ({YEARLY}) ORDER BY year DESC, summed_value DESC NULLS LAST, series_id LIMIT 5",
)
def recent_periods_topk(spark, sf_dir):
    order = [F.desc("year"), F.desc_nulls_last("summed_value"), F.asc("series_id")]
    return reports.most_recent(yearly_sums(spark, sf_dir), 5, *order)


@register(
    "layer_row_counts",
    f"""{WITH_BEST}, silver AS (SELECT DISTINCT series_id, year, period FROM obs)
        SELECT 'bronze' AS layer, count(*) AS row_count FROM obs
        UNION ALL SELECT 'silver', count(*) FROM silver
        UNION ALL SELECT 'gold', count(*) FROM best""",
)
def layer_row_counts(spark, sf_dir):
    bronze = observations(spark, sf_dir).withColumn("footnote_codes", F.lit(None).cast("string"))
    layers = {"bronze": bronze, "silver": silver_observations(bronze).valid, "gold": best_period_df(spark, sf_dir)}
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("layer"), "row_count")
              for n, df in layers.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])
