"""Raw files staged from the given tables, read back and cleaned."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import Catalogue, money, table
from oreflow import layouts
from oreflow.functions.names import sanitize_names
from oreflow.operators.dedup import dedup_latest, latest_snapshot
from oreflow.operators.verify import overlap_audit
from oreflow.plans.medallion import (
    VERSION, current_snapshot, silver_observations, silver_population, versioned_lineage,
)
from oreflow.session import work_dir
from oreflow.sinks.landing import land_snapshot, write_delimited
from oreflow.sources import (
    explode_records, header_drift, pinned_records, read_delimited, read_envelopes, read_lines, read_lookups, row_widths,
    stream_delimited, stream_open_envelopes, with_lineage,
)
from oreflow.streaming import run_available_now

CATALOGUE = Catalogue()
register = CATALOGUE.register

SCHEMA = layouts.text_schema(layouts.OBSERVATION_COLUMNS)


# --- raw observations: one series per order, fields padded, '-' for a value not known yet ---
def raw_orders(spark, sf_dir):
    value = F.when(F.col("o_orderstatus") == "P", "-").otherwise(money("o_totalprice").cast("string"))
    quarter = F.concat(F.lit("Q0"), F.quarter("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        F.rpad(F.col("o_orderkey").cast("string"), 17, " ").alias("series_id"),
        F.year("o_orderdate").cast("string").alias("year"),
        F.when(F.col("o_orderpriority") == "5-LOW", "M13").otherwise(quarter).alias("period"),
        F.lpad(value, 12, " ").alias("value"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("footnote_codes"),
    )


RAW_SQL = """raw AS (
    SELECT rpad(CAST(o_orderkey AS VARCHAR), 17, ' ') AS series_id, CAST(year(o_orderdate) AS VARCHAR) AS year,
           CASE o_orderpriority WHEN '5-LOW' THEN 'M13' ELSE 'Q0' || CAST(quarter(o_orderdate) AS VARCHAR) END AS period,
           lpad(CASE o_orderstatus WHEN 'P' THEN '-'
                     ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END, 12, ' ') AS value,
           CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS footnote_codes
    FROM orders
)"""
CLEAN_SQL = f"""WITH {RAW_SQL}
SELECT trim(series_id) AS series_id, TRY_CAST(year AS INTEGER) AS year, period, TRY_CAST(trim(value) AS DOUBLE) AS value,
       footnote_codes
FROM raw WHERE regexp_matches(period, '^Q0[1-5]$')"""


def stage_orders(spark, sf_dir, label):
    """The raw orders as a delimited file set with padded header names."""
    raw = raw_orders(spark, sf_dir)
    root = work_dir(spark, label)
    write_delimited(raw.toDF(*[name.ljust(17) for name in raw.columns]), f"{root}/{layouts.CURRENT_FILE}")
    return root


@register("bronze_batch_tsv", f"WITH {RAW_SQL} SELECT * FROM raw")
def bronze_batch_tsv(spark, sf_dir):
    root = stage_orders(spark, sf_dir, "batch-tsv")
    return read_delimited(spark, f"{root}/{layouts.CURRENT_FILE}", SCHEMA)


@register("clean_typed", CLEAN_SQL)
def clean_typed(spark, sf_dir):
    return silver_observations(bronze_batch_tsv(spark, sf_dir)).valid


@register("bronze_lineage", f"WITH {RAW_SQL} SELECT series_id, true AS has_time, '{layouts.CURRENT_FILE}' AS source_file FROM raw")
def bronze_lineage(spark, sf_dir):
    root = stage_orders(spark, sf_dir, "lineage")
    scan = with_lineage(read_delimited(spark, f"{root}/{layouts.CURRENT_FILE}", SCHEMA), source_file=True)
    folder = F.element_at(F.split("_source_file", "/"), -2)
    return scan.select(
        "series_id", F.col("_ingested_at").isNotNull().alias("has_time"), folder.alias("source_file")
    )


@register("bronze_stream_tsv", f"WITH {RAW_SQL} SELECT * FROM raw")
def bronze_stream_tsv(spark, sf_dir):
    root = stage_orders(spark, sf_dir, "stream-tsv")
    run_available_now(
        stream_delimited(spark, f"{root}/{layouts.CURRENT_FILE}", SCHEMA), f"{root}/bronze", f"{root}/checkpoint"
    )
    return spark.read.parquet(f"{root}/bronze")


@register(
    "bronze_stream_rerun_noop",
    """SELECT 1 AS run, count(*) AS rows_after FROM orders UNION ALL SELECT 2, count(*) FROM orders""",
)
def bronze_stream_rerun_noop(spark, sf_dir):
    root = stage_orders(spark, sf_dir, "stream-rerun")
    runs = []
    for number in (1, 2):
        run_available_now(
            stream_delimited(spark, f"{root}/{layouts.CURRENT_FILE}", SCHEMA), f"{root}/bronze", f"{root}/checkpoint"
        )
        # the files are listed here, so each count covers the sink as it was after its run
        after = spark.read.parquet(f"{root}/bronze")
        runs.append(after.agg(F.count(F.lit(1)).alias("rows_after")).select(F.lit(number).alias("run"), "rows_after"))
    return runs[0].unionByName(runs[1])


@register(
    "bronze_stream_revision",
    """SELECT CAST(o_orderkey AS VARCHAR) AS series_id, CAST(year(o_orderdate) AS INTEGER) AS year,
              'Q0' || CAST(quarter(o_orderdate) AS VARCHAR) AS period,
              CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS value
       FROM orders WHERE o_orderstatus <> 'P'""",
)
def bronze_stream_revision(spark, sf_dir):
    """A preliminary file, then its revision: new values, more rows, and withdrawn rows gone."""
    orders = table(spark, sf_dir, "orders")

    def snapshot(df, value):
        return df.select(
            F.col("o_orderkey").cast("string").alias("series_id"),
            F.year("o_orderdate").cast("string").alias("year"),
            F.concat(F.lit("Q0"), F.quarter("o_orderdate")).alias("period"),
            value.cast("string").alias("value"),
            F.lit(None).cast("string").alias("footnote_codes"),
        )

    preliminary = snapshot(orders.filter("o_orderdate < '2001-01-01'"), F.floor(money("o_totalprice")))
    revised = snapshot(orders.filter("o_orderstatus <> 'P'"), money("o_totalprice"))
    root = work_dir(spark, "stream-revision")
    for version in (preliminary, revised):
        land_snapshot(version, f"{root}/landing", layouts.CURRENT_FILE)
        scan = stream_delimited(spark, f"{root}/landing/{layouts.CURRENT_FILE}__*", SCHEMA)
        run_available_now(versioned_lineage(scan), f"{root}/bronze", f"{root}/checkpoint", (VERSION,))
    newest = current_snapshot(spark.read.parquet(f"{root}/bronze"))
    return silver_observations(newest, [F.col("_ingested_at")]).valid.drop("footnote_codes")


@register("bronze_glob_filter", f"WITH {RAW_SQL} SELECT * FROM raw")
def bronze_glob_filter(spark, sf_dir):
    """Delimited, JSON and text files in one folder; only the first kind is wanted."""
    folder = work_dir(spark, "mixed-folder")
    write_delimited(raw_orders(spark, sf_dir), folder)
    table(spark, sf_dir, "customer").write.mode("append").json(folder)
    table(spark, sf_dir, "documents").select("text").write.mode("append").text(folder)
    return read_delimited(spark, folder, SCHEMA, glob="*.csv")


@register(
    "bronze_overlap_audit",
    """WITH k AS (
        SELECT o_custkey, year(o_orderdate) AS y, quarter(o_orderdate) AS q,
               bool_or(year(o_orderdate) >= 1998) AS c, bool_or(year(o_orderdate) <= 2000) AS a
        FROM orders GROUP BY 1, 2, 3)
       SELECT CASE WHEN c AND a THEN 'both' WHEN c THEN 'current only' ELSE 'all data only' END AS coverage,
              count(*) AS keys FROM k GROUP BY 1""",
)
def bronze_overlap_audit(spark, sf_dir):
    """A current export from 1998 on and a full export up to 2000, compared by key."""
    keys = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("series_id"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("period")
    )
    return overlap_audit(keys.filter("year >= 1998"), keys.filter("year <= 2000"), keys.columns)


LOOKUP_FILES = ["lk.nation", "lk.region", "lk.brand", "lk.customer"]


@register(
    "bronze_lookup_factory",
    """SELECT 'bronze_lk_nation' AS table_name, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_name AS text FROM nation
       UNION ALL SELECT 'bronze_lk_region', lpad(CAST(r_regionkey AS VARCHAR), 2, '0'), r_name FROM region
       UNION ALL SELECT DISTINCT 'bronze_lk_brand', lpad(regexp_extract(p_brand, '(\\d+)', 1), 2, '0'), p_brand FROM part
       UNION ALL SELECT 'bronze_lk_customer', lpad(CAST(c_custkey AS VARCHAR), 12, '0'), c_name FROM customer""",
)
def bronze_lookup_factory(spark, sf_dir):
    """Several lookups from one loader; zero-padded codes stay text."""
    def coded(df, key, width, text):
        return df.select(F.lpad(F.col(key).cast("string"), width, "0").alias("code"), F.col(text).alias("text"))

    part = table(spark, sf_dir, "part").select("p_brand").distinct()
    brands = part.withColumn("n", F.regexp_extract("p_brand", r"(\d+)", 1))
    lookups = [
        coded(table(spark, sf_dir, "nation"), "n_nationkey", 2, "n_name"),
        coded(table(spark, sf_dir, "region"), "r_regionkey", 2, "r_name"),
        coded(brands, "n", 2, "p_brand"),
        coded(table(spark, sf_dir, "customer"), "c_custkey", 12, "c_name"),
    ]
    root = work_dir(spark, "lookups")
    for name, lookup in zip(LOOKUP_FILES, lookups):
        write_delimited(lookup, f"{root}/{name}")
    loaded = read_lookups(spark, root, LOOKUP_FILES, prefix="bronze_")
    named = [df.select(F.lit(name).alias("table_name"), "code", "text") for name, df in loaded.items()]
    first, *others = named
    for other in others:
        first = first.unionByName(other)
    return first


@register("bronze_text_lines", "SELECT unnest(string_split(text, chr(10))) AS line FROM documents")
def bronze_text_lines(spark, sf_dir):
    folder = work_dir(spark, "text-lines")
    table(spark, sf_dir, "documents").select("text").write.text(folder)
    return read_lines(spark, folder)


# --- one envelope per year with the nations' totals ---
NATION_TOTALS_SQL = """nations AS (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, n_name AS nation,
           CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18,2)))) AS BIGINT) AS population
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2
)"""


def nation_totals(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    # summed per customer first: a customer with very many orders joins as one row per year
    sums = table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.sum(money("o_totalprice")).alias("total")
    )
    joined = sums.join(customer, "o_custkey").join(nation, "c_nationkey")
    return joined.groupBy("year", F.col("n_name").alias("nation")).agg(
        F.floor(F.sum("total")).cast("bigint").alias("population")
    )


@register(
    "bronze_json_envelope",
    f"""WITH {NATION_TOTALS_SQL} SELECT CAST(year AS VARCHAR) AS "Year", nation AS "Nation",
        CAST(population AS VARCHAR) AS "Population" FROM nations""",
)
def bronze_json_envelope(spark, sf_dir):
    """One JSON document per year, its array as long as there are nations; types pinned on reading."""
    folder = work_dir(spark, "envelopes")
    record = F.struct(
        F.col("year").alias("Year"), F.col("nation").alias("Nation"), F.col("population").alias("Population")
    )
    envelopes = nation_totals(spark, sf_dir).groupBy("year").agg(F.collect_list(record).alias("data"))
    documents = envelopes.select("year", F.to_json(F.struct("data")).alias("value"))
    documents.repartition("year").write.partitionBy("year").text(folder)
    return explode_records(read_envelopes(spark, f"{folder}/year=*", layouts.POPULATION_RECORD))


@register("stream_open_records", f"WITH {NATION_TOTALS_SQL} SELECT year, nation, population FROM nations WHERE population > 0")
def stream_open_records(spark, sf_dir):
    """A stream whose records spell their fields in three ways, some with numbers and some with text; none is lost."""
    root = work_dir(spark, "open-records")
    totals = nation_totals(spark, sf_dir)
    year, nation, population = (F.col(c) for c in ("year", "nation", "population"))
    spellings = [
        F.struct(year.alias("Year"), nation.alias("Nation"), population.alias("Population")),
        F.struct(year.cast("string").alias("ID Year"), nation.alias("Nation ID"), population.cast("string").alias("population")),
        F.struct(F.array(year).alias("other"), population.alias("POPULATION"), nation.alias("nation"), year.alias("year")),
    ]
    record = F.lit(None).cast("string")
    for i, spelling in enumerate(spellings):
        record = F.when(F.pmod(F.xxhash64("nation"), F.lit(3)) == i, F.to_json(spelling)).otherwise(record)
    # a list has a record per nation
    lists = totals.groupBy("year").agg(F.array_join(F.collect_list(record), ",").alias("records"))
    documents = lists.select("year", F.concat(F.lit('{"data": ['), "records", F.lit("]}")).alias("value"))
    documents.repartition("year").write.partitionBy("year").text(f"{root}/in")
    envelopes = stream_open_envelopes(spark, f"{root}/in/year=*")
    records = pinned_records(envelopes.select(F.explode("data").alias("record")), layouts.POPULATION_FIELDS)
    run_available_now(records, f"{root}/bronze", f"{root}/checkpoint")
    return silver_population(spark.read.parquet(f"{root}/bronze"), keys=("year", "nation")).valid


@register("bronze_schema_drift", """WITH h(file, column_name, expected_position, actual_position, status) AS (VALUES
        ('pr.data.0.Current', 'series_id', 1, 1, 'ok'), ('pr.data.0.Current', 'year', 2, 2, 'ok'),
        ('pr.data.0.Current', 'period', 3, 3, 'ok'), ('pr.data.0.Current', 'value', 4, 4, 'ok'),
        ('pr.data.0.Current', 'footnote_codes', 5, 5, 'ok'),
        ('pr.revised', 'series_id', 1, 1, 'ok'), ('pr.revised', 'year', 2, 3, 'moved'),
        ('pr.revised', 'period', 3, 2, 'moved'), ('pr.revised', 'value', 4, 4, 'ok'),
        ('pr.revised', 'footnote_codes', 5, NULL, 'missing'), ('pr.revised', 'source', NULL, 5, 'extra'),
        ('pr.revised', 'priority', NULL, 6, 'extra')),
    w AS (SELECT 'pr.data.0.Current' AS file, 5 AS fields, count(*) AS data_lines FROM orders
          UNION ALL SELECT 'pr.revised', 6, count(*) FROM orders)
    SELECT h.*, w.fields, w.data_lines FROM h JOIN w ON w.file = h.file""")
def bronze_schema_drift(spark, sf_dir):
    """Headers against the expected columns, with the width of every line of the file beside them."""
    root = stage_orders(spark, sf_dir, "drift")
    revised = raw_orders(spark, sf_dir).select(
        "series_id", "period", "year", "value", F.lit("r").alias("source"), F.length("period").alias("priority")
    )
    write_delimited(revised, f"{root}/pr.revised")
    files = {name: f"{root}/{name}" for name in (layouts.CURRENT_FILE, "pr.revised")}
    widths = [
        # header lines start with the first column's name, data lines never do
        row_widths(spark, path, skip_header_of="series_id").withColumn("file", F.lit(name)) for name, path in files.items()
    ]
    # part files with the same header show as one
    drift = header_drift(spark, files, layouts.OBSERVATION_COLUMNS).drop("part_file").distinct()
    widths = widths[0].unionByName(widths[1]).withColumnRenamed("lines", "data_lines")
    return drift.join(widths, "file", "left")


# --- silver helpers ---
@register("resolve_columns", f"WITH {NATION_TOTALS_SQL} SELECT * FROM nations WHERE population > 0")
def resolve_columns(spark, sf_dir):
    odd = nation_totals(spark, sf_dir).select(
        F.col("year").cast("string").alias("ID Year"), F.col("population").alias("POPULATION"), F.col("nation").alias("Nation ID")
    )
    return silver_population(odd, keys=("year", "nation")).valid


@register(
    "sanitize_names",
    """SELECT c_custkey AS customer_key, c_name AS "name__full_", c_acctbal AS "balance___", c_mktsegment AS "a_b_c_d"
       FROM customer""",
)
def sanitize_names_query(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return sanitize_names(customer.toDF("customer key   ", "name (full)", "balance =%", "a,b;c-d"))


@register(
    "dedup_latest",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem)
       WHERE rn = 1""",
)
def dedup_latest_query(spark, sf_dir):
    columns = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem").select(*columns)
    return dedup_latest(lines, ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate")])


@register(
    "latest_snapshot",
    """SELECT o_orderpriority AS file_name, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS version,
              o_orderkey, o_totalprice FROM orders o
       WHERE year(o_orderdate) * 12 + month(o_orderdate) = (
           SELECT max(year(i.o_orderdate) * 12 + month(i.o_orderdate)) FROM orders i
           WHERE i.o_orderpriority = o.o_orderpriority)""",
)
def latest_snapshot_query(spark, sf_dir):
    """Each priority as a file that is published anew each month."""
    published = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("file_name"),
        (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("version"),
        "o_orderkey",
        "o_totalprice",
    )
    return latest_snapshot(published)
